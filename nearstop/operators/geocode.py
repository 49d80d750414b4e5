"""Coordinates of addresses and zip codes of coordinates, from reference tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.functions.geo import distance2, is_located
from nearstop.functions.text import address_zip_group
from nearstop.operators.lookup import lookup_join, one_per_key
from nearstop.operators.nearest import Limits, nearest_join
from nearstop.operators.spelling import best_spellings
from nearstop.scratch import materialise
from nearstop.sinks.tables import write_table
from nearstop.sources.files import SourceNotFound
from nearstop.sources.tables import read_table


def nearest_addresses(addresses: DataFrame, gazetteer: DataFrame, slips: int) -> DataFrame:
    """For each distinct address_string the most similar one of the same zip group.

    Returns address_string, match and distance, see ``best_spellings``. The zip group is read from
    the address, which ends in zip code, district and state.
    """
    def grouped(table: DataFrame) -> DataFrame:
        text = F.col("address_string")
        return table.select("address_string", address_zip_group(text).alias("zip_group"))

    found = best_spellings(
        grouped(addresses), grouped(gazetteer), "zip_group", "address_string", slips
    )
    return found.select("address_string", "match", "distance")


def coordinates_of(
    rentals: DataFrame, gazetteer: DataFrame, centres: DataFrame, zip_column: str = "geo_plz",
    slips: int = 0,
) -> DataFrame:
    """Add ``coords`` (struct of Lat and Lng) and ``tier`` to the offers.

    The address is looked up in ``gazetteer`` (address_string, lat, lng), where the first point of
    an address counts. With ``slips`` an address that is not there is taken for the most similar
    one of its zip group that differs in so many characters at most. Offers still not found, or
    without an address, get the centre of their zip code from ``centres`` (PLZ, lat, lng). Tier is
    1 for the address, 3 for a similar one, 2 for the centre, or null if none has the offer.
    """
    if slips:
        known = gazetteer.where(is_located(F.col("lat"), F.col("lng")))
        open_addresses = rentals.select("address_string").join(
            known.select("address_string"), "address_string", "left_anti"
        )
        respelt = nearest_addresses(open_addresses, known, slips).select(
            F.col("address_string").alias("_asked"), F.col("match").alias("_match")
        )
        rentals = lookup_join(
            rentals, materialise(respelt, "respelt"), {"address_string": "_asked"}, "scoutId"
        ).withColumn("_spelt", F.coalesce("_match", "address_string"))
    else:
        rentals = rentals.withColumns({
            "_spelt": F.col("address_string"), "_match": F.lit(None).cast("string"),
            "_asked": F.lit(None).cast("string"),
        })

    def points(table: DataFrame, key: str, prefix: str) -> DataFrame:
        located = table.where(F.col(key).isNotNull() & is_located(F.col("lat"), F.col("lng")))
        return one_per_key(located.select(key, "lat", "lng"), [key], ["lat", "lng"]).select(
            F.col(key).alias(f"{prefix}_key"),
            F.struct(F.col("lat").alias("Lat"), F.col("lng").alias("Lng")).alias(prefix),
        )

    found = lookup_join(
        rentals, points(gazetteer, "address_string", "_exact"),
        {"_spelt": "_exact_key"}, "scoutId",
    )
    # Only offers still open ask for a centre; the others get no key.
    found = found.withColumn("_open_zip", F.when(F.col("_exact").isNull(), F.col(zip_column)))
    found = lookup_join(
        found, points(centres, "PLZ", "_centre"), {"_open_zip": "_centre_key"}, "scoutId"
    )
    in_register = F.when(F.col("_match").isNull(), 1).otherwise(3)
    tier = F.when(F.col("_exact").isNotNull(), in_register).when(F.col("_centre").isNotNull(), 2)
    return found.withColumns(
        {"coords": F.coalesce("_exact", "_centre"), "tier": tier}
    ).drop(
        "_exact", "_exact_key", "_centre", "_centre_key", "_open_zip", "_spelt", "_match", "_asked"
    )


def nearest_zip(
    stations: DataFrame, centres: DataFrame, limits: Limits = Limits()
) -> DataFrame:
    """Zip code of the nearest centre as ``Q_PLZ``; equal distances take the lower zip code.

    Stations without coordinates give no row.
    """
    found = nearest_join(
        stations, centres, 1, ["PLZ"],
        query_point=("Latitude", "Longitude"), limits=limits,
    )
    return found.drop("rank").withColumnRenamed("PLZ", "Q_PLZ")


def resolve_residual(
    rows: DataFrame,
    keys: list[str],
    result: str,
    attempts: list[Callable[[DataFrame], DataFrame]],
    state: tuple[str, str] | None = None,
) -> DataFrame:
    """Try ``attempts`` in turn, each on the rows the earlier ones left open.

    An attempt takes rows and returns them with column ``result``, null or blank where it found
    nothing. Returns one row per key with ``result`` and the number of the attempt, for resolved
    rows only. Attempts end early once nothing is open.

    ``state`` (root, name) keeps what each attempt returned as table ``name``_1, ``name``_2 and so
    on below root. A call that finds the table of an attempt there reads it and does not try again,
    so work that broke off goes on where it ended; take another name for other rows.
    """
    def tried_by(number: int, attempt, residual: DataFrame) -> DataFrame:
        if state is None:
            return materialise(attempt(residual), "attempt")
        root, name = state[0], f"{state[1]}_{number}"
        try:
            return read_table(rows.sparkSession, name, root)
        except SourceNotFound:
            write_table(attempt(residual), name, root)
            return read_table(rows.sparkSession, name, root)

    resolved, residual = [], rows
    for number, attempt in enumerate(attempts, 1):
        tried = tried_by(number, attempt, residual)
        is_open = F.col(result).isNull() | (F.col(result) == "")
        resolved.append(
            tried.where(~is_open).select(*keys, result, F.lit(number).alias("attempt"))
        )
        residual = tried.where(is_open).drop(result)
        if residual.isEmpty():
            break
    return one_per_key(
        reduce(DataFrame.unionByName, resolved), keys, ["attempt", result]
    )


def resolve_zips(
    stations: DataFrame,
    centres: DataFrame,
    radii: tuple[float, ...] = (0.125, 0.25, 0.5),
    limits: Limits = Limits(),
) -> DataFrame:
    """Zip code of the nearest centre for each station, as a search in widening circles gives it.

    One nearest join finds the centre, whose distance tells the circle that reaches it first.
    Returns SeqNo, Q_PLZ and the number of the attempt: that of the first radius (rising) the
    centre is within, and one more beyond the last. Stations without coordinates give no row; a
    SeqNo used twice gives the nearer answer.
    """
    places = centres.withColumns({"_lat": F.col("lat"), "_lng": F.col("lng")})
    found = nearest_join(
        stations, places, 1, ["PLZ", "_lat", "_lng"],
        query_point=("Latitude", "Longitude"), limits=limits,
    )
    lat, lng = F.col("Latitude").cast("double"), F.col("Longitude").cast("double")
    d2 = distance2(lat, lng, F.col("_lat"), F.col("_lng"))
    attempt = F.lit(len(radii) + 1)
    for number, radius in reversed(list(enumerate(radii, 1))):
        attempt = F.when(d2 <= radius * radius, F.lit(number)).otherwise(attempt)
    named = found.select("SeqNo", F.col("PLZ").alias("Q_PLZ"), attempt.alias("attempt"))
    return one_per_key(named, ["SeqNo"], ["attempt", "Q_PLZ"])
