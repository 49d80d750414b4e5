"""Stations that belong to rental offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.functions.geo import distance2, is_located
from nearstop.operators.nearest import Limits, nearest_join
from nearstop.scratch import materialise

CANDIDATE = ["Latitude", "Longitude", "Parent", "DHID", "Name"]
_ORDER = ["DHID", "Parent", "Name", "Latitude", "Longitude"]  # of stations at one distance


def station_candidates(stations: DataFrame) -> DataFrame:
    """Distinct place, ids and name of stations, without rows that lack any of them."""
    return stations.select(*CANDIDATE).dropna(how="any").dropDuplicates()


def group_stations(rental_groups: DataFrame, stations: DataFrame) -> DataFrame:
    """All stations of each zip group that has offers.

    A group without stations stays as one row of nulls; the null group matches nothing. An inner
    join plus the groups it misses gives the rows of a left join, and unlike that join lets
    adaptive execution split a group that holds very many stations.
    """
    same = F.col("ZIP_Group_Rental") == F.col("ZIP_Group_Station")
    matched = stations.join(rental_groups, same)
    station_groups = stations.select("ZIP_Group_Station").distinct()
    empty = rental_groups.join(station_groups, same, "left_anti")
    return matched.unionByName(empty, allowMissingColumns=True).select(
        "ZIP_Group_Rental", *stations.columns
    )


def rental_station_keys(rentals: DataFrame, stations: DataFrame) -> DataFrame:
    """For each offer its zip group and the number of stations in it.

    Together with the grouped stations this is the relation of offers to stations. The pairs
    themselves are not stored: their number is the product of both sides of a group.
    """
    counted = (
        stations.where(F.col("ZIP_Group_Station").isNotNull())
        .groupBy("ZIP_Group_Station").agg(F.count("*").alias("stations"))
    )
    same = F.col("zip_group") == F.col("ZIP_Group_Station")
    return rentals.select("scoutId", "zip_group").join(counted, same).drop("ZIP_Group_Station")


def nearest_stations(
    rentals: DataFrame, stations: DataFrame, k: int = 10, limits: Limits = Limits()
) -> DataFrame:
    """The ``k`` stations nearest to each offer within its zip group.

    ``rentals`` has scoutId, zip_group, lat and lng; ``stations`` the columns of ``CANDIDATE`` and
    ZIP_Group_Station. Equal distances are ordered by DHID. A group with fewer stations gives
    those it has. Adds ``rank`` and the station columns to these columns of the offers.
    """
    return nearest_join(
        rentals.select("scoutId", "zip_group", "lat", "lng"), stations, k, _ORDER,
        group=("zip_group", "ZIP_Group_Station"),
        candidate_point=("Latitude", "Longitude"), limits=limits,
    )


def station_changes(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stations that only ``after`` has, and those that only ``before`` has.

    A station that moved, or got another name or zip group, is in both. Rows that lack what a
    candidate needs are in neither.
    """
    columns = [*CANDIDATE, "ZIP_Group_Station"]

    def usable(stations: DataFrame) -> DataFrame:
        return stations.select(*columns).dropna(how="any").distinct()

    a, b = usable(after), usable(before)
    return a.join(b, columns, "left_anti"), b.join(a, columns, "left_anti")


def refresh_nearest(
    previous: DataFrame, rentals: DataFrame, stations: DataFrame, added: DataFrame,
    removed: DataFrame, k: int = 10, limits: Limits = Limits(),
) -> DataFrame:
    """What ``nearest_stations`` gives for ``rentals`` and ``stations``, from its last result.

    ``previous`` is that result with the stations before ``added`` came and ``removed`` went, see
    ``station_changes``. Offers that lost one of their stations, are new or have moved are answered
    anew, and only those meet all stations. The others keep their rows; where some of ``added`` are
    nearer than their last station these are put in place. ``scoutId`` differs between offers.
    """
    offers = rentals.select("scoutId", "zip_group", "lat", "lng")
    place = ["scoutId", "zip_group", "lat", "lng"]
    same = [F.col(f"_n.{c}").eqNullSafe(F.col(f"_p.{c}")) for c in place]
    gone = removed.select(*[F.col(c).alias(f"_{c}") for c in [*_ORDER, "ZIP_Group_Station"]])
    lost = previous.join(
        gone, [F.col(c) == F.col(f"_{c}") for c in _ORDER]
        + [F.col("zip_group") == F.col("_ZIP_Group_Station")], "left_semi",
    )
    kept = previous.select(*place).distinct().join(
        lost.select(*place).distinct().alias("_l"), place, "left_anti"
    )
    # An offer without stations has no rows; it is answered anew, like a new one.
    settled = materialise(
        offers.alias("_n").join(kept.alias("_p"), same, "left_semi").distinct(), "settled"
    )
    anew = offers.join(settled.select("scoutId"), "scoutId", "left_anti")
    fresh = nearest_stations(anew, stations, k, limits)

    near = materialise(nearest_stations(settled, added, k, limits).drop("rank"), "added")
    touched = near.select("scoutId").distinct()
    old = previous.join(settled.select("scoutId"), "scoutId", "left_semi")
    away = distance2(F.col("lat"), F.col("lng"), F.col("Latitude"), F.col("Longitude"))
    both = old.drop("rank").join(touched, "scoutId", "left_semi").select(near.columns).unionByName(near)
    # At most k rows of each kind for an offer.
    ranked = both.groupBy(*place).agg(F.slice(F.array_sort(F.collect_set(
        F.struct(away.alias("_away"), *_ORDER)
    )), 1, k).alias("_found")).select(*place, F.posexplode("_found").alias("_pos", "_found"))
    merged = ranked.select(*place, (F.col("_pos") + 1).alias("rank"), *[f"_found.{c}" for c in _ORDER])
    untouched = old.join(touched, "scoutId", "left_anti").select(merged.columns)
    return fresh.select(merged.columns).unionByName(merged).unionByName(untouched)


def nearest_for(
    rentals: DataFrame, stations: DataFrame, scout_id: int, k: int = 10
) -> DataFrame:
    """The nearest stations of one offer; its id must name exactly one.

    The offer is one row, so its stations are ranked by a sort that keeps ``k`` rows per task.
    """
    offers = rentals.where(F.col("scoutId").isin(scout_id)).take(2)
    if len(offers) != 1:
        found = "several offers" if offers else "no offer"
        raise LookupError(f"{scout_id} names {found}")
    offer = offers[0]
    lat, lng = (F.lit(offer[name]).cast("double") for name in ("lat", "lng"))
    place = F.col("Latitude").cast("double"), F.col("Longitude").cast("double")
    group = F.col("ZIP_Group_Station") == F.lit(offer.zip_group)
    near = station_candidates(stations.where(group & is_located(*place) & is_located(lat, lng)))
    away = distance2(lat, lng, *place)
    first = (
        near.select(F.struct(away.alias("away"), *_ORDER).alias("_found"))
        .orderBy("_found").limit(k)
    )
    ranked = first.agg(F.sort_array(F.collect_list("_found")).alias("_found"))
    return ranked.select(
        F.lit(offer.scoutId).alias("scoutId"), F.posexplode("_found").alias("_pos", "_found")
    ).select("scoutId", (F.col("_pos") + 1).alias("rank"), *[f"_found.{c}" for c in _ORDER])


def rentals_without_station(rentals: DataFrame, stations: DataFrame) -> DataFrame:
    """Offers for which no station can be found: no coordinates, or no station in the group."""
    usable = stations.where(
        is_located(F.col("Latitude").cast("double"), F.col("Longitude").cast("double"))
    ).dropna(how="any", subset=CANDIDATE)
    groups = usable.select("ZIP_Group_Station").distinct()
    matched = (F.col("zip_group") == F.col("ZIP_Group_Station")) & is_located(
        F.col("lat"), F.col("lng")
    )
    return rentals.join(groups, matched, "left_anti")
