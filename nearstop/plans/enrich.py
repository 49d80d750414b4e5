"""Stages that fill in coordinates and zip codes and group the stations."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearstop.operators.geocode import coordinates_of, resolve_residual, resolve_zips
from nearstop.operators.lookup import stored_answers, stored_lookup
from nearstop.operators.match import group_stations
from nearstop.operators.quality import counted, require_same_rows
from nearstop.operators.rentals import with_address, with_zip_group, zip_groups
from nearstop.operators.spelling import SLIPS
from nearstop.operators.stations import missing_zip, with_municipal_zip, with_resolved_zip
from nearstop.scratch import stage
from nearstop.sinks.tables import extract_table, write_table
from nearstop.sources.tables import read_table

COORDS = "table_rental_location_coords"
ADDRESS_ANSWERS, ZIP_ANSWERS = "table_answers_addresses", "table_answers_zips"
#: Answers a frame of keys with a frame of results.
Service = Callable[[pd.DataFrame], pd.DataFrame]
_ADDRESS = ["scoutId", "streetPlain", "houseNumber", "geo_plz", "geo_krs", "geo_bln"]


@stage
def geocode_rentals(
    spark: SparkSession, root: str, gazetteer: DataFrame, slips: int = SLIPS,
    service: Service | None = None, parallelism: int | None = None,
) -> None:
    """Store the address and coordinates of the offers with a known street.

    ``gazetteer`` has address_string, lat and lng. ``service`` is asked for addresses that are not
    there: it gets frames of address_string and returns lat and lng, see ``ask``; its answers are
    kept, and later runs ask for new and failed addresses only. An address still open is taken for
    the most similar known one of its zip group that differs in ``slips`` characters at most; the
    centre of the zip code is the fallback.
    """
    offers = with_address(read_table(spark, "table_rental_location", root).select(*_ADDRESS))
    centres = read_table(spark, "table_mapping_zip_to_coor", root)
    if service is not None:
        asked = offers.select("address_string").join(
            gazetteer.select("address_string"), "address_string", "left_anti"
        )
        answers = stored_answers(
            asked, ["address_string"], service, "lat double, lng double", root, ADDRESS_ANSWERS,
            parallelism,
        )
        gazetteer = gazetteer.select("address_string", "lat", "lng").unionByName(
            answers.select("address_string", "lat", "lng")
        )
    located = coordinates_of(offers, gazetteer, centres, slips=slips).select(
        *_ADDRESS, "address_string",
        F.col("coords.Lat").alias("lat"), F.col("coords.Lng").alias("lng"),
    )
    # By offer, so that a query for one of them reads one part of one file.
    extract_table(located, located.columns, COORDS, root, sort_by="scoutId")


def load_rental_coordinates(
    spark: SparkSession, root: str, parts: tuple[str, ...] = (COORDS,)
) -> DataFrame:
    """The located offers, from one table or several of the same columns, with their zip group."""
    offers = read_table(spark, parts[0], root)
    for name in parts[1:]:
        offers = offers.unionByName(read_table(spark, name, root))
    return with_zip_group(offers)


@stage
def add_zipcode_to_stations(
    spark: SparkSession, root: str, service: Service | None = None,
    parallelism: int | None = None,
) -> None:
    """Store the stations with zip code and zip group.

    The zip code comes from the municipality, else from ``service`` if there is one, else from the
    nearest zip code centre. The service gets frames of Latitude and Longitude and returns Q_PLZ,
    see ``ask``; its answers are kept, and later runs ask for new and failed places only. A step
    that changes the number of stations, as a municipality that is listed twice would, raises
    ``RowCountChanged``; the rows are counted while they are written.
    """
    given, before = counted(read_table(spark, "table_stations", root))
    stations, after = counted(with_municipal_zip(
        given, read_table(spark, "table_mapping_municipal_to_zip", root)
    ))
    extract_table(stations, stations.columns, "table_stations_with_zip", root)
    require_same_rows(before, after, "zip code of the municipality")
    stored = read_table(spark, "table_stations_with_zip", root)
    centres = read_table(spark, "table_mapping_zip_to_coor", root)
    attempts = [lambda rows: rows.join(
        resolve_zips(rows, centres).select("SeqNo", "Q_PLZ"), "SeqNo", "left"
    )]
    if service is not None:
        attempts.insert(0, lambda rows: stored_lookup(
            rows, ["Latitude", "Longitude"], service, "Q_PLZ string", "SeqNo", root, ZIP_ANSWERS,
            parallelism,
        ))
    resolved = resolve_residual(missing_zip(stored), ["SeqNo"], "Q_PLZ", attempts)
    given, before = counted(stored)
    final, after = counted(with_resolved_zip(given, resolved))
    extract_table(final, final.columns, "table_stations_with_zip_final", root)
    require_same_rows(before, after, "zip code of the nearest centre")


@stage
def group_stations_by_zipcode(spark: SparkSession, root: str) -> None:
    """Store the stations of each zip group that has offers, one folder per group."""
    grouped = group_stations(
        zip_groups(read_table(spark, "table_rental_location", root)),
        read_table(spark, "table_stations_with_zip_final", root),
    )
    write_table(grouped, "table_stations_grouped", root, partition_by="ZIP_Group_Rental")
