"""Stages that turn input files into stored tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from nearstop.operators.rentals import with_repaired_zip
from nearstop.operators.stations import with_coordinates
from nearstop.schemas import (
    RENTAL_FEATURE, RENTAL_LOCATION, RENTAL_PRICE_AND_COST, STATIONS, schema,
)
from nearstop.scratch import materialise, stage
from nearstop.sinks.tables import extract_table
from nearstop.sources.files import (
    read_municipal_zips, read_rentals, read_stations, read_zip_coordinates,
)


@stage
def ingest_rentals(spark: SparkSession, path: str, root: str) -> None:
    """Read the offers, complete their zip codes and store them as three tables.

    The files are parsed once, into a scratch table; the three extracts then read only their own
    columns of it.
    """
    rentals = materialise(with_repaired_zip(read_rentals(spark, path)), "rentals")
    extract_table(rentals, RENTAL_LOCATION, "table_rental_location", root)
    extract_table(rentals, RENTAL_PRICE_AND_COST, "table_rental_price_and_cost", root)
    extract_table(rentals, RENTAL_FEATURE, "table_rental_feature", root)


@stage
def ingest_stations(spark: SparkSession, path: str, root: str) -> None:
    """Read the stations, turn their coordinates into numbers and store them."""
    stations = with_coordinates(read_stations(spark, path))
    extract_table(stations, STATIONS, "table_stations", root)


@stage
def ingest_mappings(
    spark: SparkSession, municipal_path: str, zip_path: str, root: str,
    municipal_format: str = "csv", **municipal_options: str,
) -> None:
    """Store the zip code of each municipality and the centre of each zip code."""
    municipal = read_municipal_zips(spark, municipal_path, municipal_format, **municipal_options)
    extract_table(
        municipal, schema("MAPPING_MUNICIPAL_ZIP").names, "table_mapping_municipal_to_zip", root
    )
    centres = read_zip_coordinates(spark, zip_path)
    extract_table(centres, schema("MAPPING_ZIP_COOR").names, "table_mapping_zip_to_coor", root)
