"""Stages that answer which stations are nearest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearstop.functions.geo import is_located
from nearstop.operators.match import (
    CANDIDATE, nearest_for, nearest_stations, refresh_nearest, station_changes,
)
from nearstop.plans.enrich import load_rental_coordinates
from nearstop.scratch import materialise, stage
from nearstop.sinks.features import map_features
from nearstop.sinks.tables import write_table
from nearstop.sources.files import SourceNotFound
from nearstop.sources.tables import read_table


def _grouped_stations(spark: SparkSession, root: str) -> DataFrame:
    stations = read_table(spark, "table_stations_grouped", root, partition_by="ZIP_Group_Rental")
    return stations.drop("ZIP_Group_Station").withColumnRenamed(
        "ZIP_Group_Rental", "ZIP_Group_Station"
    )


def all_nearest_stations(spark: SparkSession, root: str, k: int = 10) -> DataFrame:
    """The nearest stations of every located offer."""
    return nearest_stations(load_rental_coordinates(spark, root), _grouped_stations(spark, root), k)


@stage
def update_nearest_stations(spark: SparkSession, root: str, k: int = 10) -> None:
    """Store the nearest stations of every located offer, from the last result if there is one.

    Only offers that a change of the stations concerns are computed anew. The stations that the
    result rests on are stored after it; a run that breaks off between the two is made up for by
    the next one, as the same changes applied twice give the same result.
    """
    offers = load_rental_coordinates(spark, root).where(is_located(F.col("lat"), F.col("lng")))
    offers = offers.select("scoutId", "zip_group", "lat", "lng").distinct()
    stations = _grouped_stations(spark, root)
    name, base = f"table_nearest_{k}", f"table_nearest_{k}_stations"
    try:
        previous, before = read_table(spark, name, root), read_table(spark, base, root)
    except SourceNotFound:
        found = nearest_stations(offers, stations, k)
    else:
        added, removed = (
            materialise(rows, "changes") for rows in station_changes(before, stations)
        )
        found = refresh_nearest(previous, offers, stations, added, removed, k)
    # Stored apart first, as the tables that it is computed from are overwritten.
    write_table(materialise(found, "nearest"), name, root)
    write_table(stations.select(*CANDIDATE, "ZIP_Group_Station"), base, root)


def query_nearest_stations(
    spark: SparkSession, root: str, scout_id: int, k: int = 10
) -> DataFrame:
    """The nearest stations of one offer; only the folder of its zip group is read."""
    offers = load_rental_coordinates(spark, root)
    return nearest_for(offers, _grouped_stations(spark, root), scout_id, k)


def show_nearest_stations(
    spark: SparkSession, root: str, scout_id: int, k: int = 10
) -> DataFrame:
    """Map features of one offer and its nearest stations."""
    nearest = query_nearest_stations(spark, root, scout_id, k)
    offers = load_rental_coordinates(spark, root)
    return map_features(offers.where(offers["scoutId"] == scout_id), nearest)
