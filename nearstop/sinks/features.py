"""Results as map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _feature(row: DataFrame) -> DataFrame:
    point = F.struct(
        F.lit("Point").alias("type"), F.array("lng", "lat").alias("coordinates")
    )
    properties = F.struct("scoutId", "role", "rank", "label", "color")
    feature = F.struct(
        F.lit("Feature").alias("type"), point.alias("geometry"), properties.alias("properties")
    )
    return row.withColumn("feature", F.to_json(feature))


def map_features(rentals: DataFrame, nearest: DataFrame) -> DataFrame:
    """One marker per rental with its address, and one per nearest station with its name.

    ``rentals`` has scoutId, lat, lng and address_string; ``nearest`` has scoutId, rank, Name,
    Latitude and Longitude. Only rentals with coordinates get a marker.
    """

    def marker(role: str, rank: Column, label: str, color: str, lat: str, lng: str) -> list[Column]:
        return [
            F.col("scoutId"), F.lit(role).alias("role"), rank.cast("int").alias("rank"),
            F.col(lat).cast("double").alias("lat"), F.col(lng).cast("double").alias("lng"),
            F.col(label).alias("label"), F.lit(color).alias("color"),
        ]

    offers = rentals.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(
        *marker("rental", F.lit(0), "address_string", "red", "lat", "lng")
    )
    stations = nearest.select(
        *marker("station", F.col("rank"), "Name", "blue", "Latitude", "Longitude")
    )
    return _feature(offers.unionByName(stations))
