"""Checks on tables, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class RowCountChanged(AssertionError):
    """A step lost or added rows."""


def zip_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a step, and zip codes and coordinates known after it."""
    columns = ["PLZ", "Latitude", "Longitude"]
    tagged = before.select(F.lit(False).alias("is_after"), *columns).unionByName(
        after.select(F.lit(True).alias("is_after"), *columns)
    )
    is_after, plz = F.col("is_after"), F.col("PLZ")
    return tagged.agg(
        F.count_if(~is_after).alias("rows_before"),
        F.count_if(is_after).alias("rows_after"),
        F.count_if(~is_after & plz.isNull()).alias("zip_null_before"),
        F.count_if(is_after & plz.isNull()).alias("zip_null_after"),
        F.count_if(is_after & plz.isNotNull()).alias("zip_known_after"),
        F.count_if(is_after & (plz == "")).alias("zip_blank_after"),
        F.count(F.when(is_after, F.col("Latitude"))).alias("latitudes_after"),
        F.count(F.when(is_after, F.col("Longitude"))).alias("longitudes_after"),
    )


def require_same_count(before: DataFrame, after: DataFrame) -> None:
    """Raise if the tables differ in their number of rows."""
    counts = before.count(), after.count()
    if counts[0] != counts[1]:
        raise RowCountChanged(f"{counts[0]} rows before, {counts[1]} after")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and its number of rows, known once a query that reads all of it has ended.

    The rows are counted as they pass, so no second query runs over them.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def require_same_rows(before: Observation, after: Observation, step: str) -> None:
    """Raise if the rows counted before and after a step differ; its query must have ended."""
    counts = before.get["n_rows"], after.get["n_rows"]
    if counts[0] != counts[1]:
        raise RowCountChanged(f"{step}: {counts[0]} rows before, {counts[1]} after")


def zip_group_stats(rental_groups: DataFrame, stations: DataFrame) -> DataFrame:
    """One row: distinct groups with offers, and those of them that have stations."""
    offered = rental_groups.select(F.col("ZIP_Group_Rental").alias("zip_group"))
    served = stations.select(F.col("ZIP_Group_Station").alias("zip_group"))
    sides = offered.withColumn("rental", F.lit(True)).unionByName(
        served.withColumn("rental", F.lit(False))
    )
    per_group = sides.where(F.col("zip_group").isNotNull()).groupBy("zip_group").agg(
        F.bool_or("rental").alias("rental"), F.bool_or(~F.col("rental")).alias("station")
    )
    return per_group.agg(
        F.count_if("rental").alias("rental_groups"),
        F.count_if(F.col("rental") & F.col("station")).alias("matched_station_groups"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > 1)
