"""Zip codes and groups of stations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.functions.text import blanks_to_null, decimal_comma, zip_group
from nearstop.operators.lookup import lookup_join, one_per_key

# Fixed value: municipality code of stations that take their data from a parent.
CHILD_CODE = "00000000"

FROM_PARENT = ["MunicipalityCode", "Municipality", "MunicipalityCode_ZIP", "name_ZIP", "PLZ"]


def with_coordinates(stations: DataFrame) -> DataFrame:
    """Read the coordinates, written with a decimal comma, as numbers."""
    return stations.withColumns(
        {name: decimal_comma(F.col(name)) for name in ("Latitude", "Longitude")}
    )


def with_municipal_zip(stations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join with the municipality mapping; a code listed twice there doubles its stations."""
    renamed = mapping.withColumnsRenamed(
        {"Name": "name_ZIP", "MunicipalityCode": "MunicipalityCode_ZIP"}
    )
    return lookup_join(stations, renamed, {"MunicipalityCode": "MunicipalityCode_ZIP"}, "SeqNo")


def missing_zip(stations: DataFrame) -> DataFrame:
    """Number and coordinates of the stations whose zip code is null or blank."""
    return (
        blanks_to_null(stations).where(F.col("PLZ").isNull())
        .select("SeqNo", "Latitude", "Longitude")
    )


def with_resolved_zip(stations: DataFrame, resolved: DataFrame) -> DataFrame:
    """Fill missing zip codes from ``resolved`` (SeqNo, Q_PLZ) and add the zip group."""
    joined = lookup_join(
        blanks_to_null(stations), resolved.select(F.col("SeqNo").alias("_seq"), "Q_PLZ"),
        {"SeqNo": "_seq"}, "DHID",
    )
    plz = F.coalesce("PLZ", "Q_PLZ")
    return joined.drop("_seq").withColumns(
        {"PLZ": plz, "ZIP_Group_Station": zip_group(plz)}
    ).drop("Q_PLZ")


def inherit_from_parent(stations: DataFrame) -> DataFrame:
    """Give child stations the municipality and zip code of their parent.

    A station is a child if its municipality code is null or all zeros; the others are parents.
    Children keep their own id, name and coordinates. A child without a known parent stays, with
    nulls, and a parent id used twice gives one row, if there is one that has a zip code, so no row
    is lost or added.
    """
    is_parent = F.coalesce(F.col("MunicipalityCode") != CHILD_CODE, F.lit(False))
    inherited = [name for name in FROM_PARENT if name in stations.columns]
    parents = one_per_key(
        stations.where(is_parent & F.col("DHID").isNotNull()).select(
            F.col("DHID").alias("_parent"), F.col("PLZ").isNull().alias("_no_zip"), *inherited
        ),
        ["_parent"], ["_no_zip", *inherited],
    ).drop("_no_zip")
    children = lookup_join(
        stations.where(~is_parent).drop(*inherited), parents, {"Parent": "_parent"}, "SeqNo"
    ).select(*stations.columns)
    everyone = stations.where(is_parent).unionByName(children)
    return everyone.withColumn("ZIP_Group_Station", zip_group(F.col("PLZ")))
