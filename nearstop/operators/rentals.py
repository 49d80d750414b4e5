"""Zip codes, addresses and groups of rental offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.functions import text

_ZIP_PARTS = ("geo_plz", "geo_krs", "geo_bln")


def with_repaired_zip(rentals: DataFrame) -> DataFrame:
    """Complete the zip codes that lost a digit."""
    return rentals.withColumn("geo_plz", text.repaired_zip(*map(F.col, _ZIP_PARTS)))


def short_zips(rentals: DataFrame) -> DataFrame:
    """The zip codes that do not start with five digits, with their place, in order.

    The id comes last in the order, so that the sort can spread rows of one zip code over tasks.
    """
    return (
        rentals.where(text.is_short_zip(F.col("geo_plz"))).select("scoutId", *_ZIP_PARTS)
        .orderBy("geo_krs", "geo_bln", "geo_plz", "scoutId")
    )


def with_address(rentals: DataFrame) -> DataFrame:
    """Drop offers without a known street, clean the address parts and join them.

    A missing part, such as the house number, leaves ``address_string`` null.
    """
    kept = text.nan_to_null(rentals).where(text.is_known_street(F.col("streetPlain")))
    cleaned = kept.withColumns({
        "streetPlain": text.clean_street(F.col("streetPlain")),
        "houseNumber": text.clean_house_number(F.col("houseNumber")),
        "geo_krs": text.clean_district(F.col("geo_krs")),
        "geo_bln": text.clean_state(F.col("geo_bln")),
    })
    parts = ("streetPlain", "houseNumber", *_ZIP_PARTS)
    return cleaned.withColumn("address_string", text.address(*map(F.col, parts)))


def zip_groups(rentals: DataFrame) -> DataFrame:
    """The distinct zip groups of the offers."""
    return rentals.select(text.zip_group(F.col("geo_plz")).alias("ZIP_Group_Rental")).distinct()


def with_zip_group(rentals: DataFrame) -> DataFrame:
    return rentals.withColumn("zip_group", text.zip_group(F.col("geo_plz")))
