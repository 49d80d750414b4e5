"""Expressions and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but the ASCII white space below.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def group_key(*columns: str) -> Column:
    """The columns as one text that is never null; a null differs from every value."""
    parts = [
        F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")) for c in columns
    ]
    return F.concat_ws("\u0001", *parts)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of ``df``."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def with_row_number(df: DataFrame) -> DataFrame:
    """Add ``_nth``, which tells rows of equal ``_row`` (a ``row_hash``) apart.

    The two agree between any two reads of the same rows, so narrow results can be joined back.
    Rows that collide in the hash but differ are numbered like equal rows, in the order of doc_id,
    so nothing is lost.
    """
    order = Window.partitionBy("_row").orderBy("doc_id")
    return df.withColumn("_nth", F.row_number().over(order))


def shards_for(rows: int, per_shard: int) -> int:
    return max(1, -(-rows // per_shard))


#: How many rows a sampled row stands for.
WEIGHT = "_weight"


def sample_by_label(df: DataFrame, labels: list[str], rows: int, key: list[str]) -> DataFrame:
    """At most about ``rows`` rows, chosen by a hash of ``key``, with their weight.

    ``labels`` are columns of 0 and 1. Of each value of each label up to an equal part of ``rows``
    is expected, so a rare label keeps its rows; a row's weight is one by its chance to be kept.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in labels]
    ).first()
    chance = F.lit(1.0)
    if counts["n"] > rows:
        share = rows / (2 * len(labels))
        chances = [
            F.when(F.col(c) == 1, min(1.0, share / max(1, counts[c])))
            .otherwise(min(1.0, share / max(1, counts["n"] - counts[c]))) for c in labels
        ]
        chance = F.greatest(*chances) if len(chances) > 1 else chances[0]
    place = F.pmod(F.xxhash64(*key), F.lit(1 << 52)) / float(1 << 52)
    return df.withColumn(WEIGHT, 1 / chance).where(place * F.col(WEIGHT) < 1)
