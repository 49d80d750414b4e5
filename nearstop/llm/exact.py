"""Exact deduplication by a 128-bit content hash, with the bytes compared inside groups.

Texts are equal when they agree after white space is deleted. Rows are grouped by a hash of what is
left, as narrow rows without texts. Only texts of hashes that several rows share are compared: they
are grouped by their bytes, so copies fold into one before they are shuffled, and a hash with more
than one text is split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearstop.scratch import materialise

#: White space that does not count.
SPACE = " \t\n\x0b\x0c\r"


def content_hash(digest: Column) -> Column:
    """128 bits of the SHA-256 digest of a normalised text."""
    return F.substring(digest, 1, 16)


def _read(documents: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """doc_id, hash, digest, length and normalised text of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id", F.length(text).cast("long").alias("length"),
        F.translate(text, SPACE, "").alias("body"),
    ).withColumn("digest", F.unhex(F.sha2("body", 256)))
    return rows.select("doc_id", hashed(F.col("digest")).alias("hash"), "digest", "length", "body")


def exact_groups(
    documents: DataFrame, hashed: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """The group of equal texts of every row of ``documents`` (doc_id, text; extras are ignored).

    One row per row: doc_id, keep_id (doc_id of the row of the group that stays), group_size, kept,
    text_sha256 (of the normalised text). The row with the most code points in its original text
    stays; of these the one with the least doc_id, a null one last; of rows equal in that too, any
    one. A null text is empty, and empty texts equal those of white space only. An empty table
    gives an empty result. ``hashed`` makes the hash from the digest.
    """
    rows = _read(documents, hashed)
    narrow = materialise(
        rows.drop("body").withColumn("_row", F.monotonically_increasing_id()), "hashes"
    )
    shared = materialise(
        narrow.groupBy("hash").count().where("count > 1").select("hash"), "shared"
    )
    # Copies become one row in each task before the shuffle, however many there are.
    texts = rows.select("hash", "body").join(shared, "hash", "left_semi").groupBy(
        "hash", "body"
    ).agg(F.count(F.lit(1)).alias("rows"))
    mixed = materialise(
        texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
        .select("hash"), "collisions",
    )
    keyed = narrow.withColumn("_text", F.lit(None).cast("string"))
    if not mixed.isEmpty():
        # Rows of a hash that stands for several texts carry their text from here on.
        apart = rows.join(mixed, "hash", "left_semi").select(
            "doc_id", "hash", "digest", "length", F.monotonically_increasing_id().alias("_row"),
            F.col("body").alias("_text"),
        )
        keyed = materialise(
            keyed.join(mixed, "hash", "left_anti").select(apart.columns).unionByName(apart),
            "apart",
        )
    best = F.min(F.struct(
        -F.col("length"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row")
    )).alias("_best")
    groups = keyed.groupBy("hash", "_text").agg(
        F.count(F.lit(1)).alias("group_size"), best
    ).select(
        F.col("hash").alias("_hash"), F.col("_text").alias("_same"), "group_size",
        F.col("_best.doc_id").alias("keep_id"), F.col("_best._row").alias("_keeper"),
    ).where("group_size > 1")
    # Only rows of shared hashes have a group to look up; a hot group is split on this side.
    joined = keyed.join(
        groups, (F.col("hash") == F.col("_hash")) & F.col("_text").eqNullSafe(F.col("_same")),
        "left",
    )
    alone = F.col("_keeper").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("_row") == F.col("_keeper"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
