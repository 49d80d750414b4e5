"""The most similar text of a register, for texts with slips in them.

Texts that differ in few characters share most of their q-grams. Sorted by how rare they are, the
first few q-grams of two such texts have one in common, so only those go into the inverted index.
Texts that meet there are compared by edit distance within the join, each pair once; pairs beyond
the distance are never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearstop.scratch import materialise

#: Characters inserted, left out or replaced up to which texts are taken for the same.
SLIPS = 2
GRAM = 3
#: Stands before and after a text, so that its ends have q-grams of their own.
EDGE = "\u0001" * (GRAM - 1)
#: The index entry of texts with so few q-grams that slips may change them all.
FEW = ""


def _grams(text: str) -> Column:
    """The distinct q-grams of a text."""
    padded = F.concat(F.lit(EDGE), F.col(text), F.lit(EDGE))
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(padded) - (GRAM - 1)),
        lambda n: F.substring(padded, n, F.lit(GRAM)),
    ))


def _distinct_texts(df: DataFrame, group: str, text: str) -> DataFrame:
    rows = df.select(F.col(group).alias("_group"), F.col(text).alias("_text")).dropna().distinct()
    return materialise(rows.withColumn("_id", F.monotonically_increasing_id()), "texts")


def _exploded(texts: DataFrame) -> DataFrame:
    return texts.select("_group", "_id", F.explode(_grams("_text")).alias("_gram"))


def _index(texts: DataFrame, uses: DataFrame, slips: int) -> DataFrame:
    """One row for each text and entry: its rarest q-grams, as many as slips can change and one."""
    counted = _exploded(texts).join(uses, ["_group", "_gram"], "left").select(
        "_id", F.struct(
            F.coalesce("_uses", F.lit(0)).alias("uses"), F.xxhash64("_gram").alias("place"),
            F.col("_gram").alias("gram"),
        ).alias("_entry"),
    )
    few = F.when(F.size("_sorted") <= GRAM * slips, F.array(F.lit(FEW))).otherwise(
        F.array().cast("array<string>")
    )
    # A text has no more q-grams than characters and edges.
    entries = counted.groupBy("_id").agg(F.array_sort(F.collect_list("_entry")).alias("_sorted"))
    entries = entries.select("_id", F.concat(F.transform(
        F.slice("_sorted", 1, GRAM * slips + 1), lambda e: e.gram
    ), few).alias("_entries"))
    return texts.join(entries, "_id").select(
        "_group", "_text", F.length("_text").alias("_length"), "_entries",
        F.explode("_entries").alias("_gram"),
    )


def best_spellings(
    texts: DataFrame, register: DataFrame, group: str, text: str, slips: int = SLIPS
) -> DataFrame:
    """For each distinct text the one of ``register`` in its group that differs least.

    Both sides have the columns ``group`` and ``text``. Returns these, ``match`` and ``distance``
    (inserted, left out or replaced characters, at most ``slips``); of equally near ones the first
    by text. Texts without such a match give no row, nor do null texts and groups.
    """
    asked, known = _distinct_texts(texts, group, text), _distinct_texts(register, group, text)
    uses = materialise(
        _exploded(known).groupBy("_group", "_gram").agg(F.count(F.lit(1)).alias("_uses")), "grams"
    )
    a, b = _index(asked, uses, slips).alias("a"), _index(known, uses, slips).alias("b")
    # Both lists have one order, so the first entry that they share is the same from either side.
    first = F.get(F.array_intersect("a._entries", "b._entries"), F.lit(0)) == F.col("a._gram")
    distance = F.levenshtein(F.col("a._text"), F.col("b._text"), slips)
    pairs = a.join(b, (
        (F.col("a._group") == F.col("b._group")) & (F.col("a._gram") == F.col("b._gram"))
        & (F.abs(F.col("a._length") - F.col("b._length")) <= slips) & first & (distance >= 0)
    ))
    best = pairs.groupBy("a._group", "a._text").agg(
        F.min(F.struct(distance.alias("distance"), F.col("b._text").alias("match"))).alias("_best")
    )
    return best.select(
        F.col("_group").alias(group), F.col("_text").alias(text), "_best.match", "_best.distance"
    )
