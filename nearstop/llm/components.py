"""Connected components of a graph of links, by hooking to the least label and jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.scratch import materialise


def connected(links: DataFrame) -> DataFrame:
    """key and label for every end of ``links`` (a, b): the least key that links lead to.

    Each round gives a label the least label across its links, then lets labels follow their own
    label, so chains shorten by halves. Every round is a stored table; it ends when no label moved.
    """
    ends = links.select(F.col("a").alias("key"), F.col("b").alias("other"))
    edges = materialise(ends.unionByName(
        ends.select(F.col("other").alias("key"), F.col("key").alias("other"))
    ), "edges")
    labels = materialise(edges.groupBy("key").agg(
        F.least(F.min("key"), F.min("other")).alias("label")
    ), "labels")
    while True:
        jumped = labels.select(
            "key", F.col("label").alias("old")
        ).join(
            labels.select(F.col("key").alias("old"), F.col("label").alias("via")), "old", "left"
        ).select("key", "old", F.coalesce("via", "old").alias("label"))
        jumped = materialise(jumped, "jumped")
        seen = edges.join(
            jumped.select(F.col("key").alias("other"), F.col("label").alias("near")), "other"
        ).groupBy("key").agg(F.min("near").alias("near"))
        # The label itself is hooked too, so a whole group moves with one of its members.
        hooks = seen.join(jumped, "key").groupBy(F.col("label").alias("key")).agg(
            F.min("near").alias("hook")
        )
        fresh = jumped.join(seen, "key", "left").join(hooks, "key", "left").select(
            "key", "old", F.least(
                "label", F.coalesce("near", "label"), F.coalesce("hook", "label")
            ).alias("label"),
        )
        fresh = materialise(fresh, "labels")
        moved = fresh.where("label <> old").limit(1).count()
        labels = fresh.select("key", "label")
        if not moved:
            return labels
