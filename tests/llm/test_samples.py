"""Bounded training samples keep rare labels."""

import pytest
from pyspark.sql import functions as F

from nearstop.llm import secrets, toxicity
from nearstop.llm.common import WEIGHT


def test_rare_labels_are_sampled(spark):
    labels = spark.range(60_000).selectExpr(
        "id AS doc_id", "int(id % 2) AS odd", "int(id % 20000 = 7) AS toxic"
    )
    rows = toxicity.sample_labels(labels, ["odd", "toxic"], 1000)
    found = rows.agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.sum(WEIGHT).alias("weight"),
        F.sum(F.col(WEIGHT) * F.col("toxic")).alias("met"),
    ).first()
    assert found.toxic == found.met == 3 and found.n < 1200
    assert found.weight == pytest.approx(60_000, rel=0.15)
    assert toxicity.sample_labels(labels.limit(900), ["odd", "toxic"], 1000).count() == 900


def test_forest_sees_rare_secrets(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("start"), F.col("id").cast("string").alias("token"),
        F.when(F.col("id") % 10_000 == 3, 1.0).otherwise(0.0).alias("label"),
        *[F.rand(n).alias(c) for n, c in enumerate(secrets.FEATURES)],
    )
    for name in ("_named", "_assigned", "_quoted", "_digits"):
        rows = rows.withColumn(name, F.col("label"))
    forest = secrets.train_forest(rows, rows=1000)
    judged = secrets.with_probability(rows, forest).where("probability >= 0.5")
    assert {r.doc_id for r in judged.collect()} == {3, 10_003, 20_003, 30_003}
