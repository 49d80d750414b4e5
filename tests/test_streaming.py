"""Offers that come in batches, and tables laid out for a query of one offer."""

import random

import pyarrow.parquet as pq
import pytest

from nearstop.operators import match, split
from nearstop.plans import enrich
from nearstop.sinks.tables import write_table
from nearstop.sources.tables import read_table, table_path
from nearstop.streaming.offers import OFFER, nearest_of_batch, stream_nearest_stations
from tests.test_refresh import STATION, stations


@pytest.fixture
def some(spark):
    return spark.createDataFrame(stations(random.Random(8), 60), STATION)


def offers(spark, first, last):
    rows = [(n, ["g", "h", None][n % 3], n % 12 / 2, n % 7 / 2) for n in range(first, last)]
    return spark.createDataFrame(rows, OFFER)


def rows(df):
    return sorted(map(str, df.select("scoutId", "rank", "DHID", "Name", "Latitude").collect()))


def test_batches_equal_one_run(spark, some, tmp_path):
    folder, root, done = (str(tmp_path / name) for name in ("in", "out", "done"))
    for first in (0, 20, 40):
        if first == 40:
            # What came after the stream ended is met by the next one.
            stream_nearest_stations(spark, folder, some, root, done, files_per_batch=1).awaitTermination()
        offers(spark, first, first + 20).coalesce(1).write.mode("append").parquet(folder)
    stream_nearest_stations(spark, folder, some, root, done).awaitTermination()
    found = read_table(spark, "table_nearest_stream", root)
    wanted = match.nearest_stations(offers(spark, 0, 60), some)
    assert rows(found) == rows(wanted)


def test_a_batch_delivered_again_replaces_itself(spark, some, tmp_path):
    root = str(tmp_path)
    store = nearest_of_batch(some, root, "answers", 3)
    for first, batch in ((0, 0), (20, 1), (20, 1), (0, 0)):
        store(offers(spark, first, first + 20), batch)
    wanted = match.nearest_stations(offers(spark, 0, 40), some, 3)
    assert rows(read_table(spark, "answers", root)) == rows(wanted)


def test_one_offer_is_in_one_range(spark, tmp_path):
    root = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.range(4000).selectExpr("int(id * 7919 % 4000) AS scoutId", "id AS x")
        write_table(df, enrich.COORDS, root, sort_by="scoutId")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    path = table_path(root, enrich.COORDS)
    files = read_table(spark, enrich.COORDS, root).inputFiles()
    holding = 0
    for file in files:
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        for n in range(meta.num_row_groups):
            found = meta.row_group(n).column(0).statistics
            holding += found.min <= 1234 <= found.max
    assert len(files) > 1 and holding == 1, path
    plan = read_table(spark, enrich.COORDS, root).where("scoutId = 1234")
    assert plan.count() == 1
    assert "EqualTo(scoutId,1234)" in plan._jdf.queryExecution().executedPlan().toString()


def test_sketches_of_runs_are_merged(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(60_000).selectExpr("id", "IF(id % 10 = 0, NULL, id * 7919 % 60000) AS v")
    for n in range(3):
        split.append_with_sketch(df.where(f"id % 3 = {n}"), "t", root, str(n), ["v"])
    split.append_with_sketch(df.where("false"), "t", root, "none", ["v"])
    split.append_with_sketch(df.where("id % 3 = 1"), "t", root, "1", ["v"])  # again
    values = sorted(r.v for r in df.where("v IS NOT NULL").collect())
    for r in split.stored_quantiles(spark, "t", root, "v", [0.01, 0.5, 0.99]).collect():
        assert r.n_rows == len(values)
        rank = sum(v <= r.value for v in values) / len(values)
        assert abs(rank - r.quantile) <= split.SKETCH_ERROR
    split.append_with_sketch(df.where("false"), "u", root, "none", ["v"])
    assert [r.value for r in split.stored_quantiles(spark, "u", root, "v", [0.5]).collect()] == [None]
