"""The nearest join against a comparison of all pairs."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from nearstop.functions.geo import grid
from nearstop.operators.nearest import (
    Limits, _candidate_points, _first_level, _tree, nearest_join,
)

QUERY = "id string, g string, lat double, lng double"
CANDIDATE = "pid string, g string, lat double, lng double"
SPLIT = Limits(group=50, settled=40)


def brute(queries, candidates, k, grouped=True):
    found = []
    points = sorted(set(candidates), key=lambda p: p[0])
    for number, group, lat, lng in queries:
        if lat is None or lng is None or math.isnan(lat) or math.isnan(lng):
            continue
        near = [
            ((lat - p[2]) * (lat - p[2]) + (lng - p[3]) * (lng - p[3]), p[0])
            for p in points
            if p[2] is not None and p[3] is not None and (not grouped or p[1] == group)
            and (not grouped or group is not None)
        ]
        found += [(number, n, pid) for n, (_, pid) in enumerate(sorted(near)[:k], 1)]
    return sorted(found)


def run(spark, queries, candidates, k, limits, grouped=True):
    found = nearest_join(
        spark.createDataFrame(queries, QUERY), spark.createDataFrame(candidates, CANDIDATE), k,
        ["pid"], group=("g", "g") if grouped else None, limits=limits,
    )
    return sorted(tuple(r) for r in found.select("id", "rank", "pid").collect())


def cloud(seed, n, prefix, hot=0.4, tight=0.002, shift=0.0):
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < hot, "hot", np.array(["a", "b", "c"])[rng.integers(0, 3, n)])
    dense = rng.random(n) < 0.5
    lat = np.where(dense, 51 + rng.normal(0, tight, n), 50 + 2 * rng.random(n)) + shift
    lng = np.where(dense, 9 + rng.normal(0, tight, n), 8 + 2 * rng.random(n))
    lat, lng = lat.round(4), lng.round(4)
    return [(f"{prefix}{i}", str(group[i]), float(lat[i]), float(lng[i])) for i in range(n)]


@pytest.mark.parametrize("limits", [
    Limits(), SPLIT, Limits(group=50, settled=12), Limits(group=200, settled=40, broadcast_bytes=0),
])
def test_equals_all_pairs(spark, limits):
    queries, candidates = cloud(1, 300, "q"), cloud(2, 600, "p")
    assert run(spark, queries, candidates, 10, limits) == brute(queries, candidates, 10)


def test_far_queries_and_one_crowded_place(spark):
    # Queries far off a dense cluster, and 200 candidates at a single place.
    queries = cloud(3, 60, "q", hot=1.0, tight=0.0001, shift=30.0)
    candidates = cloud(4, 400, "p", hot=1.0, tight=0.0001)
    candidates += [(f"x{i:03}", "hot", 51.5, 9.5) for i in range(200)]
    queries += [("at", "hot", 51.5, 9.5), ("south", "hot", -89.0, -179.0)]
    for limits in (Limits(), SPLIT):
        assert run(spark, queries, candidates, 5, limits) == brute(queries, candidates, 5)


def test_without_groups(spark):
    queries, candidates = cloud(5, 100, "q"), cloud(6, 200, "p")
    for limits in (Limits(), SPLIT):
        assert run(spark, queries, candidates, 1, limits, grouped=False) \
            == brute(queries, candidates, 1, grouped=False)


@pytest.mark.parametrize("limits", [Limits(), Limits(group=0, settled=1)])
def test_edges(spark, limits):
    queries = [
        ("few", "a", 1.0, 1.0), ("null", "a", None, 1.0), ("nan", "a", 1.0, float("nan")),
        ("no group", None, 1.0, 1.0), ("empty", "z", 1.0, 1.0), ("few", "a", 1.0, 1.0),
    ]
    candidates = [
        ("p2", "a", 1.0, 2.0), ("p1", "a", 2.0, 1.0), ("p1", "a", 2.0, 1.0),
        ("p3", "a", 9.0, 9.0), (None, "a", 1.0, 1.0), ("p4", "a", None, 1.0),
        ("p5", None, 1.0, 1.0), ("p6", "a", float("nan"), 1.0), ("p7", "a", 1.0, float("inf")),
    ]
    expected = [("few", 1, "p1"), ("few", 2, "p2"), ("few", 3, "p3")] * 2
    assert run(spark, queries, candidates, 10, limits) == sorted(expected)


def test_nothing_to_join(spark):
    queries, candidates = cloud(1, 30, "q", hot=1.0), cloud(2, 200, "p", hot=1.0)
    elsewhere = [(number, "other", lat, lng) for number, _, lat, lng in queries]
    for limits in (Limits(), SPLIT):
        assert run(spark, elsewhere, candidates, 3, limits) == []
        assert run(spark, queries, [], 3, limits) == []
        assert run(spark, [], candidates, 3, limits) == []


def test_places_are_limited_before_the_shuffle(spark):
    points = _candidate_points(
        spark.createDataFrame(cloud(1, 50, "p"), CANDIDATE), 3, ["pid"], "g", ("lat", "lng")
    )
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_result_does_not_depend_on_partitions(spark):
    queries, candidates = cloud(7, 100, "q"), cloud(8, 200, "p")
    answers = []
    for parts in (1, 5):
        found = nearest_join(
            spark.createDataFrame(queries, QUERY).repartition(parts),
            spark.createDataFrame(candidates, CANDIDATE).repartition(parts), 3, ["pid"],
            group=("g", "g"), limits=SPLIT,
        )
        answers.append(sorted(tuple(r) for r in found.select("id", "rank", "pid").collect()))
    assert answers[0] == answers[1]


point = st.tuples(st.integers(-3, 3), st.integers(-3, 3))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(point, min_size=1, max_size=12), st.lists(point, min_size=1, max_size=40))
def test_ties_on_a_lattice(spark, asked, given_points):
    queries = [(f"q{i:02}", "a", float(x), float(y)) for i, (x, y) in enumerate(asked)]
    candidates = [(f"p{i:02}", "a", float(x), float(y)) for i, (x, y) in enumerate(given_points)]
    expected = brute(queries, candidates, 4)
    for limits in (Limits(), Limits(group=3, settled=4)):
        assert run(spark, queries, candidates, 4, limits) == expected


def test_no_pair_rows(spark):
    # The plan of a split-free join has no shuffle or sort above the join with the lists.
    queries = spark.createDataFrame(cloud(9, 50, "q"), QUERY)
    candidates = spark.createDataFrame(cloud(10, 50, "p"), CANDIDATE)
    found = nearest_join(queries, candidates, 3, ["pid"], group=("g", "g"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    above_join = plan[:plan.index("HashJoin")]
    assert "Exchange" not in above_join and "Window" not in above_join


def test_each_candidate_is_in_one_small_leaf(spark):
    rows = cloud(11, 3000, "p", hot=0.7, tight=0.0005)
    points = _candidate_points(
        spark.createDataFrame(rows, CANDIDATE), len(rows), ["pid"], "g", ("lat", "lng")
    ).withColumns({"_x": grid(F.col("_lat")), "_y": grid(F.col("_lng"))})
    levels, leaves = _tree(points, _first_level(points), SPLIT)
    found = leaves.selectExpr("_depth", "_chunk._n AS n", "explode(_chunk._points._match.pid) AS pid")
    found = found.collect()
    assert sorted(r.pid for r in found) == sorted(r[0] for r in rows)
    assert max(r.n for r in found) <= SPLIT.settled and len({r._depth for r in found}) > 2
    # The cells of a level are what lies in divided cells of the level above, however crowded.
    sizes = [level.groupBy().agg(F.sum("_n")).first()[0] for level in levels]
    divided = [level.where("NOT _leaf").groupBy().agg(F.sum("_n")).first()[0] for level in levels]
    assert sizes[0] == len(rows) and sizes[1:] == divided[:-1] and divided[-1] is None
