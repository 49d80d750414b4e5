"""What the nearest join copies and broadcasts."""

import pytest

from pyspark.sql import functions as F

from nearstop.functions.geo import grid
from nearstop.operators.nearest import (
    Limits, _candidate_points, _first_level, _near, _query_points, _settle, _tree, nearest_join,
)
from tests.test_nearest import CANDIDATE, QUERY, brute, cloud, run


def test_places_share_the_candidates_of_a_query_cell(spark):
    queries, candidates = cloud(21, 3000, "q", hot=1.0), cloud(22, 3000, "p", hot=1.0)
    limits = Limits(group=50, settled=40)
    xy = {"_x": "_lat", "_y": "_lng"}
    points = _candidate_points(
        spark.createDataFrame(candidates, CANDIDATE), 5, ["pid"], "g", ("lat", "lng")
    ).withColumns({name: grid(F.col(of)) for name, of in xy.items()})
    places = _query_points(
        spark.createDataFrame(queries, QUERY), "g", ("lat", "lng")
    ).select("_group", "_qlat", "_qlng").distinct()
    places = places.withColumns({name: grid(F.col(f"_q{of[1:]}")) for name, of in xy.items()})
    first = _first_level(points)
    cells, leaves = _tree(points, first, limits)
    tiles, located = _settle(cells, places, first, 1, 5, limits)
    near, homes = _near(tiles, leaves, located, limits)
    assert homes.count() == places.count()
    copied = near.select(F.inline("_chunks")).agg(F.sum("_n")).first()[0]
    # Each settled cell with a copy of its own would take several times as many.
    assert 4 * copied < tiles.agg(F.sum("_total")).first()[0]
    assert copied < 10 * places.count()


@pytest.mark.parametrize("limits", [
    Limits(group=50, settled=40, shared=300), Limits(group=50, settled=4, shared=0),
])
def test_shared_cells_give_the_nearest(spark, limits):
    queries, candidates = cloud(23, 400, "q"), cloud(24, 900, "p", tight=0.0005)
    assert run(spark, queries, candidates, 7, limits) == brute(queries, candidates, 7)


def test_stored_tables_are_not_broadcast_by_the_size_of_their_files(spark):
    found = nearest_join(
        spark.createDataFrame(cloud(25, 300, "q"), QUERY),
        spark.createDataFrame(cloud(26, 300, "p"), CANDIDATE), 3, ["pid"], group=("g", "g"),
        limits=Limits(group=20, settled=10, broadcast_bytes=-1),
    )
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
