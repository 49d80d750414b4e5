"""Exact k-nearest join of any number of query points with any number of candidate points.

The candidates of a group travel as one row: a list of chunks of nearby points, each with its box
and its number of points. Every query row picks its k nearest from that list, looking only into
chunks whose gap to it is at most the distance within which k candidates are certain. No pair of
points is ever a row, and nothing is shuffled after the join.

Large groups are split by a grid that gets finer level by level. Candidates form a tree of cells
whose leaves hold few of them. Query places are handled by cell, not one by one: a query cell keeps
the candidate cells that may hold one of its k nearest, by the same rule of gap and certain
distance. If those are leaves that hold few candidates for its number of places the cell is settled,
and they are the chunks its places pick from; otherwise its child cells go on with the leaves and
the children of the other cells that it kept. Neighbouring settled cells keep much the same leaves,
so those below one cell share a copy of all that any of them kept. The work grows with the number of query cells that lie close to many candidates,
whatever share of the rows a single group, cell or place holds, and the result equals a comparison
of all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearstop.functions.geo import (
    MAX_LEVEL, SIDES, SPLIT_BITS, box, cell, cell_width, distance2, gap2, grid,
    is_located, parent_cell, span2,
)
from nearstop.scratch import materialise


@dataclass(frozen=True)
class Limits:
    """When groups are split, query cells settled and tables broadcast."""

    group: int = 2048  # candidates above which a group is split by the grid
    settled: int = 256  # candidates kept, for each distinct place, up to which a cell is settled
    shared: int = 8192  # candidates in one copy that many places pick from
    broadcast_bytes: int = 8 << 20  # measured size up to which a table is broadcast


KEY_BYTES = 320  # generous size of a group, or of a cell, in the hash table of a broadcast
FIRST_CELLS = 36  # most candidate cells a group can have on the first level


def _broadcast_if(size: int, table: DataFrame, limits: Limits) -> DataFrame:
    """Broadcast ``table`` if its measured ``size`` in bytes allows."""
    return F.broadcast(table) if size <= limits.broadcast_bytes else _shuffled(table)


def _shuffled(table: DataFrame) -> DataFrame:
    """Join ``table`` by a shuffle: Spark would broadcast a stored one by the size of its files, a
    small part of that in memory."""
    return table.hint("merge")


def nearest_join(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    payload: list[str],
    *,
    group: tuple[str, str] | None = None,
    query_point: tuple[str, str] = ("lat", "lng"),
    candidate_point: tuple[str, str] = ("lat", "lng"),
    limits: Limits = Limits(),
) -> DataFrame:
    """Join each query row with its ``k`` nearest candidates of the same group.

    Returns the columns of ``queries``, ``rank`` from 1 and the ``payload`` columns of the
    candidate. Equal distances are ordered by payload. Candidates equal in payload and point count
    once; those with a null in either are left out. Query rows without coordinates or group, or
    whose group has no candidates, give no rows. ``group`` names the group column of each side.
    """
    points = _candidate_points(candidates, k, payload, group and group[1], candidate_point)
    points = materialise(points, "candidates")
    asked = _query_points(queries, group and group[0], query_point)
    sizes = points.groupBy("_group").agg(
        F.count("*").alias("_n"), F.sum(_row_bytes(points)).alias("_bytes")
    )
    is_large = F.col("_n") > limits.group
    measured = sizes.agg(
        F.count_if(is_large).alias("large_groups"),
        F.sum(F.when(~is_large, F.col("_bytes"))).alias("small_bytes"),
    ).first()
    rest = points
    if measured.large_groups:
        asked = materialise(asked, "asked")
        large = sizes.where(is_large).select("_group")
        large = _broadcast_if(measured.large_groups * KEY_BYTES, large, limits)
        rest = points.join(large, "_group", "left_anti")
    lists = rest.groupBy("_group").agg(F.collect_list(F.struct(*_POINT)).alias("_points"))
    lists = lists.select("_group", _packed("_points").alias("_chunks"))
    lists = _broadcast_if(measured.small_bytes or 0, lists, limits)
    found = asked.join(lists, "_group").select(*queries.columns, _picked(k).alias("_picks"))
    if measured.large_groups:
        answers = _answers_by_grid(
            asked.join(large, "_group", "left_semi"), points.join(large, "_group", "left_semi"),
            measured.large_groups, k, limits,
        )
        found = found.unionByName(
            asked.join(_shuffled(answers), ["_group", "_qlat", "_qlng"]).select(*queries.columns, "_picks")
        )
    # Picks are never empty. The outer form keeps Spark from adding a filter that says so, which
    # would compute them again in the join condition.
    ranked = found.select(*queries.columns, F.posexplode_outer("_picks").alias("_pos", "_pick"))
    return ranked.select(*queries.columns, (F.col("_pos") + 1).alias("rank"), "_pick.m.*")


_POINT = ["_lat", "_lng", "_match"]


def _group(name: str | None, lat: str) -> Column:
    """The group column; without one all rows get false, computed so that the join has a key."""
    return F.col(name) if name else F.isnan(F.col(lat).cast("double"))


def _candidate_points(candidates, k, payload, group, point) -> DataFrame:
    """Distinct candidates, at most the first ``k`` by payload at any one place.

    No query can have more than ``k`` matches at one place, so the others never rank.
    """
    place = ["_group", "_lat", "_lng"]
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in payload])
    distinct = candidates.where(complete).select(
        _group(group, point[0]).alias("_group"),
        F.col(point[0]).cast("double").alias("_lat"),
        F.col(point[1]).cast("double").alias("_lng"),
        F.struct(*payload).alias("_match"),
    ).where(F.col("_group").isNotNull() & is_located(F.col("_lat"), F.col("_lng"))).distinct()
    at_place = Window.partitionBy(*place).orderBy("_match")
    return (
        distinct.withColumn("_n", F.row_number().over(at_place))
        .where(F.col("_n") <= k).drop("_n")
    )


def _query_points(queries, group, point) -> DataFrame:
    return queries.withColumns({
        "_group": _group(group, point[0]),
        "_qlat": F.col(point[0]).cast("double"),
        "_qlng": F.col(point[1]).cast("double"),
    }).where(F.col("_group").isNotNull() & is_located(F.col("_qlat"), F.col("_qlng")))


def _row_bytes(points: DataFrame) -> Column:
    """Rough size of a row in memory, from the length of its texts."""
    fields = points.schema["_match"].dataType.fields
    texts = [F.octet_length(f"_match.{f.name}") for f in fields if f.dataType == T.StringType()]
    return reduce(lambda a, b: a + b, texts, F.lit(48 + 16 * len(fields)))


def _with(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also if used inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _packed(points: str) -> Column:
    """Chunks of about equal size of a list of points, cut into strips by latitude and each strip
    by longitude. A chunk of half the square root of the size balances the work of a query on
    boxes of chunks with that on points of the chunks in reach."""
    size = F.size(points)
    chunk = F.ceil(F.sqrt(size) / 2).cast("int")
    strip = (chunk * F.ceil(F.sqrt(size / chunk))).cast("int")

    def cuts(count, length):
        return F.sequence(F.lit(1), count, length)

    def by_longitude(row):
        return F.sort_array(F.transform(row, lambda p: F.struct(p["_lng"], p["_lat"], p["_match"])))

    strips = _with(F.sort_array(points), lambda row: F.transform(
        cuts(size, strip), lambda first: by_longitude(F.slice(row, first, strip))
    ))
    chunks = F.flatten(F.transform(strips, lambda row: F.transform(
        cuts(F.size(row), chunk), lambda first: F.slice(row, first, chunk)
    )))

    def boxed(row):
        lats, lngs = (F.transform(row, lambda p: p[name]) for name in ("_lat", "_lng"))
        return F.struct(
            F.size(row).cast("long").alias("_n"),
            F.array_min(lats).alias("_south"), F.array_max(lats).alias("_north"),
            F.array_min(lngs).alias("_west"), F.array_max(lngs).alias("_east"),
            row.alias("_points"),
        )

    return F.transform(chunks, boxed)


def _in_reach(chunks: str, own: dict[str, Column], k: int) -> Column:
    """The chunks that may hold one of the ``k`` candidates nearest to a point in box ``own``.

    ``k`` candidates are certain within the distance at which the chunks wholly inside it first
    hold so many. A chunk whose gap is larger cannot contribute; one at just that gap can.
    """
    spans = F.sort_array(F.transform(
        chunks, lambda c: F.struct(span2(own, c).alias("reach"), c["_n"].alias("n"))
    ))
    certain = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(float("inf")).alias("reach")),
        lambda seen, c: F.when(seen["n"] >= k, seen).otherwise(
            F.struct((seen["n"] + c["n"]).alias("n"), c["reach"].alias("reach"))
        ),
        lambda seen: F.when(seen["n"] >= k, seen["reach"]).otherwise(F.lit(float("inf"))),
    )
    return _with(certain, lambda reach: F.filter(chunks, lambda c: gap2(own, c) <= reach))


def _picked(k: int) -> Column:
    """The ``k`` candidates in ``_chunks`` nearest to a query point, in order."""
    lat, lng = F.col("_qlat"), F.col("_qlng")
    own = {"_south": lat, "_north": lat, "_west": lng, "_east": lng}

    def away(point):
        return distance2(lat, lng, point["_lat"], point["_lng"])

    def nearest(points):
        last = F.element_at(
            F.sort_array(F.transform(points, away)), F.least(F.lit(k), F.size(points))
        )
        return _with(last, lambda limit: F.slice(F.sort_array(F.transform(
            F.filter(points, lambda p: away(p) <= limit),
            lambda p: F.struct(away(p).alias("d"), p["_match"].alias("m")),
        )), 1, k))

    close = F.flatten(F.transform(_in_reach("_chunks", own, k), lambda c: c["_points"]))
    return _with(close, nearest)


def _answers_by_grid(asked, points, groups, k, limits) -> DataFrame:
    """The nearest candidates of each distinct place in ``asked``, by a grid."""
    points = materialise(
        points.withColumns({"_x": grid(F.col("_lat")), "_y": grid(F.col("_lng"))}), "points"
    )
    places = materialise(
        asked.select("_group", "_qlat", "_qlng").distinct()
        .withColumns({"_x": grid(F.col("_qlat")), "_y": grid(F.col("_qlng"))}),
        "places",
    )
    first = _first_level(points)
    cells, leaves = _tree(points, first, limits)
    tiles, located = _settle(cells, places, first, groups, k, limits)
    near, located = _near(tiles, leaves, located, limits)
    return located.join(_shuffled(near), _TILE).select("_group", "_qlat", "_qlng", _picked(k).alias("_picks"))


_LEAF = ["_group", "_depth", "_cx", "_cy"]
_TILE = ["_group", "_level", "_qx", "_qy"]


#: Levels above a settled query cell at which a copy may be shared; the last that fits counts.
SHARED_LEVELS = (1, 2)


def _near(tiles, leaves, located, limits) -> tuple[DataFrame, DataFrame]:
    """The chunks that query cells share, and the places with the cell whose chunks they pick from.

    A place may so be offered more leaves than its own query cell kept, but never fewer.
    """
    kept = materialise(
        tiles.select(*_TILE, F.inline("_cells")).select(*_TILE, *_LEAF[1:], "_n"), "kept_leaves"
    )
    homes = tiles.select(*_TILE, F.struct(*_TILE[1:]).alias("_home"))
    for up in SHARED_LEVELS:
        above = {"_level": F.col("_level") - up} | {
            name: F.shiftright(name, up * SPLIT_BITS) for name in ("_qx", "_qy")
        }
        fits = (
            kept.withColumns(above).distinct().groupBy(*_TILE).agg(F.sum("_n").alias("_total"))
            .where(F.col("_total") <= limits.shared)
            .select("_group", F.struct(*_TILE[1:]).alias("_above"))
        )
        higher = F.struct(*[above[name].alias(name) for name in _TILE[1:]])
        homes = homes.withColumn("_above", higher).join(
            _shuffled(fits.withColumn("_fits", F.lit(True))), ["_group", "_above"], "left"
        ).select(*_TILE, F.when(F.col("_fits"), F.col("_above")).otherwise(F.col("_home")).alias("_home"))
    homes = materialise(homes, "homes")

    def at_home(rows: DataFrame, names: list[str]) -> DataFrame:
        return rows.join(_shuffled(homes), _TILE).select("_group", "_home.*", *names)

    near = (
        at_home(kept, _LEAF[1:]).distinct().join(_shuffled(leaves), _LEAF)
        .groupBy(*_TILE).agg(F.collect_list("_chunk").alias("_chunks"))
    )
    return near, at_home(located, ["_qlat", "_qlng"])


def _cell_of(level: int) -> dict[str, Column]:
    return {"_cx": cell("_x", level), "_cy": cell("_y", level)}


def _tree(points: DataFrame, first: int, limits: Limits) -> tuple[list[DataFrame], DataFrame]:
    """The candidates as a tree of cells whose leaves hold few of them.

    A cell with more than ``limits.settled`` candidates is divided, any other is a leaf. Returns the
    cells of each level (group, place, number, box, whether they are leaves) and the leaves with
    their candidates. Each candidate is in one leaf, and only cells known to be leaves are gathered.
    """
    levels, leaves, crowd = [], [], None
    for level in range(first, MAX_LEVEL + 1):
        at_level = points.withColumns(_cell_of(level))
        if crowd is not None:
            # Only what lies in a divided cell of the level above goes on.
            above = crowd.withColumnsRenamed({"_cx": "_px", "_cy": "_py"})
            at_level = at_level.withColumns({"_px": parent_cell("_cx"), "_py": parent_cell("_cy")})
            at_level = at_level.join(
                _broadcast_if(crowds * KEY_BYTES, above, limits), ["_group", "_px", "_py"],
                "left_semi",
            ).drop("_px", "_py")
        is_leaf = (F.col("_n") <= limits.settled) | F.lit(level == MAX_LEVEL)
        counted = materialise(at_level.groupBy("_group", "_cx", "_cy").agg(
            F.count("*").alias("_n"), *box("_lat", "_lng")
        ).withColumn("_leaf", is_leaf).withColumn("_depth", F.lit(level)), "cells")
        levels.append(counted)
        found = counted.agg(
            F.count_if(~F.col("_leaf")).alias("crowds"), F.count_if("_leaf").alias("leaves")
        ).first()
        crowds = found["crowds"]
        if found["leaves"]:
            # Points of divided cells are left out before anything is gathered.
            few = at_level
            if crowds:
                divided = counted.where("NOT _leaf").select("_group", "_cx", "_cy")
                few = at_level.join(
                    _broadcast_if(crowds * KEY_BYTES, divided, limits),
                    ["_group", "_cx", "_cy"], "left_anti",
                )
            gathered = few.groupBy("_group", "_cx", "_cy").agg(
                F.count("*").alias("_n"), *box("_lat", "_lng"),
                F.collect_list(F.struct(*_POINT)).alias("_points"),
            )
            leaves.append(materialise(gathered.select(
                "_group", F.lit(level).alias("_depth"), "_cx", "_cy",
                F.struct("_n", *SIDES, "_points").alias("_chunk"),
            ), "leaves"))
        if not crowds:
            break
        crowd = counted.where("NOT _leaf").select("_group", "_cx", "_cy")
    return levels, reduce(DataFrame.unionByName, leaves)


def _settle(cells, places, first, groups, k, limits) -> tuple[DataFrame, DataFrame]:
    """Cover all query places with settled query cells, all of whose candidate cells are leaves.

    Returns these cells with the leaves they kept, and the places with the cell each lies in.
    """
    settled, located = [], []
    offered = _broadcast_if(
        groups * FIRST_CELLS * KEY_BYTES, _first_offer(cells[0]), limits
    )
    open_places = places
    for level in range(first, MAX_LEVEL + 1):
        at_level = open_places.withColumns({"_qx": cell("_x", level), "_qy": cell("_y", level)})
        if level > first:
            offered = _offer(unsettled, cells[level - first] if level - first < len(cells) else None)
            # Places in settled cells are done; the others are met by the cell above.
            above = unsettled.select(
                "_group", F.col("_qx").alias("_ox"), F.col("_qy").alias("_oy")
            )
            at_level = at_level.withColumns({"_ox": parent_cell("_qx"), "_oy": parent_cell("_qy")})
            at_level = at_level.join(
                _broadcast_if(tiles * KEY_BYTES, above, limits), ["_group", "_ox", "_oy"],
                "left_semi",
            ).drop("_ox", "_oy")
        kept = materialise(_keep(offered, _tiles(at_level), k), "kept")
        # What is open only because it kept many leaves gets smaller boxes, unless it is one place.
        few = F.greatest(
            F.lit(limits.settled), F.least(F.lit(limits.shared), limits.settled * F.col("_asked"))
        )
        many = (F.col("_total") > few) & ~F.col("_spot")
        is_open = (F.exists("_cells", lambda c: ~c["_leaf"]) | many) & F.lit(level < MAX_LEVEL)
        found = kept.agg(
            F.count_if(~is_open).alias("settled"), F.count_if(is_open).alias("tiles")
        ).first()
        tiles = found["tiles"]
        done = kept.where(~is_open).withColumn("_level", F.lit(level))
        if found["settled"] or not (tiles or settled):
            settled.append(done)
            located.append(materialise(at_level.withColumn("_level", F.lit(level)).join(
                _broadcast_if(found["settled"] * KEY_BYTES, done.select(*_TILE), limits), _TILE,
                "left_semi",
            ).select(*_TILE, "_qlat", "_qlng"), "located"))
        if not tiles:
            break
        unsettled = kept.where(is_open)
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, located)


def _first_level(points: DataFrame) -> int:
    """The finest level at which no group has more than five candidate cells a side."""
    spans = points.groupBy("_group").agg(
        F.greatest(F.max("_x") - F.min("_x"), F.max("_y") - F.min("_y")).alias("span")
    )
    widest = spans.agg(F.max("span")).first()[0] or 0
    fine = [n for n in range(MAX_LEVEL + 1) if 4 * cell_width(n) >= widest]
    return max(fine, default=0)


def _tiles(places: DataFrame) -> DataFrame:
    """Query cells with the number and the box of their query places."""
    return places.groupBy("_group", "_qx", "_qy").agg(
        F.count("*").alias("_asked"), *box("_qlat", "_qlng")
    )


_CELL = ["_depth", "_cx", "_cy", "_n", "_leaf", *SIDES]


def _first_offer(cells: DataFrame) -> DataFrame:
    """All candidate cells of each group."""
    return cells.groupBy("_group").agg(F.collect_list(F.struct(*_CELL)).alias("_cells"))


def _offer(kept: DataFrame, cells: DataFrame | None) -> DataFrame:
    """The candidate cells each query cell hands down: its leaves and the children of the others."""
    tile = ["_group", F.col("_qx").alias("_ox"), F.col("_qy").alias("_oy")]
    handed = kept.select(*tile, F.filter("_cells", lambda c: c["_leaf"]).alias("_cells"))
    if cells is not None:
        children = cells.groupBy(
            "_group", parent_cell("_cx").alias("_px"), parent_cell("_cy").alias("_py")
        ).agg(F.collect_list(F.struct(*_CELL)).alias("_children"))
        divided = kept.select(
            *tile, F.explode(F.filter("_cells", lambda c: ~c["_leaf"])).alias("_cell")
        ).select("_group", "_ox", "_oy", F.col("_cell._cx").alias("_px"), F.col("_cell._cy").alias("_py"))
        handed = handed.unionByName(divided.join(_shuffled(children), ["_group", "_px", "_py"]).select(
            "_group", "_ox", "_oy", F.col("_children").alias("_cells")
        ))
    return handed.groupBy("_group", "_ox", "_oy").agg(
        F.flatten(F.collect_list("_cells")).alias("_cells")
    )


def _keep(offered: DataFrame, tiles: DataFrame, k: int) -> DataFrame:
    """Keep the offered cells that may hold one of the ``k`` nearest of the query cell."""
    if "_ox" in offered.columns:
        tiles = tiles.withColumns({"_ox": parent_cell("_qx"), "_oy": parent_cell("_qy")})
        paired = tiles.join(_shuffled(offered), ["_group", "_ox", "_oy"])
    else:
        paired = tiles.join(offered, "_group")
    own = {side: F.col(side) for side in SIDES}
    spot = (own["_south"] == own["_north"]) & (own["_west"] == own["_east"])
    close = paired.select(
        "_group", "_qx", "_qy", "_asked", spot.alias("_spot"), _in_reach("_cells", own, k).alias("_close")
    )
    return close.select(
        "_group", "_qx", "_qy", "_asked", "_spot", F.col("_close").alias("_cells"),
        F.aggregate("_close", F.lit(0).cast("long"), lambda n, c: n + c["_n"]).alias("_total"),
    )
