"""Prefix trie of conversations, its nodes in tables addressed by minimal perfect hashes.

A node is a distinct sequence of first turns, known by the 128-bit sum of the hashes of its turns
and their places. Sums add up over any cut of a conversation, so one of any length is spread over
tasks. Counts of a node come from one grouping. Totals over subtrees need the tree: subtrees of a
bounded weight are dealt to shards. A shard gives each of its nodes a slot by a minimal perfect hash
that is verified against the stored digests, scatters the counts into flat arrays, and adds them to
the parents' slots from the deepest nodes up. The few nodes above all shards are added up last.
Nodes that one conversation alone passes need no totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.scratch import materialise

#: A conversation takes its first turns from the one that begins its block of ids: their number is
#: a hash of its id modulo ``LEADS``.
BLOCK, LEADS = 100, 6
#: Turns at and below a node up to which its subtree is dealt as one, and nodes solved together.
BUDGET, TOGETHER = 50_000, 200_000
#: Places of a level of the perfect hash for each key, and levels before the rest is searched.
SPREAD, LEVELS = 2, 40
#: Characters of joined ids that travel as one row.
CHUNK = 1 << 16
NODE = ("depth", "h1", "h2")
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def _salt(n: int) -> np.uint64:
    return np.uint64(n * STEP % 2**64)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _run_sums(ids: np.ndarray, values: np.ndarray, last: tuple | None) -> np.ndarray:
    """Running sums of the columns of ``values`` (modulo 2^64) within runs of equal ids.

    ``last`` is the last id of the batch before and its sums.
    """
    total = np.cumsum(values, axis=0, dtype=np.uint64)
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    before = np.zeros((len(first), values.shape[1]), dtype=np.uint64)
    before[1:] = total[first[1:] - 1]
    if last is not None and last[0] == ids[0]:
        before[0] = np.zeros(values.shape[1], dtype=np.uint64) - last[1]
    return total - np.repeat(before, np.diff(np.r_[first, len(ids)]), axis=0)


def _with_sums(ordered: DataFrame, values_of, names: list[str]) -> DataFrame:
    """Add the sums of ``values_of(batch)`` over the rows of a conversation so far, and ``_part``.

    ``ordered`` is range-partitioned and sorted by conv_id and the order of turns; the sums are of
    this part of a conversation only, see ``_before``.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            sums = _run_sums(ids, values_of(batch), last)
            last = ids[-1], sums[-1]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, *[_signed(c) for c in sums.T],
                pa.array(np.full(len(ids), part, dtype=np.int64)),
            ], names=[*batch.schema.names, *names, "_part"])

    schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields]
        + [f"{c} long" for c in [*names, "_part"]]
    )
    return ordered.mapInArrow(scan, schema)


def _before(summed: DataFrame, order: str, names: list[str]) -> dict[int, tuple[int, list[int]]]:
    """For each part that begins inside a conversation, its id and the sums of the parts before.

    At most one entry for each part; the driver reads two rows of each.
    """
    runs = summed.groupBy("_part", "conv_id").agg(
        F.max(F.struct(order, *[c for c in names if c != order])).alias("_end")
    )
    edges = runs.groupBy("_part").agg(
        F.min(F.struct("conv_id", "_end")).alias("first"),
        F.max(F.struct("conv_id", "_end")).alias("last"),
    ).orderBy("_part").collect()
    found, held, sums = {}, None, [0] * len(names)
    for row in edges:
        if held is not None and held == row["first"]["conv_id"]:
            found[row["_part"]] = held, sums
        else:
            sums = [0] * len(names)
        if row["first"]["conv_id"] != row["last"]["conv_id"]:
            sums = [0] * len(names)
        held = row["last"]["conv_id"]
        sums = [(s + row["last"]["_end"][c]) % 2**64 for s, c in zip(sums, names, strict=True)]
    return found


def _range_sorted(rows: DataFrame, *order) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), the 128-bit hash of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.substring(F.unhex(F.sha2(
            F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256
        )), 1, 16).alias("hash"),
        F.length(text).cast("long").alias("length"),
    )
    ordered = _range_sorted(
        rows, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("hash")
    ).select("conv_id", "hash", "length")
    local = materialise(_with_sums(
        ordered, lambda batch: np.ones((batch.num_rows, 1), dtype=np.uint64), ["place"]
    ), "places")
    rows = [(p, c, s[0]) for p, (c, s) in _before(local, "place", ["place"]).items()]
    # One row for each part at most.
    before = local.sparkSession.createDataFrame(rows, "_part long, conv_id long, _earlier long")
    return local.join(F.broadcast(before), ["_part", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("_earlier", F.lit(0))).alias("place"), "hash",
        "length",
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations (conv_id, depth, size, hash, length), and their sizes.

    The second table has conv_id and size of every conversation, also of those without turns.
    """
    rows = numbered_turns(turns)
    begins = F.col("conv_id") % BLOCK == 0
    counts = materialise(rows.groupBy("conv_id").agg(F.max("place").alias("turns")), "sizes")
    donors = counts.where(begins).select(
        F.col("conv_id").alias("donor"), F.least("turns", F.lit(LEADS - 1)).alias("offered")
    )
    convs = counts.select(
        "conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("donor"),
        (F.crc32(F.col("conv_id").cast("string")) % LEADS).alias("lead"),
    ).join(donors, "donor", "left").withColumn(
        "given", F.least("lead", F.coalesce("offered", F.lit(0)))
    ).withColumn("size", F.col("given") + F.greatest(F.col("turns") - F.col("lead"), F.lit(0)))
    convs = materialise(convs, "rebuilt")
    own = rows.join(convs.select("conv_id", "lead", "given", "size"), "conv_id").where(
        F.col("place") > F.col("lead")
    ).withColumn("depth", F.col("given") + F.col("place") - F.col("lead"))
    heads = rows.where(begins & (F.col("place") < LEADS)).select(
        F.col("conv_id").alias("donor"), F.col("place").alias("depth"), "hash", "length"
    )
    given = convs.where("given > 0").join(heads, "donor").where(F.col("depth") <= F.col("given"))
    names = ["conv_id", "depth", "size", "hash", "length"]
    return own.select(names).unionByName(given.select(names)), convs.select("conv_id", "size")


def _paths(rebuilt: DataFrame, seed: int) -> DataFrame:
    """conv_id, depth, size, length, the node (h1, h2) of each rebuilt turn and its parent's."""

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        halves = np.frombuffer(b"".join(batch.column("hash").to_pylist()), dtype=np.uint64)
        place = (_numbers(batch, "depth") + np.uint64(seed << 40)) * np.uint64(STEP)
        return _mix(halves.reshape(-1, 2) + _mix(place)[:, None])

    ordered = _range_sorted(rebuilt, F.col("conv_id"), F.col("depth"))
    local = materialise(_with_sums(ordered, hashes, ["h1", "h2"]), "sums")
    before = _before(local, "depth", ["depth", "h1", "h2"])
    starts = {part: (held, sums[1:]) for part, (held, sums) in before.items()}

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = np.stack([_numbers(batch, c) for c in ("h1", "h2")], axis=1)
            parts, ids = (batch.column(c).to_numpy() for c in ("_part", "conv_id"))
            for part in np.intersect1d(parts, list(starts)) if starts else ():
                held, sums = starts[int(part)]
                nodes[(parts == part) & (ids == held)] += np.array(sums, dtype=np.uint64)
            above = nodes - hashes(batch)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in ("conv_id", "depth", "size", "length")],
                *[_signed(c) for c in (*nodes.T, *above.T)],
            ], names=["conv_id", "depth", "size", "length", "h1", "h2", "q1", "q2"])

    names = ["conv_id", "depth", "size", "length", "h1", "h2", "q1", "q2"]
    return local.mapInArrow(shift, ", ".join(f"{c} long" for c in names))


def _nodes(paths: DataFrame, convs: DataFrame) -> tuple[DataFrame, bool]:
    """One row per node, and whether two sequences share a hash.

    The rows of a node agree in its parent's hash; as parents do so too, they are one sequence.
    """
    same = ("q1", "q2", "length")
    found = materialise(paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("below"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_") for c in same],
    ), "nodes")
    mixed = not found.where(" OR ".join(f"{c} <> {c}_" for c in same)).isEmpty()
    zero = F.lit(0).cast("long")
    root = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("size") + 1).alias("below"),
    ).where("n_convs > 0").select(
        *[zero.alias(c) for c in NODE], "conv_id", "n_convs", "below",
        *[zero.alias(c) for c in same],
    )
    return found.select(root.columns).unionByName(root), mixed


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: each gets a slot of its own below their number.

    On each level a key takes its place if no other wants it; the others go on to the next one.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, self.size = [], 0
        while len(keys) and len(self.levels) < LEVELS:
            place = self._place(keys, len(self.levels), SPREAD * len(keys))
            wanted = np.bincount(place, minlength=SPREAD * len(keys))
            alone = wanted == 1
            self.levels.append((alone, np.cumsum(alone) - 1 + self.size))
            self.size += int(alone.sum())
            keys = keys[wanted[place] != 1]
        self.rest = np.sort(keys)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(keys + _salt(level + 1)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slots of the keys; one that has none may get -1 or the slot of another."""
        out = np.full(len(keys), -1, dtype=np.int64)
        for level, (alone, rank) in enumerate(self.levels):
            left = np.flatnonzero(out < 0)
            place = self._place(keys[left], level, len(alone))
            out[left[alone[place]]] = rank[place[alone[place]]]
        left = np.flatnonzero(out < 0)
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            out[left] = np.where(self.rest[at] == keys[left], self.size + at, -1)
        return out


def _keys(depth: np.ndarray, h1: np.ndarray, h2: np.ndarray, seed: int) -> np.ndarray:
    return _mix(_mix(h1 + _salt(seed)) + h2) + depth


def solve(columns: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Totals of leaves and saved over the subtree of each node, among the given nodes.

    ``columns`` has depth, h1, h2 (the node), q1, q2 (its parent), leaves and saved.
    """
    node = [columns[c] for c in NODE]
    parent = [columns["depth"] - np.uint64(1), columns["q1"], columns["q2"]]
    for seed in range(64):
        keys = _keys(*node, seed)
        if len(np.unique(keys)) == len(keys):
            break
    else:
        raise ValueError("nodes are repeated")
    table = PerfectHash(keys)
    slot = table.slots(keys)
    # The digests of the nodes by slot; what is looked up is compared with them.
    held = [np.empty(len(keys), dtype=np.uint64) for _ in node]
    for stored, values in zip(held, node, strict=True):
        stored[slot] = values
    above = table.slots(_keys(*parent, seed))
    known = above >= 0
    for stored, values in zip(held, parent, strict=True):
        known &= stored[above] == values
    leaves, saved = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    leaves[slot], saved[slot] = columns["leaves"], columns["saved"]
    parent_slot = np.full(len(keys), -1, dtype=np.int64)
    parent_slot[slot] = np.where(known, above, -1)
    depth = held[0]
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts)[::-1]:
        level = level[parent_slot[level] >= 0]
        np.add.at(leaves, parent_slot[level], leaves[level])
        np.add.at(saved, parent_slot[level], saved[level])
    return leaves[slot], saved[slot]


SOLVED = "depth long, h1 long, h2 long, leaves long, saved long"


def _solve_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solve whole subtrees, many of them together; rows come sorted by c1 and c2, their tops."""
    names = [*NODE, "q1", "q2", "leaves", "saved"]

    def solved(rows: pa.Table) -> pa.RecordBatch:
        columns = {c: rows.column(c).to_numpy() for c in names}
        columns |= {c: columns[c].view(np.uint64) for c in names[:5]}
        leaves, saved = solve(columns)
        return pa.RecordBatch.from_arrays(
            [_signed(columns[c]) for c in NODE] + [pa.array(leaves), pa.array(saved)],
            names=[*NODE, "leaves", "saved"],
        )

    held, waiting = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        waiting += batch.num_rows
        if waiting < TOGETHER:
            continue
        rows = pa.Table.from_batches(held)
        tops = np.stack([rows.column(c).to_numpy() for c in ("c1", "c2")], axis=1)
        # The last subtree may go on in the next batch.
        begin = int(np.flatnonzero((tops != tops[-1]).any(axis=1)).max(initial=-1)) + 1
        if begin:
            yield solved(rows.slice(0, begin))
        held, waiting = rows.slice(begin).to_batches(), rows.num_rows - begin
    if held:
        yield solved(pa.Table.from_batches(held))


def _subtree_totals(nodes: DataFrame, paths: DataFrame, budget: int) -> DataFrame:
    """leaves and saved of every node (NODE) that several conversations pass.

    Nodes with more than ``budget`` turns at and below them are above the shards. There are no more
    than all turns by the budget for each depth.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = nodes.where("n_convs > 1").select(
        *NODE, "q1", "q2", "conv_id", "below",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_single")).cast("long")
        .alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("length")).alias("saved"),
    )
    zero = F.lit(0).cast("long")
    heavy = materialise(shared.where(F.col("below") > budget), "heavy")
    if heavy.isEmpty():
        whole = shared.select("*", zero.alias("c1"), zero.alias("c2"))
        return whole.coalesce(1).mapInArrow(_solve_shard, SOLVED)
    # Heavy nodes lie at the beginning of a conversation; the one below the last begins a subtree.
    last = paths.join(heavy.select(*NODE), list(NODE)).groupBy("conv_id").agg(
        F.max("depth").alias("_last")
    )
    tops = paths.join(last, "conv_id", "left").where(
        F.col("depth") == F.coalesce("_last", F.lit(0)) + 1
    ).select("conv_id", F.col("h1").alias("c1"), F.col("h2").alias("c2"))
    light = materialise(
        shared.where(F.col("below") <= budget).join(tops, "conv_id"), "light"
    )
    solved = materialise(
        light.repartition(parts, "c1", "c2").sortWithinPartitions("c1", "c2")
        .mapInArrow(_solve_shard, SOLVED), "solved",
    )
    sums = light.where("h1 = c1 AND h2 = c2").select(*NODE, "q1", "q2").join(
        solved, list(NODE)
    ).groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("h1"), F.col("q2").alias("h2")).agg(
        F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")
    )
    above = heavy.join(sums, list(NODE), "left").select(
        *NODE, "q1", "q2", (F.col("leaves") + F.coalesce("_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("_saved", zero)).alias("saved"), zero.alias("c1"),
        zero.alias("c2"),
    )
    return solved.unionByName(above.coalesce(1).mapInArrow(_solve_shard, SOLVED))


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """NODE and ends_sha256 of every node at which conversations end.

    Ids are sorted and joined in many tasks; only the hashing of one node's ids is one task's work.
    """
    zero = F.lit(0).cast("long")
    ends = paths.where("depth = size").select(*NODE, "conv_id").unionByName(
        convs.where("size = 0").select(*[zero.alias(c) for c in NODE], "conv_id")
    )
    kinds = ", ".join(f"{c} long" for c in NODE)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, length = None, [], 0
        for batch in batches:
            out = []
            for row in zip(*[batch.column(c).to_pylist() for c in (*NODE, "conv_id")], strict=True):
                if row[:3] != node or length > CHUNK:
                    if ids:
                        out.append((*node, int(ids[0]), ",".join(ids)))
                    node, ids, length = row[:3], [], 0
                ids.append(str(row[3]))
                length += len(ids[-1]) + 1
            if out:
                yield made(out)
        if ids:
            yield made([(*node, int(ids[0]), ",".join(ids))])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*NODE, "first", "ids"])

    order = [F.col(c) for c in ("h1", "h2", "depth", "conv_id")]
    joined = _range_sorted(ends, *order).mapInArrow(join, f"{kinds}, first long, ids string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for row in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
                if row[:3] == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = row[:3], hashlib.sha256()
                state.update(row[3].encode())
            if out:
                yield hashed(out)
        if node is not None:
            yield hashed([(*node, state.hexdigest())])

    def hashed(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends_sha256"])

    return joined.repartition(*NODE).sortWithinPartitions("h1", "h2", "depth", "first").mapInArrow(
        digest, f"{kinds}, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations of ``turns``.

    ``turns`` has conv_id, turn, role and text; extra columns are ignored. Turns are ordered by turn,
    null first; ties by role, then by a hash of the text. A null role or text is empty; rows with a
    null conv_id are in no conversation. Each conversation c is rebuilt: its first turns, crc32(c)
    modulo 6 of them, are replaced by as many first turns of conversation c - c % 100, fewer if that
    has fewer or is not there (the remainder has the sign of c, as in SQL).

    One row per distinct sequence of first turns, the empty one included: conv_id (the least one of
    the conversations that begin with it), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, the code points of the last turn for each
    conversation but one) and ends_sha256 (of the ids of those that end here). An empty table gives
    an empty result.
    """
    rebuilt, convs = rebuilt_turns(turns)
    rebuilt = materialise(rebuilt, "turns")
    seed = 0
    while True:
        paths = materialise(_paths(rebuilt, seed), "paths")
        found, mixed = _nodes(paths, convs)
        if not mixed:
            break
        seed += 1
    children = found.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("h1"), F.col("q2").alias("h2")
    ).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.count_if(F.col("n_convs") == 1).alias("n_single"),
    )
    nodes = materialise(found.join(children, list(NODE), "left").fillna(
        0, ["n_children", "n_single"]
    ), "nodes")
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("h1").alias("q1"), F.col("h2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    # Many children may share a parent; this side of the join can be split.
    named = nodes.join(parents, ["depth", "q1", "q2"], "left")
    totals = _subtree_totals(nodes, paths, budget)
    ended = named.join(_ends(paths, convs), list(NODE), "left").join(totals, list(NODE), "left")
    return ended.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
