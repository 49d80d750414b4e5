"""The prefix trie against plain Python, and the perfect hash."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearstop.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(turns):
        lead = zlib.crc32(str(c).encode()) % 6
        path = tuple(turns.get(c - c % 100, [])[:lead] + turns[c][lead:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in children[key]) or 1
        own_saved = (len(members[key]) - 1) * len(key[-1][1]) if key else 0
        saved[key] = own_saved + sum(saved[k] for k in children[key])
    return sorted((
        members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]),
        len(children[k]), leaves[k], saved[k],
        hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest(),
    ) for k in members)


def found(df, **how):
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(df, **how).collect())


def made(seed, convs, long=0):
    chance = random.Random(seed)
    rows = []
    for n in range(convs):
        conv_id = chance.choice([n, 100 * (n % 7), n + 300])
        for turn in range(chance.choice([1, 2, 3, 6, 9])):
            text = chance.choice(["", "a", "bü", "ccc", "x" * 50]) if turn else "hello"
            rows.append((conv_id, turn, chance.choice(["user", "assistant"]), text))
    for conv_id in (1001, 1002, 1003):
        rows += [(conv_id, n, "user", str(n % 7)) for n in range(long)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("budget", [50_000, 60, 0])
def test_equals_plain_python(spark, budget, monkeypatch):
    # The small ones cut the trie into many subtrees; chunks of ids are short then.
    monkeypatch.setattr(prefix_trie, "CHUNK", 4 if budget == 0 else 1 << 16)
    rows = made(7, 250, long=700)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"depth": F.lit("x"), "h1": F.lit(1), "_part": F.lit(2), "size": F.lit(None)}
    ).repartition(3)
    assert found(docs, budget=budget) == plain(rows)


def test_nulls_and_turnless_conversations(spark):
    rows = [
        (None, 1, "user", "lost"), (5, None, None, None), (5, 1, "user", "b"), (5, 0, "user", "a"),
        (105, 0, "user", "gone"), (7, 0, "", ""), (8, 0, None, ""), (200, 0, "user", "a"),
        (201, 0, "user", "x"), (202, 0, "user", "a"), (202, 0, "user", "a"), (-3, 0, "user", "n"),
    ]
    rows = [r for r in rows if r[0] != -3]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    assert found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert len(found(spark.createDataFrame([(-3, 0, "user", "n")], SCHEMA))) >= 1


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 30_000).astype(np.uint64))
    table = prefix_trie.PerfectHash(keys)
    assert np.array_equal(np.sort(table.slots(keys)), np.arange(len(keys)))
    same = prefix_trie.PerfectHash.__new__(prefix_trie.PerfectHash)
    same.levels, same.size, same.rest = [], 0, np.sort(keys[:9])
    assert np.array_equal(np.sort(same.slots(keys[:9])), np.arange(9))
    assert (same.slots(keys[9:20]) == -1).all()


@pytest.mark.parametrize("together", [1, 3, 10, 1000])
def test_shards_keep_subtrees_whole(monkeypatch, together):
    # Chains of different length, each a subtree, in batches that cut them.
    monkeypatch.setattr(prefix_trie, "TOGETHER", together)
    rows, wanted = [], {}
    for top in range(1, 12):
        for depth in range(top % 4 + 1):
            key = (depth + 5, top * 100 + depth, 7)
            rows.append((*key, top * 100 + depth - 1, 7, int(depth == top % 4), depth, top, 0))
            wanted[key] = (1, sum(range(depth, top % 4 + 1)))
    names = ["depth", "h1", "h2", "q1", "q2", "leaves", "saved", "c1", "c2"]
    table = pa.table([pa.array(c) for c in zip(*rows)], names=names)
    found = {}
    for batch in prefix_trie._solve_shard(iter(table.to_batches(max_chunksize=2))):
        for *key, leaves, saved in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            found[tuple(key)] = (leaves, saved)
    assert found == wanted
