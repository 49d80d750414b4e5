"""Collocations against plain Python: small budgets, ties, big numbers and odd rows."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearstop.llm import collocations
from tests.compare import FOLDER

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(len(words)):
                for m in range(n + 1, min(n + 5, len(words)) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[n:m])] += 1
    out = []
    for lang, found in counts.items():
        often = {p: f for p, f in found.items() if f >= least and len(p) > 1}
        inside = set()
        for p, f in often.items():
            for n in range(len(p)):
                for m in range(n + 1, len(p) + 1):
                    if m - n < len(p) and found[p[n:m]] <= f:
                        inside.add(p[n:m])
        rows_of = []
        for p, a in often.items():
            if p not in inside:
                score, k = min(
                    (1000 * a * sizes[lang] // (found[p[:k]] * found[p[k:]]), k)
                    for k in range(1, len(p))
                )
                rows_of.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet(str(FOLDER / "sf0.01" / "documents.parquet"))
    return [(r.lang, r.text) for r in table.where("doc_id % 4 = 1").collect()]


@pytest.mark.parametrize("budget", [1_000_000, 300, 20])
def test_equals_plain_python(spark, rows, budget):
    # With the small ones pairs, triples and fours of words are extended.
    odd = [
        (None, "And so on. And so on" * 20), ("und", "and so\ton, AND so on" * 9), ("", "a b " * 40),
        ("xx", None), ("xx", ""), ("xx", " \n\t.,"), ("yy", "é\x1cü É\x1cü " * 30), ("yy", "x " * 30_000),
    ]
    docs = spark.createDataFrame(rows + odd, "lang string, text string").withColumns(
        {"key": F.lit(1), "n": F.lit("x"), "word": F.lit(None)}
    ).repartition(5)
    found = collocations.collocations(docs, least=12, top=50, budget=budget).collect()
    assert sorted(tuple(r) for r in found) == plain(rows + odd, 12, 50)


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0


def test_scores_are_exact(spark):
    big = [(10**15 - 1, 10**18 + 7, 10**15, 10**15), (3 * 10**12, 10**13 + 1, 4 * 10**12, 10**13)]
    rows = spark.createDataFrame(big, "a long, n long, l long, r long")
    found = [r[0] for r in rows.select(collocations.score("a", "n", "l", "r")).collect()]
    assert sorted(found) == sorted(1000 * a * n // (left * right) for a, n, left, right in big)


@pytest.mark.parametrize("stretch", [1, 2, 7, 1000])
def test_stretches_and_early_sums_lose_nothing(monkeypatch, stretch):
    monkeypatch.setattr(collocations, "STRETCH", stretch)
    monkeypatch.setattr(collocations, "PENDING", stretch)
    texts = ["a b c d e f a b c d e f. a b", "", "a b c d e", "x", "a b c d e f"] * 3
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"]
    )
    every = collocations.Filter(np.full(64, -1, dtype=np.int64).view(np.uint64))
    tally, sent = collocations.Tally(5), []
    for words, starts in collocations._hashes(batch, {}, 0):
        sent += tally.add(np.stack(collocations._runs(words, starts, every, 3), axis=1))
    sent += tally.out()
    found = Counter()
    for part in sent:
        for *key, n in zip(*[c.to_pylist() for c in part.columns], strict=True):
            found[tuple(key)] += n
    ids, wanted = collocations.Ids("en", 0), Counter()
    for text in texts:
        for piece in text.split("."):
            words = [np.uint64(ids[w.encode()]).astype(np.int64) for w in piece.split()]
            for n in range(len(words) - 2):
                suffix = words[n:n + 5]
                wanted[tuple(int(w) for w in suffix) + (0,) * (5 - len(suffix))] += 1
    assert found == wanted
