"""Registered queries against DuckDB, and the results that other tests rest on."""

import pytest

import corpus_pipeline
from nearstop.llm.oracle import ORACLE
from nearstop.llm.queries import QUERIES
from tests.compare import FOLDER, duck_rows, spark_rows

SF = "sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_duckdb(spark, name):
    assert spark_rows(QUERIES[name](spark, str(FOLDER / SF))) == duck_rows(ORACLE[name], SF)


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]


def test_components_equal_brute_force(spark):
    documents = spark.read.parquet(str(FOLDER / SF / "documents.parquet")).collect()
    sets = {}
    for row in documents:
        words = (row.text or "").encode().lower().split()
        size = min(5, len(words))
        sets[row.doc_id] = {
            tuple(words[n:n + size]) for n in range(len(words) - size + 1)
        } if words else set()
    label = {n: n for n in sets}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    holders = {}
    for n, shingles in sets.items():
        for shingle in shingles:
            holders.setdefault(shingle, []).append(n)
    for n, shingles in sets.items():
        for m in {m for s in shingles for m in holders[s] if m < n}:
            if 100 * len(shingles & sets[m]) >= 80 * len(shingles | sets[m]):
                a, b = sorted((root(n), root(m)))
                label[b] = a
    found = QUERIES["op5_ngram_jaccard"](spark, str(FOLDER / SF)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {
        n: (len(sets[n]), root(n)) for n in sets
    }
