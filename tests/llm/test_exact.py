"""Exact deduplication: normalising, ties, and hashes that stand for several texts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from nearstop.llm import exact

ROWS = [
    (5, "a b"), (3, "ab"), (4, "a\tb"), (7, "a b"), (9, "A b"), (1, None), (2, ""), (6, " \r\n"),
    (None, "a\x0bb"), (8, "a b"), (10, "x" * 60_000), (11, "x" * 60_000 + " "), (3, "ab"),
    (None, "left"), (None, "left"),
]
SPACE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def _expected():
    groups = {}
    for doc_id, text in ROWS:
        groups.setdefault((text or "").translate(SPACE), []).append((doc_id, len(text or "")))
    out = []
    for body, rows in groups.items():
        rows.sort(key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(r[0], rows[0][0], len(rows), n == 0, digest) for n, r in enumerate(rows)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [16, 0])
def test_equals_plain_python(spark, width):
    # A hash of no bytes puts all texts in one group, which only their bytes tell apart.
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns(
        {"hash": F.lit(1), "body": F.lit("x"), "_row": F.lit(2)}
    )
    found = exact.exact_groups(docs, lambda digest: F.substring(digest, 1, width)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == _expected()
    assert exact.exact_groups(docs.where("false")).count() == 0
