"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks boundaries, which depend on content alone, so text moved
within a document keeps its chunks. Chunk sizes are normalised: boundaries are rare before the
normal size and frequent after it. A fingerprint is the set of chunk digests with their lengths.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, NORMAL, MOST = 32, 64, 256
#: Of so many places one is a boundary, before and after the normal size.
RARE, FREQUENT = 256, 16


def _gear_table() -> np.ndarray:
    """A random-looking number per byte value: mixed multiples of an odd constant."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(np.uint32)


GEAR = _gear_table()


def gear_hashes(data: bytes) -> np.ndarray:
    """The gear hash after each byte: sums over the last 32 bytes, by doubling the window."""
    h = GEAR[np.frombuffer(data, dtype=np.uint8)]
    width = 1
    while width < 32 and width < len(h):
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """The ends of the chunks of ``data``."""
    size = len(data)
    if size <= LEAST:
        return [size] if size else []
    h = gear_hashes(data)
    frequent = np.flatnonzero(h < np.uint32(2**32 // FREQUENT)) + 1
    rare = frequent[h[frequent - 1] < np.uint32(2**32 // RARE)].tolist()
    frequent = frequent.tolist()
    ends, begin = [], 0
    while size - begin > LEAST:
        end = min(begin + MOST, size)
        at = bisect_left(rare, begin + LEAST)
        if at < len(rare) and rare[at] < begin + NORMAL:
            end = min(rare[at], end)
        else:
            at = bisect_left(frequent, begin + NORMAL)
            if at < len(frequent):
                end = min(frequent[at], end)
        ends.append(end)
        begin = end
    if begin < size:
        ends.append(size)
    return ends


def chunk_set(text: str) -> np.ndarray:
    """Sorted distinct numbers of the chunks: 48 bits of digest, 16 bits of length."""
    data = text.encode()
    begin, found = 0, []
    for end in boundaries(data):
        digest = hashlib.blake2b(data[begin:end], digest_size=6).digest()
        found.append(digest + (end - begin).to_bytes(2, "big"))
        begin = end
    return np.unique(np.frombuffer(b"".join(found), dtype=">u8"))


def fingerprint(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def containment(ours: np.ndarray, theirs: np.ndarray) -> float:
    """Share of our bytes (each distinct chunk once) in chunks that they have too."""
    if not len(ours):
        return 0.0 if len(theirs) else 1.0
    shared = np.intersect1d(ours, theirs, assume_unique=True)
    mask = np.uint64(0xFFFF)
    return float((shared & mask).sum() / (ours & mask).sum())


def _after(ids: list, width: int, doc_id: Column) -> Column:
    """How many of the falling ids are at or above doc_id, by two short scans of a sorted list."""
    rows = [ids[n:n + width] for n in range(0, len(ids), width)]
    heads = F.array(*[F.lit(row[0]) for row in rows])
    inner = F.array(*[F.array(*[F.lit(x) for x in row]) for row in rows])
    row = F.size(F.filter(heads, lambda x: x >= doc_id))
    return F.when(row == 0, 0).otherwise(
        (row - 1) * width + F.size(F.filter(F.get(inner, row - 1), lambda x: x >= doc_id))
    )


def with_next(documents: DataFrame, function, schema: str) -> DataFrame:
    """Map each document together with the text of the next one, by falling doc_id.

    ``documents`` has doc_id and text. ``function(text, next_text)`` gives the values of
    ``schema``. The texts are shuffled once, into blocks of a range of ids; the first document of a
    block also goes to the block before as its last neighbour, and the first of all to the last.
    Rows that share an id lie together, ordered by text; null ids come last.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    shares = [n / parts for n in range(1, parts)] or [0.5]
    found = documents.agg(
        F.max("doc_id").alias("top"), F.percentile_approx("doc_id", shares, 10_000).alias("cuts")
    ).first()
    cuts = sorted({*(found["cuts"] or []), found["top"]} - {None}, reverse=True)
    last = max(len(cuts), 1)
    # Block k (from 1) holds the ids from cut k down to the next cut.
    if cuts:
        place = _after(cuts, max(1, int(len(cuts) ** 0.5)), F.col("doc_id"))
        block = F.when(F.col("doc_id").isNull(), last).otherwise(place)
        is_cut = F.array_contains(F.array(*[F.lit(c) for c in cuts]), F.col("doc_id"))
        before = F.when(F.col("_block") == 1, last).otherwise(F.col("_block") - 1)
    else:
        block, is_cut, before = F.lit(1), F.lit(True), F.lit(1)
    dealt = documents.select("doc_id", "text", block.cast("int").alias("_block")).select(
        "doc_id", "text", F.explode(F.when(F.coalesce(is_cut, F.lit(False)), F.array(
            F.struct(F.col("_block").alias("block"), F.lit(0).alias("tail")),
            F.struct(before.cast("int").alias("block"), F.lit(1).alias("tail")),
        )).otherwise(F.array(
            F.struct(F.col("_block").alias("block"), F.lit(0).alias("tail"))
        ))).alias("_at"),
    ).select("doc_id", "text", "_at.*")
    dealt = dealt.repartitionById(last, F.col("block") - 1).sortWithinPartitions(
        "block", "tail", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()
    )
    names = [part.split()[0] for part in schema.split(",")]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        ids, values = [], []
        weight = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "text", "block", "tail")]
            for doc_id, text, block, tail in zip(*[c.to_pylist() for c in columns], strict=True):
                if held is not None and (held[2] == block):
                    ids.append(held[0])
                    values.append(function(held[1] or "", text or ""))
                    weight += len(held[1] or "")
                held = None if tail else (doc_id, text, block)
                if weight > 2 << 20:
                    yield made(ids, values)
                    ids, values, weight = [], [], 0
        if ids:
            yield made(ids, values)

    def made(ids: list, values: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(ids), *[pa.array(v) for v in zip(*values, strict=True)]]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    return dealt.mapInArrow(walk, f"doc_id {kind}, {schema}")


def _compare(text: str, following: str) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    ours, theirs = chunk_set(text), chunk_set(following)
    changed = ours if edited == text else chunk_set(edited)
    return (
        len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(ours),
        fingerprint(changed), containment(ours, changed), containment(ours, theirs),
    )


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, and compare it with that and the next document.

    One row per row of ``documents`` (doc_id, text; extra columns are ignored): doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is empty;
    an empty text has an empty fingerprint, which is like another empty one (1) and unlike any
    other (0). A single document is its own next one. An empty table gives an empty result.
    """
    return with_next(
        documents, _compare, "n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
