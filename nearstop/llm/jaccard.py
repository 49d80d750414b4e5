"""N-gram Jaccard join with PartEnum signatures, and the components of its links.

Sets of similar size share a band. For a band, sets that are similar enough differ in at most k
elements. The domain of elements is cut into first-level parts, so that some parts of two such sets
differ in at most one element; each part is cut in three, and two of the three then agree. A hash
of such two thirds is a signature: similar sets share one. What shares a signature is a candidate;
a parity sketch, which never rejects a link, sorts out most others before the sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.llm.components import connected
from nearstop.llm.common import shards_for
from nearstop.scratch import materialise

#: Sets are linked from a similarity of 80 / 100 on.
SHINGLE, NEAR, OF = 5, 80, 100
#: A signature rests on two of three thirds of a part.
THIRDS = 3
#: Spare parts: one for so many. Similar sets have one more part in common than there are spare
#: ones, so a set may leave out the signatures of few elements if no more parts than these have any.
SPARE = 8
#: Signatures with fewer elements than this are left out; if too many parts have one, the next.
FEW = (2, 1)
#: Shingles for each part of the space, on average, and the bytes of a signature that are sent.
SIGNATURES, SENT = 2_000_000, 5
#: Signatures that a task gathers before it sends them.
GATHERED = 400_000
#: Least open signatures of a set, by which a pair that shares several is told from a new one.
LEAST = 8
#: Numbers of a sketch that a row of the join carries at most, as the row repeats per signature.
WIDTH = 256
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct five-word shingles of a text as sorted 64-bit hashes.

    A-Z are lower-cased; words are split at ASCII white space. Fewer words make one shingle.
    """
    words = (text or "").encode().lower().split()
    if len(words) < SHINGLE:
        whole = [xxhash.xxh3_64_intdigest(b" ".join(words), len(words))] if words else []
        return np.array(whole, dtype=np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    count = len(h) - SHINGLE + 1
    acc = h[:count].copy()
    for n in range(1, SHINGLE):
        acc = _mix(acc) + h[n:n + count]
    return np.unique(_mix(acc))


def set_key(elements: np.ndarray) -> int | None:
    """A signed 64-bit hash that stands for the set; null for an empty one."""
    if not len(elements):
        return None
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).astype(np.int64))


def sketch_bits(size: int) -> int:
    """A power of two of at least two bits an element."""
    return max(64, 1 << (2 * size - 1).bit_length())


def parity_sketch(elements: np.ndarray) -> bytes:
    """For each place the parity of the elements there; sets that differ in d differ in d bits."""
    bits = sketch_bits(len(elements))
    counts = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1, bitorder="little").tobytes()


def small_sketch(sketch: bytes) -> list[int]:
    """The sketch as signed 64-bit numbers, for tests within a join; folded if it is over WIDTH."""
    bits = np.frombuffer(sketch, dtype=np.int64)
    while len(bits) > WIDTH:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits.tolist()


def _folded(one: str, other: str) -> str:
    """A small sketch, folded once if the other one is shorter."""
    return (
        f"IF(size({one}) > size({other}), zip_with(slice({one}, 1, size({other})), "
        f"slice({one}, size({other}) + 1, size({other})), (x, y) -> x ^ y), {one})"
    )


#: Whether sizes and small sketches of a and b allow a link; it never turns a link down.
SMALL_TEST = f"""
    {OF} * least(a.size, b.size) >= {NEAR} * greatest(a.size, b.size) AND {OF + NEAR} * aggregate(
        zip_with({_folded('a.small', 'b.small')}, {_folded('b.small', 'a.small')},
            (x, y) -> bit_count(x ^ y)),
        0, (s, v) -> s + v) <= {OF - NEAR} * (a.size + b.size)
"""

#: Whether a pair is met here by the least signature that both lists of least ones hold. A pair
#: whose lists share none may be met more than once; every other pair is met once.
FIRST_SHARED = "coalesce(a.signature <= array_min(array_intersect(a.low, b.low)), true)"


def sketch_distance(a: bytes, b: bytes) -> int:
    """A lower bound on the number of elements that two sets differ in."""
    x, y = (np.frombuffer(s, dtype=np.uint8) for s in (a, b))
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(size_a: int, size_b: int, distance: int) -> bool:
    """Whether sets of these sizes that differ in so many elements can be similar enough."""
    return distance * (OF + NEAR) <= (size_a + size_b) * (OF - NEAR)


@cache
def band_of(size: int) -> int:
    """The band of a size: bands are as wide as the sizes similar sets can have."""
    low, band = 1, 0
    while True:
        high = low * OF // NEAR
        if size <= high:
            return band
        low, band = high + 1, band + 1


@cache
def band_parts(band: int) -> tuple[int, int]:
    """For pairs whose larger set is in the band: first-level parts, and the spare ones of them."""
    low = 1
    for _ in range(band):
        low = low * OF // NEAR + 1
    high = low * OF // NEAR
    differ = 2 * high * (OF - NEAR) // (OF + NEAR)
    if differ == 0:
        return 0, 0
    needed = differ // 2 + 1
    spare = -(-needed // SPARE) if needed > 2 else 0
    return needed + spare, spare


def signatures(elements: np.ndarray) -> np.ndarray:
    """The PartEnum signatures of a set, as sorted distinct 64-bit numbers."""
    found = []
    own = band_of(len(elements))
    for band in (own, own + 1):
        parts, spare = band_parts(band)
        if not parts:
            continue
        # One shuffle of the domain per band; the product spreads over parts and thirds.
        place = _mix(elements + np.uint64((band + 1) * 0x9E3779B97F4A7C15 % 2**64))
        cell = ((place >> np.uint64(32)) % np.uint64(parts * THIRDS)).astype(np.int64)
        cells = parts * THIRDS
        # Sums over the elements of a cell do not depend on their order.
        sums = np.zeros(cells, dtype=np.uint64)
        np.add.at(sums, cell, _mix(place ^ M2))
        counts = np.bincount(cell, minlength=cells).reshape(parts, THIRDS)
        sums = sums.reshape(parts, THIRDS)
        part = np.arange(parts, dtype=np.uint64)
        values, held = [], []
        for left_out in range(THIRDS):
            one, two = [t for t in range(THIRDS) if t != left_out]
            salt = _mix(
                (np.uint64(band) << np.uint64(40)) + (part << np.uint64(4)) + np.uint64(left_out)
            )
            values.append(_mix(_mix(sums[:, one] ^ salt) + sums[:, two]))
            held.append(counts[:, one] + counts[:, two])
        least = np.min(held, axis=0)
        few = next((n for n in FEW if np.count_nonzero(least < n) <= spare), 0)
        found.extend(v[h >= few] for v, h in zip(values, held, strict=True))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.uint64)


def document_sets(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key and sketches of the shingle set of every document."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sketches, small = [], [], [], []
            for text in batch.column("text"):
                elements = shingle_set(text.as_py())
                sizes.append(len(elements))
                keys.append(set_key(elements))
                sketches.append(parity_sketch(elements) if len(elements) else None)
                small.append(small_sketch(sketches[-1]) if len(elements) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                pa.array(sketches, pa.binary()), pa.array(small, pa.list_(pa.int64())),
            ], names=["doc_id", "n_shingles", "key", "sketch", "small"])

    return documents.select("doc_id", "text").mapInArrow(
        summarise, f"doc_id {kind}, n_shingles long, key long, sketch binary, small array<bigint>"
    )


def _signature_rows(documents: DataFrame, parts: int) -> DataFrame:
    """(part, batch, keys, counts, found): signatures of sets, by the part of the space they lie in.

    A task gathers the signatures of many sets and sends one row for each part: the keys of the
    sets, rising, how many signatures each has there, and these. Equal sets of a task are sent once.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[int, np.ndarray]] = []
        waiting, number = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for text in batch.column("text"):
                elements = shingle_set(text.as_py())
                key = set_key(elements)
                if key is None or key in seen:
                    continue
                seen.add(key)
                held.append((key, signatures(elements)))
                waiting += len(held[-1][1])
                if waiting > GATHERED:
                    yield _rows(held, number)
                    held, waiting, number = [], 0, number + 1
        if waiting:
            yield _rows(held, number)

    def _rows(held: list[tuple[int, np.ndarray]], number: int) -> pa.RecordBatch:
        held.sort(key=lambda h: h[0])
        found = np.concatenate([f for _, f in held])
        owner = np.repeat(np.arange(len(held)), [len(f) for _, f in held])
        keys = np.array([key for key, _ in held], dtype=np.int64)
        part = (found % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, owner = part[order], owner[order]
        # The bits that do not choose the part, in a few bytes.
        sent = found[order].view(np.uint8).reshape(-1, 8)[:, 8 - SENT:]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        rows = []
        for a, b in zip(starts, np.r_[starts[1:], len(part)], strict=True):
            first = np.flatnonzero(np.r_[True, owner[a + 1:b] != owner[a:b - 1]])
            counts = np.diff(np.r_[first, b - a]).astype(np.uint32)
            rows.append((
                int(part[a]), number, keys[owner[a + first]].tobytes(), counts.tobytes(),
                sent[a:b].tobytes(),
            ))
        columns = [pa.array(column, kind) for column, kind in zip(
            zip(*rows, strict=True),
            (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True,
        )]
        return pa.RecordBatch.from_arrays(
            columns, names=["part", "batch", "keys", "counts", "found"]
        )

    return documents.select("text").mapInArrow(
        emit, "part int, batch long, keys binary, counts binary, found binary"
    )


def _star_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each signature of a part pair its first key with each other key that has it.

    Keys come by batch and rising in it, the same order in every part, so similar sets tend to have
    one leader. Memory holds the distinct signatures of the part, not the rows of a frequent one.
    A pair comes once for each signature it was met by, so the rows are as many as the signatures
    that sets have after their first keys, however many parts these lie in.
    """
    known, leaders = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def settle():
        nonlocal known, leaders, held, waiting
        keys = np.concatenate([k for k, _ in held])
        found = np.concatenate([f for _, f in held])
        held, waiting = [], 0
        order = np.argsort(found, kind="stable")
        keys, found = keys[order], found[order]
        first = np.r_[True, found[1:] != found[:-1]]
        distinct, lead = found[first], keys[first]
        at = np.searchsorted(known, distinct)
        old = np.zeros(len(distinct), dtype=bool)
        inside = at < len(known)
        old[inside] = known[at[inside]] == distinct[inside]
        lead = lead.copy()
        lead[old] = leaders[at[old]]
        per_row = lead[np.cumsum(first) - 1]
        pairs = per_row != keys
        known = np.insert(known, at[~old], distinct[~old])
        leaders = np.insert(leaders, at[~old], lead[~old])
        return per_row[pairs], keys[pairs], found[pairs]

    def rows(leader, member, found) -> pa.RecordBatch:
        # In this order the keys repeat, so a stored table has little but the signatures.
        order = np.lexsort((member, leader))
        return pa.RecordBatch.from_arrays(
            [pa.array(x[order]) for x in (leader, member, found.astype(np.int64))],
            names=["leader", "member", "signature"],
        )

    for batch in batches:
        columns = [batch.column(c) for c in ("keys", "counts", "found")]
        for n, part in enumerate(batch.column("part").to_pylist()):
            keys, counts, found = (column[n].as_buffer() for column in columns)
            sent = np.frombuffer(found, dtype=np.uint8).reshape(-1, SENT)
            wide = np.zeros((len(sent), 8), dtype=np.uint8)
            wide[:, :SENT] = sent
            values = wide.view(np.uint64).ravel() + np.uint64(part << 8 * SENT)
            owners = np.repeat(
                np.frombuffer(keys, dtype=np.int64), np.frombuffer(counts, dtype=np.uint32)
            )
            held.append((owners, values))
            waiting += len(values)
            if waiting > 500_000:
                made = settle()
                if len(made[0]):
                    yield rows(*made)
    if held:
        made = settle()
        if len(made[0]):
            yield rows(*made)


def candidate_stars(documents: DataFrame, total: int) -> DataFrame:
    """(leader, member, signature): candidate pairs, as a star around the first key of a signature.

    ``total`` is the number of shingles of all documents, to choose the number of parts.
    """
    parts = shards_for(total, SIGNATURES)
    rows = _signature_rows(documents, parts)
    return rows.repartitionById(parts, "part").sortWithinPartitions("part", "batch").select(
        "part", "keys", "counts", "found"
    ).mapInArrow(_star_pairs, "leader long, member long, signature long")


def _sketched(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link; ``nodes`` has key, size, sketch."""
    sides = [
        nodes.select(F.col("key").alias(x), F.col("size").alias(f"size_{x}"),
                     F.col("sketch").alias(f"sketch_{x}")) for x in ("a", "b")
    ]
    low, high = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    sized = pairs.join(sides[0], "a").join(sides[1], "b").where(OF * low >= NEAR * high)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (
                "size_a", "size_b", "sketch_a", "sketch_b"
            )]
            near = [
                may_link(m, n, sketch_distance(x, y)) for m, n, x, y in zip(*columns, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return sized.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(
        keep, "a long, b long"
    )


def _sets_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and elements (packed) for wanted documents (doc_id, key), one row per key."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            for text, key in zip(batch.column("text"), batch.column("key").to_pylist(), strict=True):
                elements = shingle_set(text.as_py())
                if set_key(elements) == key:
                    keys.append(key)
                    values.append(elements.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(values, pa.binary())],
                names=["key", "elements"],
            )

    wanted = wanted.withColumnRenamed("doc_id", "_id")
    rows = documents.select("doc_id", "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id"))
    ).select("text", "key")
    return rows.mapInArrow(build, "key long, elements binary").dropDuplicates(["key"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by exact comparison."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                near.append(OF * shared >= NEAR * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    of_a = sets.select(F.col("key").alias("a"), F.col("elements").alias("of_a"))
    of_b = sets.select(F.col("key").alias("b"), F.col("elements").alias("of_b"))
    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b").mapInArrow(
        keep, "a long, b long"
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet; ``labels`` has key and label."""
    a = labels.select(F.col("key").alias("a"), F.col("label").alias("label_a"))
    b = labels.select(F.col("key").alias("b"), F.col("label").alias("label_b"))
    return pairs.join(a, "a", "left").join(b, "b", "left").where(
        F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    ).drop("label_a", "label_b")


def similar_components(documents: DataFrame) -> DataFrame:
    """Link documents by the Jaccard similarity of their five-word shingles, and find components.

    One row per row of ``documents`` (doc_id, text; extra columns are ignored): doc_id, n_shingles,
    component_id (the least doc_id that links lead to, its own included). A null text, or one
    without words, has no shingles and no links; rows with equal sets are linked, also if they share
    an id. An empty table gives an empty result.

    Equal sets are one node from the start. Candidates are tested in three rounds, each leaving out
    what is connected already: the star pair of each set that most signatures support, the other
    star pairs, and, for signatures whose sets are still apart, the pairs across components. So no
    link between different components is left untested, and a group of copies costs one pair each.
    Sets are compared by 64-bit hashes of shingles.
    """
    sets = materialise(document_sets(documents), "sets")
    nodes = materialise(sets.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("size"),
        F.min("sketch").alias("sketch"), F.min("small").alias("small"),
    ), "nodes")
    total = sets.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    stars = materialise(candidate_stars(documents, total), "stars")
    pairs = materialise(stars.groupBy(
        F.col("leader").alias("a"), F.col("member").alias("b")
    ).agg(F.count(F.lit(1)).alias("votes")), "pairs")
    near = _sketched(pairs, nodes).join(pairs, ["a", "b"])
    near = materialise(near, "near")

    best = near.groupBy("b").agg(F.max(F.struct("votes", "a")).alias("_best")).select(
        F.col("_best.a").alias("a"), "b"
    )
    wanted = near.select("a").unionByName(near.select(F.col("b").alias("a"))).distinct()
    elements = materialise(_sets_of(
        documents, nodes.join(wanted, nodes["key"] == wanted["a"], "left_semi").select(
            "doc_id", "key"
        )
    ), "elements")
    links = materialise(_linked(best, elements), "links")
    labels = connected(links)

    others = _apart(near.select("a", "b").join(best, ["a", "b"], "left_anti"), labels)
    more = materialise(_linked(others, elements), "links")
    if not more.isEmpty():
        links = materialise(links.unionByName(more), "links")
        labels = connected(links)

    across = materialise(_pairs_across(stars, pairs, labels, nodes), "across")
    if not across.isEmpty():
        left = across.select("a").unionByName(across.select(F.col("b").alias("a"))).distinct()
        missing = left.join(elements, left["a"] == elements["key"], "left_anti")
        extra = _sets_of(documents, nodes.join(
            missing, nodes["key"] == missing["a"], "left_semi"
        ).select("doc_id", "key"))
        more = materialise(_linked(across, elements.unionByName(extra)), "links")
        if not more.isEmpty():
            labels = connected(materialise(links.unionByName(more), "links"))
    return _numbered(sets, labels)


def _pairs_across(
    stars: DataFrame, pairs: DataFrame, labels: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Pairs (a, b) that share a signature but no component, and that sketches allow.

    Only signatures with a star pair that is still apart can have any; ``pairs`` has the star pairs
    (a, b), each once. Pairs with the leader were tested before.
    """
    apart = _apart(pairs.select("a", "b"), labels)
    open_found = materialise(
        stars.join(
            apart.select(F.col("a").alias("leader"), F.col("b").alias("member")),
            ["leader", "member"], "left_semi",
        ).select("signature").distinct(), "open"
    )
    # Not by leader: all signatures of a large group have the same one.
    members = stars.select("signature", F.col("member").alias("key")).join(
        open_found, "signature", "left_semi"
    )
    # One row per set until the join: its open signatures are no more than its text gives.
    members = members.groupBy("key").agg(F.sort_array(F.collect_list("signature")).alias("found"))
    members = members.join(labels, "key", "left").join(nodes, "key").select(
        "key", F.coalesce("label", "key").alias("label"), "size", "small", "found",
        F.slice("found", 1, LEAST).alias("low"),
    )
    members = materialise(members, "members").select(
        F.explode("found").alias("signature"), "key", "label", "size", "small", "low"
    )
    # The largest component of a signature is not paired with itself, however large it is.
    major = members.groupBy("signature", "label").count().groupBy("signature").agg(
        F.max(F.struct("count", "label")).alias("_major")
    ).select("signature", F.col("_major.label").alias("major"))
    major = materialise(major, "major")
    minor = members.join(major, "signature").where("label <> major")
    a, b = minor.alias("a"), members.alias("b")
    # The tests are part of the join: pairs that cannot link, or were met, are never rows.
    found = a.join(b, (F.col("a.signature") == F.col("b.signature"))
                   & (F.col("a.label") != F.col("b.label"))
                   & ((F.col("b.label") == F.col("a.major")) | (F.col("a.key") < F.col("b.key")))
                   & F.expr(FIRST_SHARED) & F.expr(SMALL_TEST)
    ).select(
        F.least("a.key", "b.key").alias("a"), F.greatest("a.key", "b.key").alias("b")
    ).distinct()
    return _sketched(found, nodes)


def _numbered(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Each row with the least doc_id of its component."""
    named = sets.select("doc_id", "n_shingles", "key").join(labels, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "key").alias("_group")
    )
    named = materialise(named, "named")
    groups = materialise(named.where("_group IS NOT NULL").groupBy("_group").agg(
        F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_rows")
    ).where("_rows > 1").drop("_rows"), "groups")
    return named.join(groups, "_group", "left").select(
        "doc_id", "n_shingles", F.coalesce("_least", "doc_id").alias("component_id")
    )
