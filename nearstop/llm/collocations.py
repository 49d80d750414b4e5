"""Phrase collocations from depth-truncated suffix subtrees over vertically partitioned prefixes.

Every word position starts a suffix, cut after five words, at the end of its piece, and where two
neighbouring words are too rare together to be in any phrase that counts. Word pairs are the
prefixes that are counted first. They are dealt into groups by a budget of occurrences; a prefix
beyond the budget is extended by a word, and its extensions are dealt instead. The subtree of each
group is built by itself: its suffixes are sorted, and the count of a phrase is the total of the
leaves below its node. Scores are whole numbers, computed exactly.

Words travel as 64-bit hashes that include the language; a seed under which two words of the corpus
share a hash is not used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearstop.llm.common import shards_for
from nearstop.scratch import materialise

MAX_WORDS = 5
#: Uses a phrase needs, and the phrases that are reported per language.
LEAST, TOP = 100, 2000
#: Occurrences a group of prefixes holds on average, and a prefix at most before it is extended.
BUDGET = 1_000_000
#: Prefixes beyond the budget are one in so many of all occurrences at most, so they are few.
MOST_HEAVY = 100_000
#: Bits of a filter for each entry, and at most (16 MB); a false positive only costs its shuffle.
BITS_EACH, MOST_BITS = 16, 1 << 27
#: Rows that a task adds up before it sends them, and words it remembers the hashes of.
PENDING, REMEMBERED = 1_000_000, 500_000
#: Suffixes that are looked at together.
STRETCH = 250_000

BREAK = b"\xff"
UPPER = bytes(range(65, 91))
ENDS = b".,;:!?\n\x0b\x0c\r"
#: Lower case for A-Z, a space for a tab, a byte no text has for the end of a piece.
PLAIN = bytes.maketrans(UPPER + b"\t" + ENDS, UPPER.lower() + b" " + BREAK * len(ENDS))
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def tokens(text: str | None) -> list[bytes]:
    """The words of a text in lower case, with ``BREAK`` where a piece ends."""
    plain = (text or "").encode().translate(PLAIN).replace(BREAK, b" " + BREAK + b" ")
    # The only white space of bytes that is left is the space.
    return plain.split()


class Ids(dict):
    """Hashes of words of one language, never 0; ``BREAK`` is 0."""

    def __init__(self, lang: str, seed: int):
        super().__init__({BREAK: 0})
        self.seed = xxhash.xxh3_64_intdigest(lang.encode(), seed)

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
            self[BREAK] = 0
        found = self[word] = xxhash.xxh3_64_intdigest(word, self.seed) or 1
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def prefix_hash(columns: list[np.ndarray]) -> np.ndarray:
    """One number for the words in ``columns``."""
    out = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        out = _mix(out + column)
    return out


def add_up(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sum of their counts, but for rows whose hashes collide."""
    order = np.argsort(prefix_hash(list(rows.T)), kind="stable")
    rows, counts = rows[order], counts[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
    return rows[first], np.add.reduceat(counts, first)


class Tally:
    """Adds up rows of hashes, and gives them out once they are many."""

    def __init__(self, width: int):
        self.width, self.held, self.waiting = width, [], 0

    def add(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(rows):
            self.held.append(add_up(rows, np.ones(len(rows), dtype=np.int64)))
            self.waiting += len(self.held[-1][0])
        if self.waiting > PENDING:
            self._fold()
            if self.waiting > PENDING // 2:
                yield from self.out()

    def _fold(self) -> None:
        rows, counts = zip(*self.held, strict=True)
        self.held = [add_up(np.concatenate(rows), np.concatenate(counts))]
        self.waiting = len(self.held[0][0])

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._fold()
            yield self._batch(*self.held[0])
        self.held, self.waiting = [], 0

    def _batch(self, rows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in rows.T]
        names = [f"w{n}" for n in range(1, self.width + 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts)], names=[*names, "n"])


class Filter:
    """A set of hashes as bits; it holds every one of them, and a few others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        word = self.bits[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_filter(hashes: DataFrame, count: int) -> Filter:
    """The filter of ``count`` rows (hash); the driver gets its bits only, ``MOST_BITS`` at most."""
    size = min(MOST_BITS, max(1 << 12, 1 << (BITS_EACH * count - 1).bit_length()))
    place = F.col("hash").bitwiseAND(F.lit(size - 1))
    rows = hashes.select(
        F.shiftright(place, 6).alias("at"),
        F.expr("shiftleft(1L, CAST(hash & 63 AS INT))").alias("bit"),
    ).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype=np.int64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return Filter(bits.view(np.uint64))


def _hashes(
    batch: pa.RecordBatch, known: dict[str, Ids], seed: int
) -> Iterator[tuple[np.ndarray, int]]:
    """Stretches of the hashes of all words of a batch, with 0 between pieces and texts.

    Each comes with the number of suffixes that start in it; the words after these only end them.
    """
    parts, waiting = [], 0

    def cut() -> Iterator[tuple[np.ndarray, int]]:
        words = np.concatenate(parts)
        for start in range(0, len(words), STRETCH):
            stretch = words[start:start + STRETCH + MAX_WORDS - 1]
            yield stretch, min(STRETCH, len(words) - start)

    for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
        lang = lang.as_py()
        if lang not in known:
            known[lang] = Ids(lang, seed)
        words = tokens(text.as_py())
        parts.append(np.fromiter(map(known[lang].__getitem__, words), np.uint64, len(words)))
        parts.append(np.zeros(1, dtype=np.uint64))
        waiting += len(words) + 1
        if waiting >= STRETCH:
            yield from cut()
            parts, waiting = [], 0
    if parts:
        yield from cut()


def _shifted(words: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([words[by:], np.zeros(min(by, len(words)), dtype=words.dtype)])


def _counted(texts: DataFrame, seed: int, width: int, rows_of) -> DataFrame:
    """w1 to w<width> and n: the rows that ``rows_of`` makes of hashes, added up in each task.

    ``rows_of`` gets the hashes and the number of suffixes that start among them.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Ids] = {}
        tally = Tally(width)
        for batch in batches:
            for words, starts in _hashes(batch, known, seed):
                yield from tally.add(rows_of(words, starts))
        yield from tally.out()

    names = [f"w{n}" for n in range(1, width + 1)]
    return texts.mapInArrow(scan, ", ".join(f"{c} long" for c in [*names, "n"]))


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """id, lang, word, n of every word, and other, a second word of the same hash if there is one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Ids] = {}
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                found.setdefault(lang.as_py(), Counter()).update(tokens(text.as_py()))
            if sum(map(len, found.values())) > REMEMBERED:
                yield from out(found, known)
                found = {}
        yield from out(found, known)

    def out(found: dict[str, Counter], known: dict[str, Ids]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            counts.pop(BREAK, None)
            ids = known.setdefault(lang, Ids(lang, seed))
            values = np.array([ids[word] for word in counts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array(values.view(np.int64)), pa.array([lang] * len(counts), pa.string()),
                pa.array([word.decode() for word in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ], names=["id", "lang", "word", "n"])

    rows = texts.mapInArrow(scan, "id long, lang string, word string, n long")
    single = rows.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))
    return single.groupBy("id").agg(
        F.min(F.struct("lang", "word")).alias("_one"), F.max(F.struct("lang", "word")).alias("_two"),
        F.sum("n").alias("n"),
    ).select(
        "id", "_one.lang", "_one.word", "n",
        F.when(F.col("_one") != F.col("_two"), F.col("_two.word")).alias("other"),
    )


def _links(words: np.ndarray, pairs: Filter) -> np.ndarray:
    """Whether a word and the next one are in one piece and may be a pair that counts."""
    following = _shifted(words, 1)
    both = (words != 0) & (following != 0)
    return both & pairs.holds(prefix_hash([words, following]))


def _runs(words: np.ndarray, starts: int, pairs: Filter, least: int) -> list[np.ndarray]:
    """The columns of the suffixes of at least ``least`` words, cut as told above; 0 is no word."""
    link = _links(words, pairs)
    reach, length = link.copy(), np.ones(len(words), dtype=np.int8)
    for n in range(1, MAX_WORDS):
        length += reach
        reach &= _shifted(link, n)
    at = np.flatnonzero(length[:starts] >= least)
    padded = np.concatenate([words, np.zeros(MAX_WORDS, dtype=np.uint64)])
    held = length[at]
    return [np.where(held > n, padded[at + n], np.uint64(0)) for n in range(MAX_WORDS)]


def heavy_prefixes(texts: DataFrame, seed: int, frequent: DataFrame, pairs: Filter,
                   budget: int) -> list[np.ndarray]:
    """For prefixes of two, three and four words the sorted hashes of those beyond the budget.

    Longer prefixes are counted only below heavy shorter ones, and only if there are any.
    """
    def hashes(counted: DataFrame, size: int) -> np.ndarray:
        names = [f"w{n}" for n in range(1, size + 1)]
        rows = counted.where(F.col("n") > budget).select(*names).toArrow()
        if not rows.num_rows:
            return np.empty(0, dtype=np.uint64)
        return np.unique(prefix_hash([
            rows.column(c).to_numpy().view(np.uint64) for c in names
        ]))

    found = [hashes(frequent, 2)]
    while len(found) < MAX_WORDS - 2 and len(found[-1]):
        size, above = len(found) + 2, found[-1]

        def longer(words: np.ndarray, starts: int, size=size, above=above) -> np.ndarray:
            columns = _runs(words, starts, pairs, size)[:size]
            below = np.isin(prefix_hash(columns[:-1]), above)
            return np.stack([c[below] for c in columns], axis=1)

        names = [f"w{n}" for n in range(1, size + 1)]
        found.append(hashes(materialise(_counted(texts, seed, size, longer).groupBy(*names).agg(
            F.sum("n").alias("n")
        ).where(F.col("n") > budget), "heavy"), size))
    return found + [np.empty(0, dtype=np.uint64)] * (MAX_WORDS - 2 - len(found))


def _group_of(columns: list[np.ndarray], heavy: list[np.ndarray], groups: int) -> np.ndarray:
    """The group of each suffix: by its first two words, by more below heavy prefixes."""
    place = prefix_hash(columns[:2])
    deeper = np.ones(len(place), dtype=bool)
    for size, known in enumerate(heavy, 2):
        deeper &= np.isin(prefix_hash(columns[:size]), known)
        place = np.where(deeper, prefix_hash(columns[:size + 1]), place)
    return (_mix(place ^ M2) % np.uint64(groups)).astype(np.int64)


def subtree(rows: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each depth from three words on the phrases of a group of suffixes and their counts.

    Sorted suffixes are the leaves of the subtree in order, so the leaves below a node are a
    stretch of them, and its count is their total.
    """
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    starts = np.ones(len(rows), dtype=bool)
    starts[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    for depth in range(3, MAX_WORDS + 1):
        starts[1:] |= rows[1:, depth - 1] != rows[:-1, depth - 1]
        first = np.flatnonzero(starts)
        totals = np.add.reduceat(counts, first)
        nodes = rows[first, :depth]
        whole = nodes[:, -1] != 0
        yield nodes[whole], totals[whole]


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of the subtree of one group: key (the words) and n."""
    held, waiting, bound = [], 0, 2 * PENDING
    for batch in batches:
        columns = [batch.column(f"w{n}").to_numpy().view(np.uint64) for n in range(1, MAX_WORDS + 1)]
        held.append((np.stack(columns, axis=1), batch.column("n").to_numpy()))
        waiting += len(held[-1][0])
        if waiting > bound:
            held = [add_up(*map(np.concatenate, zip(*held, strict=True)))]
            waiting = len(held[0][0])
            bound = max(bound, 2 * waiting)
    if not held:
        return
    for nodes, totals in subtree(*map(np.concatenate, zip(*held, strict=True))):
        width = nodes.shape[1]
        offsets = np.arange(0, nodes.size + 1, width, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(nodes.ravel().view(np.int64))),
            pa.array(totals),
        ], names=["key", "n"])


def frequent_phrases(
    texts: DataFrame, words: DataFrame, seed: int, least: int = LEAST, budget: int = BUDGET
) -> DataFrame:
    """key (hashes of words) and n of every phrase of one to five words with ``least`` uses."""
    frequent = words.where(F.col("n") >= least)
    singles = frequent.select(F.array("id").alias("key"), "n")
    kept = bit_filter(frequent.select(F.col("id").alias("hash")), frequent.count())

    def pairs_of(found: np.ndarray, starts: int) -> np.ndarray:
        held = kept.holds(found) & (found != 0)
        both = held & _shifted(held, 1)
        both[starts:] = False
        return np.stack([found[both], _shifted(found, 1)[both]], axis=1)

    pairs = materialise(_counted(texts, seed, 2, pairs_of).groupBy("w1", "w2").agg(
        F.sum("n").alias("n")
    ).where(F.col("n") >= least), "pairs")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy().view(np.uint64) for c in ("w1", "w2")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix_hash(columns).view(np.int64))], names=["hash"]
            )

    sizes = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("uses")).first()
    linked = bit_filter(pairs.select("w1", "w2").mapInArrow(hashed, "hash long"), sizes["pairs"])
    uses = sizes["uses"] or 0
    bound = max(budget, uses // MOST_HEAVY)
    groups = shards_for(uses, bound)
    heavy = heavy_prefixes(texts, seed, pairs, linked, bound)
    suffixes = _counted(
        texts, seed, MAX_WORDS, lambda found, starts: np.stack(_runs(found, starts, linked, 3), axis=1)
    )

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy().view(np.uint64) for c in batch.columns[:MAX_WORDS]]
            yield batch.append_column("_group", pa.array(_group_of(columns, heavy, groups)))

    kinds = [*[f"w{n}" for n in range(1, MAX_WORDS + 1)], "n", "_group"]
    # A phrase shorter than the prefix its suffixes are dealt by comes from several groups.
    longer = suffixes.mapInArrow(dealt, ", ".join(f"{c} long" for c in kinds)).repartitionById(
        groups, F.col("_group").cast("int")
    ).mapInArrow(_grow, "key array<bigint>, n long").groupBy("key").agg(
        F.sum("n").alias("n")
    ).where(F.col("n") >= least)
    two = pairs.select(F.array("w1", "w2").alias("key"), "n")
    return singles.unionByName(two).unionByName(longer)


def score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (left * right)) of whole numbers, exactly; products have 38 digits."""
    top = f"CAST({a} AS DECIMAL(19, 0)) * CAST({n} AS DECIMAL(19, 0)) * 1000"
    return F.expr(f"({top}) div (CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0)))")


def scored_phrases(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """key, lang, a, l, r, n and score of every candidate that no longer one covers."""
    candidates = phrases.where(F.size("key") > 1).withColumnRenamed("n", "a")
    # What covers a phrase by several words has a part that covers it by one, of the same count.
    covering = candidates.where(F.size("key") > 2).select(F.explode(F.array(
        F.expr("slice(key, 1, size(key) - 1)"), F.expr("slice(key, 2, size(key) - 1)")
    )).alias("key"), "a").distinct()
    kept = candidates.join(covering, ["key", "a"], "left_anti")
    cuts = kept.select("key", "a", F.explode(F.expr("sequence(1, size(key) - 1)")).alias("k"))
    cuts = cuts.select("*", F.expr("slice(key, 1, k)").alias("_left"),
                       F.expr("slice(key, k + 1, size(key))").alias("_right"))
    for side, name in (("_left", "l"), ("_right", "r")):
        part = phrases.select(F.col("key").alias(side), F.col("n").alias(name))
        cuts = cuts.join(part, side).drop(side)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    langs = words.select(F.col("id").alias("_first"), "lang").join(sizes, "lang")
    scored = cuts.withColumn("_first", F.get("key", F.lit(0))).join(langs, "_first")
    worst = scored.groupBy("key", "lang", "a", "n").agg(
        F.min(F.struct(score("a", "n", "l", "r").alias("score"), "k", "l", "r")).alias("_cut")
    )
    return worst.select("key", "lang", "a", "_cut.l", "_cut.r", "n", "_cut.score")


def _spelt(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Replace ``key`` by phrase, its words joined by spaces."""
    parts = rows.select("key", F.posexplode("key").alias("_at", "id")).join(
        words.select("id", "word"), "id"
    )
    spelt = parts.groupBy("key").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda p: p.word
    ), " ").alias("phrase"))
    return rows.join(spelt, "key").drop("key")


def collocations(
    documents: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET
) -> DataFrame:
    """The phrases of two to five words of each language that stand together most.

    ``documents`` has lang and text; extra columns are ignored. A null text is empty, a null
    language is ``und``. Texts lose the case of A-Z and are cut at ends of sentences, commas and
    line breaks; phrases lie within such a piece, words between spaces and tabs. Returns lang, rank
    (from 1), phrase, a (its uses), l and r (the uses of its parts at the cut with the lowest
    score), n (words of the language) and score; the first ``top`` of each language by falling
    score, falling a and phrase. A phrase inside a longer one with as many uses is left out.
    An empty table, or one without such phrases, gives an empty result.
    """
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    seed = 0
    while True:
        words = materialise(count_words(texts, seed), "words")
        if words.where("other IS NOT NULL").isEmpty():
            break
        seed += 1
    words = words.drop("other")
    phrases = materialise(frequent_phrases(texts, words, seed, least, budget), "phrases")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    # Those that tie with the last one stay until their phrases tell them apart.
    first = materialise(
        scored_phrases(phrases, words).withColumn("_rank", F.rank().over(best))
        .where(F.col("_rank") <= top).drop("_rank"), "scored",
    )
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    )
    return _spelt(first, words).withColumn("rank", F.row_number().over(order).cast("long")).where(
        F.col("rank") <= top
    ).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
