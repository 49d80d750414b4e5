"""Pack tokenised documents into sequences by best fit and swap-based local search."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.llm.common import shards_for
from nearstop.scratch import materialise

#: Pieces that one task packs together.
SHARD = 20_000
#: Emptiest sequences of each shard that are packed once more, with those of other shards.
LOOSE, MEETING = 32, 256
#: Entries a worker remembers of what it has tokenised. An entry takes some 250 bytes, and each core
#: of an executor has a worker of its own.
CACHE = 500_000
#: Texts that the tokenizer gets at once.
BATCH = 8192
#: Bytes of UTF-8 texts of plain ASCII and the letters U+00C0 to U+00FF only.
COMMON = bytes([*range(9, 14), *range(32, 127), 0xC3, *range(0x80, 0xC0)])
#: Anything but ASCII and Latin letters: such texts go through the tokenizer whole.
UNUSUAL = re.compile("[^\t-\r\x20-\x7e\xa1-\u012f\u0131-\u02ff]")


class Encoder:
    """Ids of texts, as bytes of 32-bit little-endian numbers.

    ``by_word`` says that the tokenizer lower-cases, never joins text across white space or between
    letters and punctuation, and maps words to byte-level BPE. Then stretches between white space
    are looked up in a cache, and a new word is encoded without the steps that normalise and split.
    """

    def __init__(self, spec: str, by_word: bool):
        # Threads of its own would compete with the other tasks of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        self.by_word = by_word
        # A tokenizer made from the model of another shares its vocabulary in memory.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        # What the tokenizer returns takes far more room than the ids.
        found = (
            e for n in range(0, len(texts), BATCH)
            for e in tokenizer.encode_batch_fast(texts[n:n + BATCH], add_special_tokens=False)
        )
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _usual(self, text: str) -> bool:
        if not self.by_word or "<|" in text:
            return False
        return not text.encode().translate(None, COMMON) or not UNUSUAL.search(text)

    def _learn(self, stretches: set[str]) -> None:
        """Put the ids of new lower-case stretches into the cache."""
        cache, words, others, joined = self.cache, set(), set(), []
        for stretch in stretches:
            core, last = stretch[:-1], stretch[-1]
            if stretch.isalpha():
                words.add(stretch)
            elif core.isalpha() and not last.isalnum() and last != "'":
                joined.append(stretch)
                if core not in cache:
                    words.add(core)
                if last not in cache:
                    others.add(last)
            else:
                others.add(stretch)
        for tokenizer, new in ((self.words, list(words)), (self.tokenizer, list(others))):
            cache.update(zip(new, self._ids(tokenizer, new), strict=True))
        for stretch in joined:
            cache[stretch] = cache[stretch[:-1]] + cache[stretch[-1]]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        cache, new, parts = self.cache, set(), []
        for text in texts:
            stretches = text.lower().split() if self._usual(text) else None
            new.update([s for s in stretches or () if s not in cache])
            parts.append(stretches)
        if len(cache) + len(new) > CACHE:
            # Frequent stretches are among those of these texts; the others may come again or not.
            used = {s for stretches in parts for s in stretches or () if s not in new}
            cache = self.cache = {s: cache[s] for s in used}
        self._learn(new)
        for text, stretches in zip(texts, parts, strict=True):
            if stretches is None:
                yield self._ids(self.tokenizer, [text])[0]
            else:
                yield b"".join(map(cache.__getitem__, stretches))


_ENCODERS: dict[tuple[int, bool], Encoder] = {}


def _encoder(spec: str, by_word: bool) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    key = (zlib.crc32(spec.encode()), by_word)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(spec, by_word)
    return _ENCODERS[key]


def _groups(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``size`` bytes with the number of their first, a null as an empty text.

    Only one run at a time is held as Python texts and tokenised, whatever a batch holds.
    """
    begin = held = 0
    for n, length in enumerate(pc.binary_length(texts).to_pylist()):
        held += length or 0
        if held >= size or n + 1 == len(texts):
            yield begin, [t or "" for t in texts.slice(begin, n + 1 - begin).to_pylist()]
            begin, held = n + 1, 0


def tokenise(
    documents: DataFrame, tokenizer: str, length: int, end_id: int, by_word: bool, keep_ids: bool
) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32 and perhaps ids."""
    spec = documents.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value, by_word)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in _groups(batch.column("text")):
                rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
                for n, found in enumerate(encoder.encode(texts), first):
                    found += end
                    total = len(found) // 4
                    for piece, start in enumerate(range(0, total, length)):
                        part = found[4 * start:4 * (start + length)]
                        rows.append(n)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        if keep_ids:
                            kept.append(np.frombuffer(part, dtype="<i4"))
                columns = [
                    ids.take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (starts, lengths, sums)],
                ]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return documents.select("doc_id", "text").mapInArrow(
        cut, schema + (", ids array<int>" if keep_ids else "")
    )


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: largest first, each into the fullest bin that still takes it."""
    bins = np.empty(len(sizes), dtype=np.int64)
    room: dict[int, list[int]] = {}
    gaps: list[int] = []
    made = 0
    for item in np.argsort(-sizes, kind="stable"):
        size = int(sizes[item])
        at = bisect_left(gaps, size)
        if at < len(gaps):
            gap = gaps[at]
            chosen = room[gap].pop()
            if not room[gap]:
                del room[gap], gaps[at]
        else:
            gap, chosen, made = capacity, made, made + 1
        bins[item] = chosen
        left = gap - size
        if left not in room:
            room[left] = []
            insort(gaps, left)
        room[left].append(chosen)
    return bins


def local_search(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Empty bins by moves and exchanges that raise the sum of squared fills.

    The emptiest bin gives: it moves an item to a fuller bin, or exchanges one or two of its items
    for one smaller item, whichever raises the sum most. When nothing helps, the next emptiest bin
    gives. It ends when the bins are as few as the sizes allow, or when no bin can give. Every step
    raises the sum, so it ends.
    """
    bins = bins.copy()
    fill = np.bincount(bins, weights=sizes).astype(np.int64)
    fewest = -(-int(sizes.sum()) // capacity)
    members: dict[int, list[int]] = {}
    for item, b in enumerate(bins.tolist()):
        members.setdefault(b, []).append(item)
    stuck: set[int] = set()
    while np.count_nonzero(fill) > fewest:
        givers = [b for b in members if b not in stuck and fill[b] < capacity]
        if not givers:
            break
        giver = min(givers, key=lambda b: (fill[b], b))
        moved = False
        while members.get(giver):
            step = _best_step(sizes, bins, fill, members[giver], giver, capacity)
            if step is None:
                break
            out, back, taker = step
            moved = True
            for item in out:
                members[giver].remove(item)
                members[taker].append(item)
                bins[item] = taker
            if back is not None:
                members[taker].remove(back)
                members[giver].append(back)
                bins[back] = giver
            shift = int(sizes[out].sum()) - (int(sizes[back]) if back is not None else 0)
            fill[taker] += shift
            fill[giver] -= shift
        if not members[giver]:
            del members[giver]
        elif not moved:
            stuck.add(giver)
        else:
            stuck.clear()
            stuck.add(giver)
    return bins


def _best_step(sizes, bins, fill, items, giver, capacity):
    """The step that raises the sum of squares most: items out, item back (or None), taker."""
    best, found = 0, None
    own = int(fill[giver])
    gap = capacity - fill
    by_size = {int(sizes[i]): i for i in items}
    open_bins = np.flatnonzero((gap > 0) & (fill > 0) & (np.arange(len(fill)) != giver))
    if not len(open_bins):
        return None

    def gain(shift, taker_fill):
        return 2 * shift * (taker_fill - own + shift)

    for size, item in by_size.items():
        fits = open_bins[gap[open_bins] >= size]
        if len(fits):
            scores = gain(size, fill[fits])
            at = int(scores.argmax())
            if scores[at] > best:
                best, found = int(scores[at]), ([item], None, int(fits[at]))
    singles = sorted(by_size)
    counts: dict[int, list[int]] = {}
    for i in items:
        counts.setdefault(int(sizes[i]), []).append(i)
    outs = {size: [item] for size, item in by_size.items()}
    for n, a in enumerate(singles):
        for b in singles[n:]:
            if a + b < capacity and (a != b or len(counts[a]) > 1):
                outs.setdefault(a + b, [counts[a][0], counts[b][-1]])
    others = np.flatnonzero((gap[bins] > 0) & (bins != giver))
    if not len(others):
        return found
    their, room, filled = sizes[others], gap[bins[others]], fill[bins[others]]
    for size, out in outs.items():
        shift = size - their
        scores = np.where((shift > 0) & (shift <= room), gain(shift, filled), 0)
        at = int(scores.argmax())
        if scores[at] > best:
            best, found = int(scores[at]), (out, int(others[at]), int(bins[others[at]]))
    return found


def _pack(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins and offsets of the pieces of a shard."""
    rows = rows.sort_values("_nr", ignore_index=True)
    sizes = rows["length"].to_numpy(dtype=np.int64)
    bins = local_search(sizes, best_fit(sizes, capacity), capacity)
    order = np.argsort(bins, kind="stable")
    rows, bins, sizes = rows.iloc[order], bins[order], sizes[order]
    ends = sizes.cumsum()
    firsts = np.r_[True, bins[1:] != bins[:-1]]
    begin = (ends - sizes)[firsts]
    number = firsts.cumsum() - 1
    fill = np.bincount(number, weights=sizes).astype(np.int64)
    rank = np.empty(len(fill), dtype=np.int64)
    rank[np.argsort(fill, kind="stable")] = np.arange(len(fill))
    return pd.DataFrame({
        "_nr": rows["_nr"].to_numpy(), "length": sizes, "_shard": rows["_shard"].to_numpy(),
        "_bin": number, "offset": ends - sizes - begin[number],
        "_loose": (rank[number] < LOOSE) & (fill[number] < capacity),
    })


PACKED = "_nr long, length long, _shard long, _bin long, offset long, _loose boolean"


def pack_documents(
    documents: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 1,
    by_word: bool = True, keep_ids: bool = False,
) -> DataFrame:
    """Pack all ``documents`` (doc_id, text) into few sequences of at most ``length`` tokens.

    A document is its ids, then ``end_id``; only one longer than ``length`` is cut. One row per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for. A
    null or empty text is the end id alone; rows that repeat a doc_id are documents of their own;
    extra columns are ignored; an empty table gives an empty result.

    Pieces are spread over shards of about ``SHARD``; each is packed by best fit and local search.
    The emptiest sequences of every shard are then packed again with those of other shards. A full
    piece is a sequence by itself.
    """
    pieces = materialise(
        tokenise(documents, tokenizer, length, end_id, by_word, keep_ids)
        .withColumn("_nr", F.monotonically_increasing_id()), "pieces"
    )
    short = pieces.where(F.col("length") < length).select("_nr", "length")
    shards = shards_for(short.count(), SHARD)
    spread = short.withColumn("_shard", F.pmod(F.xxhash64("_nr"), F.lit(shards)))
    first = materialise(
        spread.groupBy("_shard").applyInPandas(lambda r: _pack(r, length), PACKED), "packed"
    )
    again = first.where("_loose").select(
        "_nr", "length", F.floor(F.col("_shard") / MEETING).alias("_shard")
    ).groupBy("_shard").applyInPandas(lambda r: _pack(r, length), PACKED)

    def numbered(rows: DataFrame, kind: int) -> DataFrame:
        number = (F.shiftleft("_shard", 24) + F.col("_bin")) * 4 + kind
        return rows.select("_nr", number.alias("sequence_id"), "offset")

    placed = numbered(first.where("NOT _loose"), 1).unionByName(numbered(again, 2))
    whole = pieces.where(F.col("length") >= length).select(
        "*", (F.col("_nr") * 4).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return pieces.where(F.col("length") < length).join(placed, "_nr").unionByName(whole).drop("_nr")
