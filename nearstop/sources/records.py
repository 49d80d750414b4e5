"""Records of text files whose quoted fields may hold line breaks, each file read by many tasks.

Whether a byte range begins inside a quoted field depends on the number of quotes before it. A
first pass counts the quotes of each range, their sums over a file tell how its ranges begin, and a
second pass cuts each range into records by itself. A record that crosses ranges is put together
from its pieces; no other text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearstop.scratch import materialise

#: A record, or a piece of one: its beginning, its end, or what lies between in a whole range.
WHOLE, BEGIN, END, MIDDLE = range(4)
RANGE = ["file", "range"]
#: Times the files are read again if they were cut differently in the two passes.
TRIES = 5


class FilesChanged(RuntimeError):
    """Files were cut into other ranges in the second pass than in the first."""


def _cut(lines: DataFrame, inside: set[tuple[str, int]], returns: set[str], quote: str) -> DataFrame:
    """The records and pieces of each range: file, range, nr, kind and text.

    ``inside`` are the ranges that begin inside a field, ``returns`` the files whose lines end with
    a carriage return too.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, nr, held, is_open, kind = None, 0, [], False, WHOLE

        def ended() -> list[tuple]:
            if not held:
                return []
            return [(*place, nr, MIDDLE if kind == END else BEGIN, "\n".join(held))]

        for batch in batches:
            out = []
            for *at, line in zip(
                *[batch.column(c).to_pylist() for c in (*RANGE, "value")], strict=True
            ):
                if tuple(at) != place:
                    out += ended()
                    place, nr, held = tuple(at), 0, []
                    is_open = place in inside
                    kind = END if is_open else WHOLE
                held.append(line.removesuffix("\r") if place[0] in returns else line)
                is_open ^= line.count(quote) % 2 == 1
                if not is_open:
                    out.append((*place, nr, kind, "\n".join(held)))
                    nr, held, kind = nr + 1, [], WHOLE
            if out:
                yield made(out)
        if place is not None and (out := ended()):
            yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=[*RANGE, "nr", "kind", "text"],
        )

    return lines.mapInArrow(scan, "file string, range long, nr long, kind int, text string")


def read_records(texts: DataFrame, quote: str = '"') -> DataFrame:
    """file, is_first (of its file) and text of each record of files.

    ``texts`` are their lines as read by Spark's text source with a line feed as separator.

    A record ends at a line break outside of quotes; the line break is not part of it. Where the
    first line of a file ends with a carriage return, line breaks with one count as plain ones,
    also within quotes, as they do for Spark's reader of whole files. Quotes must
    be paired, as they are if those within a quoted field are doubled and other fields have none.
    Empty records are left out. The records are stored, as the ranges of a file are only known to
    be the same within one call.
    """
    lines = texts.select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
    )
    count = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    for _ in range(TRIES):
        ranges = materialise(lines.withColumn("_nr", F.monotonically_increasing_id()).groupBy(
            *RANGE
        ).agg(
            F.sum(count).alias("quotes"),
            F.min_by(F.endswith("value", F.lit("\r")), "_nr").alias("returns"),
        ), "ranges")
        before = Window.partitionBy("file").orderBy("range").rowsBetween(
            Window.unboundedPreceding, -1
        )
        odd = ranges.withColumn("before", F.sum("quotes").over(before)).where("before % 2 = 1")
        # One entry at most for each range that begins inside a field.
        inside = {(r.file, r.range) for r in odd.select(*RANGE).collect()}
        returns = {r.file for r in ranges.where("range = 0 AND returns").select("file").collect()}
        pieces = materialise(_cut(lines, inside, returns, quote), "records")
        cut = pieces.select(*RANGE).distinct()
        if (
            cut.join(ranges, RANGE, "left_anti").isEmpty()
            and ranges.join(cut, RANGE, "left_anti").isEmpty()
        ):
            break
    else:
        raise FilesChanged("the files were cut differently each time they were read")
    whole = pieces.where(F.col("kind") == WHOLE).select(*RANGE, "nr", "text")
    order = Window.partitionBy("file").orderBy("range", "nr")
    crossing = pieces.where(F.col("kind") != WHOLE).withColumn(
        "record", F.sum((F.col("kind") == BEGIN).cast("int")).over(order)
    ).groupBy("file", "record").agg(
        F.min(F.struct("range", "nr")).alias("at"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("range", "nr", "text"))), lambda p: p.text
        ), "\n").alias("text"),
    ).select("file", "at.range", "at.nr", "text")
    records = whole.unionByName(crossing).select(
        "file", ((F.col("range") == 0) & (F.col("nr") == 0)).alias("is_first"),
        "text",
    )
    return records.where(F.col("text") != "")
