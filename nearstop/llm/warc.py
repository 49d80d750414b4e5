"""A content-addressed archive of WARC records.

Payload bytes are stored once per SHA-256 digest, record headers exactly and apart from them.
Records are rebuilt by a join on the digest, which is checked against the bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearstop.scratch import materialise, scratch_path

BREAK = "\r\n"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records that an archive file holds at most, before compression; a larger record has a
#: file of its own. A reader holds one compressed file at a time.
FILE_BYTES = 32 << 20

RECORD = pa.schema([
    ("header", pa.binary()), ("packed", pa.binary()), ("body_digest", pa.string()),
    ("file", pa.string()), ("at", pa.int64()),
])


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as bare upper-case base32: 32 digits of five bits, eight from each ten hex digits."""
    hexadecimal = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(hexadecimal, 10 * n + 1, 10), 16, 32), 8, "0") for n in range(4)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def page_payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (html in UTF-8, empty for null) and its digests."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), base32_sha1(F.col("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )


def _header(fields: list[tuple[str, Column]]) -> Column:
    """The header block; a field with a null value is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)) for name, value in fields]
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"), *[F.coalesce(line, F.lit("")) for line in lines], F.lit(BREAK)
    )


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    """A stable UUID of a page: the same row always gets the same record id."""
    named = F.concat_ws("\u0001", F.coalesce(page.cast("string"), F.lit("-")), url, digest)
    h = F.md5(named.cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def page_records(pages: DataFrame) -> DataFrame:
    """One WARC record per page: header (exact bytes, with its empty line) and body.

    Among pages with equal payloads, that with the largest page_id is a response with the payload
    as its body; the others are revisits of it without a body. Rows that repeat the largest id are
    all responses; pages without an id revisit any page that has one. Line breaks in a url are
    percent-encoded, a null url leaves the field out.
    """
    rows = page_payloads(pages)
    narrow = rows.select("page_id", "url", "digest")
    # The url of the response decides its record id, so the pick is one struct.
    best = materialise(narrow.groupBy("digest").agg(
        F.count(F.lit(1)).alias("_copies"),
        F.max(F.struct("page_id", "url")).alias("_best"),
    ).where("_copies > 1").select("digest", "_best"), "responses")
    joined = rows.join(best, "digest", "left")
    is_response = F.col("_best").isNull() | F.col("page_id").eqNullSafe(F.col("_best.page_id"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    body = F.when(is_response, F.col("payload")).otherwise(F.lit(b""))
    refers = F.when(~is_response, F.col("_best.page_id"))
    header = _header([
        ("WARC-Type", F.when(is_response, F.lit("response")).otherwise(F.lit("revisit"))),
        ("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("digest"))),
        ("WARC-Target-URI", url),
        ("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ("X-Payload-SHA256", F.col("digest")),
        ("X-Page-ID", F.col("page_id").cast("string")),
        ("X-Refers-To-Page-ID", refers.cast("string")),
        ("WARC-Refers-To", F.when(~is_response, _record_id(
            F.col("_best.page_id"), F.col("_best.url"), F.col("digest")
        ))),
        ("WARC-Profile", F.when(~is_response, F.lit(REVISIT_PROFILE))),
        ("Content-Type", F.lit("application/octet-stream")),
        ("Content-Length", F.octet_length(body).cast("string")),
    ])
    return joined.select(F.encode(header, "UTF-8").alias("header"), body.alias("body"))


def write_warc(records: DataFrame, path: str, most: int = FILE_BYTES) -> None:
    """Write records (header, body) as gzipped WARC files of at most ``most`` bytes.

    The line writer ends every row with the two line breaks that the format asks for; a row is a
    file. Each task writes what it has; nothing is shuffled.
    """
    def content(held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], ["value"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for header, body in zip(batch.column("header"), batch.column("body"), strict=True):
                record = header.as_py() + body.as_py()
                if held and size + len(record) > most:
                    yield content(held)
                    held, size = [], 0
                held.append(record)
                size += len(record) + len(END)
        if held:
            yield content(held)

    files = records.select("header", "body").mapInArrow(gathered, "value binary")
    files.select(F.col("value").cast("string")).write.options(
        lineSep=END.decode(), compression="gzip", maxRecordsPerFile=1
    ).text(path)


def _records(stream: io.BufferedIOBase, path: str) -> Iterator[tuple[bytes, bytes, int]]:
    """Header, body and place of every record of a WARC stream."""
    at = 0
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: no record header at byte {at}")
        lines = [line]
        while (line := stream.readline()) != BREAK.encode():
            if not line:
                raise ValueError(f"{path}: a header is cut short at byte {at}")
            lines.append(line)
        lines.append(line)
        lengths = [
            int(x.split(b":", 1)[1]) for x in lines if x.lower().startswith(b"content-length:")
        ]
        if len(lengths) != 1:
            raise ValueError(f"{path}: a record without one Content-Length at byte {at}")
        header, body = b"".join(lines), stream.read(lengths[0])
        if len(body) != lengths[0] or stream.read(len(END)) != END:
            raise ValueError(f"{path}: a record is cut short at byte {at}")
        yield header, body, at
        at += len(header) + len(body) + len(END)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor()
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            name, raw = path.as_py(), pa.BufferReader(content.as_buffer())
            packed = content.as_buffer().slice(0, 2).to_pybytes() == b"\x1f\x8b"
            stream = gzip.GzipFile(fileobj=raw) if packed else raw
            rows, held = [], 0
            for header, body, at in _records(io.BufferedReader(stream, 1 << 20), name):
                digest = hashlib.sha256(body).hexdigest()
                rows.append((header, packer.compress(body), digest, name, at))
                held += len(rows[-1][1]) + len(header)
                if held >= 4 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [
        pa.array(column, field.type) for column, field in zip(zip(*rows), RECORD, strict=True)
    ]
    return pa.record_batch(columns, schema=RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records below a folder of WARC files, gzipped or plain.

    Columns: header, packed (the body, compressed by zstd), body_digest, file and at (the record's
    byte in it). Bodies are cut by Content-Length, so they may hold any bytes. A file that is not
    made of whole records raises. A task holds one file as it is stored, and a few records.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(
        _parse, "header binary, packed binary, body_digest string, file string, at long"
    )


def header_field(name: str) -> Column:
    """The value of a header field, null if there is none."""
    return F.get(F.regexp_extract_all(
        F.decode("header", "UTF-8"), F.lit(rf"(?im)^{name}:[ \t]*([^\r\n]*)"), F.lit(1)
    ), F.lit(0))


def store_archive(records: DataFrame, root: str) -> None:
    """Write records (as from ``read_warc``) as two tables: headers, and payloads by digest.

    ``headers`` has the exact header of every record and the digest of its payload; a revisit has
    no body, so its header names it. ``payloads`` has each digest once, its bytes compressed. A
    body that does not have the digest its header names raises.
    """
    spark = records.sparkSession
    named, kind = header_field("X-Payload-SHA256"), header_field("WARC-Type")
    rows = records.select(
        "header", kind.alias("kind"), "body_digest", named.alias("named"), "file", "at"
    )
    wrong = (F.col("kind") != "revisit") & (F.col("named") != F.col("body_digest"))
    rows.select("header", "kind", "body_digest", "file", "at", F.when(
        wrong, F.raise_error(F.concat(F.lit("a payload differs from its digest "), "named"))
    ).when(F.col("kind") == "revisit", F.coalesce("named", "body_digest")).otherwise(
        F.col("body_digest")
    ).alias("digest")).write.parquet(f"{root}/headers")
    # Of records with equal bytes the first by file and place keeps them; the others are left out.
    holders = spark.read.parquet(f"{root}/headers").where("digest = body_digest").select(
        "digest", "file", "at"
    )
    first = materialise(holders.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("file", "at")).alias("first")
    ).where("n > 1").select("digest", "first"), "first")
    extra = materialise(holders.join(first, "digest").where(
        F.struct("file", "at") != F.col("first")
    ).select("file", "at"), "extra")
    bodies = records.where((kind != "revisit") | named.isNull() | (named == F.col("body_digest")))
    if not extra.isEmpty():
        bodies = bodies.join(extra, ["file", "at"], "left_anti")
    bodies.select(F.col("body_digest").alias("digest"), "packed").write.parquet(
        f"{root}/payloads", compression="none"
    )


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unpack payloads and check them against their digests, a few at a time."""
    unpacker = zstandard.ZstdDecompressor()
    names = ["header", "kind", "payload"]
    for batch in batches:
        rows, held = [], 0
        for header, kind, digest, packed in zip(
            *[batch.column(c) for c in ("header", "kind", "digest", "packed")], strict=True
        ):
            digest = digest.as_py()
            payload = unpacker.decompress(packed.as_py()) if packed.is_valid else None
            if payload is None or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"no payload with digest {digest}")
            rows.append((header.as_py(), kind.as_py(), payload))
            held += len(payload)
            if held >= 8 << 20:
                yield pa.RecordBatch.from_arrays(_columns(rows), names=names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(_columns(rows), names=names)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = (pa.binary(), pa.string(), pa.binary())
    return [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]


def restore_records(spark: SparkSession, root: str) -> DataFrame:
    """Rebuild every record: header, kind, payload (full, also for revisits) and body (as stored).

    Headers are joined with payloads by digest. A digest without bytes, or bytes that do not have
    it, raise.
    """
    headers = spark.read.parquet(f"{root}/headers").select(
        "header", "kind", "digest"
    )
    payloads = spark.read.parquet(f"{root}/payloads")
    joined = headers.join(payloads, "digest", "left").select("header", "kind", "digest", "packed")
    rows = joined.mapInArrow(_unpack, "header binary, kind string, payload binary")
    length = header_field("Content-Length").cast("long")
    body = F.when(length == F.octet_length("payload"), F.col("payload")).otherwise(F.lit(b""))
    return rows.select("header", "kind", "payload", body.alias("body"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write a record per page, read the archives back and rebuild all records from the store.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to and url, all
    from the records read back. A null html is an empty payload; empty payloads are equal too. An
    empty table gives no rows.
    """
    spark = pages.sparkSession
    root = scratch_path(spark, "archive")
    write_warc(page_records(pages), f"{root}/warc")
    store_archive(read_warc(spark, f"{root}/warc"), f"{root}/store")
    kind = pages.schema["page_id"].dataType
    return restore_records(spark, f"{root}/store").select(
        header_field("X-Page-ID").cast(kind).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        header_field("X-Refers-To-Page-ID").cast(kind).alias("refers_to"),
        header_field("WARC-Target-URI").alias("url"),
    )
