"""Records of files cut into many ranges, against Spark's reader of whole files."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from nearstop.schemas import RENTAL_DROPPED, schema
from nearstop.sources import files
from nearstop.sources.records import read_records

PARTS = ["", "a", 'say "no"', "two\nlines", "x,y", '"', '""', "\r\n", "ü€", " ", "\n\n", "'", "tab\t", "NA"]


def small_ranges(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)


@pytest.fixture(autouse=True)
def usual_ranges(spark):
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def rental_file(path, chance, rows, header=None, end="\n"):
    names = header or [*schema("RENTAL").names, *RENTAL_DROPPED]
    with path.open("w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(names)
        for n in range(rows):
            row = {name: "".join(chance.choices(PARTS, k=chance.choice([0, 1, 1, 3]))) for name in names}
            row["scoutId"] = str(n)
            if n % 5 == 0:
                row[RENTAL_DROPPED[0]] = 'long "text"\n' * chance.randrange(60)
            writer.writerow([row[name] for name in names])


def by_whole_files(spark, path):
    raw = spark.read.format("csv").options(
        header=True, multiLine=True, quote='"', escape='"', enforceSchema=False
    ).load(path)
    from nearstop.functions.text import null_token_to_null

    return raw.select(*[
        null_token_to_null(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string"
        else F.trim(null_token_to_null(F.col(f.name))).try_cast(f.dataType).alias(f.name)
        for f in schema("RENTAL").fields
    ])


def found(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(("size", "end"), [(97, "\n"), (1000, "\n"), (150, "\r\n"), (1 << 20, "\r\n")])
def test_equals_the_reader_of_whole_files(spark, tmp_path, size, end):
    chance = random.Random(size)
    for n in range(2):
        rental_file(tmp_path / f"{n}.csv", chance, 25, end=end)
    expected = found(by_whole_files(spark, str(tmp_path)))
    small_ranges(spark, size)
    assert found(files.read_rentals(spark, str(tmp_path))) == expected


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rental_file(tmp_path / "all.csv", random.Random(4), 300)
    small_ranges(spark, 4000)
    lines = spark.read.format("text").option("lineSep", "\n").load(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    assert read_records(lines).count() == 301


@pytest.mark.parametrize("size", [1, 2, 3, 5, 1 << 20])
def test_cuts_at_quotes_and_line_breaks(spark, tmp_path, size):
    # One record spans the whole file but for the ends, and a range may hold a single byte.
    text = 'h\n"a\n\n""b"\n\n"' + "\n" * 9 + '"\nplain\n"open\nend'
    (tmp_path / "x.csv").write_bytes(text.encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    small_ranges(spark, size)
    rows = read_records(spark.read.format("text").option("lineSep", "\n").load(str(tmp_path)))
    assert sorted((r.is_first, r.text) for r in rows.collect()) == sorted([
        (True, "h"), (False, '"a\n\n""b"'), (False, '"' + "\n" * 9 + '"'), (False, "plain"),
        (False, '"open\nend'),
    ])


def test_another_header_is_refused(spark, tmp_path):
    names = [*schema("RENTAL").names, *RENTAL_DROPPED]
    rental_file(tmp_path / "a.csv", random.Random(1), 3, names)
    rental_file(tmp_path / "b.csv", random.Random(2), 3, names[::-1])
    with pytest.raises(Exception, match="another header than the first file"):
        files.read_rentals(spark, str(tmp_path)).collect()
