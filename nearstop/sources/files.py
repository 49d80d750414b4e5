"""Readers of the input files."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearstop.functions.text import null_token_to_null
from nearstop.schemas import RENTAL_DROPPED, require_columns, require_same_columns, schema
from nearstop.sources.records import read_records


class SourceNotFound(FileNotFoundError):
    """The path of a source does not exist."""


def _load(reader, path: str) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(path) from error
        raise


def read_rentals(spark: SparkSession, path: str) -> DataFrame:
    """Rental offers from comma-separated files with a header and quoted multi-line texts.

    Cells are read as text by header name; null tokens become null, and so does a cell that does
    not read as the type of its column. A quoted text may hold line breaks; quotes in it are
    doubled, and there are none outside of quoted texts. A file is read by many tasks, see
    ``read_records``. All files need the same header; one with another order of columns raises.
    """
    csv = {"quote": '"', "escape": '"'}
    # Only the header of the first file is read here.
    head = _load(
        spark.read.format("csv").options(header=True, multiLine=True, **csv), path
    )
    require_columns(head, RENTAL_DROPPED)
    names = head.columns
    expected = schema("RENTAL")
    require_same_columns(head.drop(*RENTAL_DROPPED), expected)
    lines = _load(spark.read.format("text").option("lineSep", "\n"), path)
    cells = T.StructType([T.StructField(f"_{n}", T.StringType()) for n in range(len(names))])
    records = read_records(lines).select("is_first", "file", F.from_csv(
        # The first record may begin with a byte order mark.
        F.when(F.col("is_first"), F.ltrim(F.col("text"), F.lit("\ufeff"))).otherwise(F.col("text")),
        cells.simpleString()[len("struct<"):-1].replace(":", " "), csv,
    ).alias("_row"))
    same = reduce(lambda a, b: a & b, [
        F.lower(F.col(f"_row._{n}")).eqNullSafe(F.lit(name.lower())) for n, name in enumerate(names)
    ])
    other = F.raise_error(F.concat(F.lit("another header than the first file: "), F.col("file")))
    rows = records.where(F.when(
        F.col("is_first"), F.when(same, F.lit(False)).otherwise(other.cast("boolean"))
    ).otherwise(F.lit(True)))

    def typed(field: T.StructField):
        text = null_token_to_null(F.col(f"_row._{names.index(field.name)}"))
        if field.dataType == T.StringType():
            return text.alias(field.name)
        return F.trim(text).try_cast(field.dataType).alias(field.name)

    return rows.select(*[typed(field) for field in expected.fields])


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Stations from semicolon-separated files, one record per line; bad cells become null.

    A file whose header is not that of the schema, in its order, raises.
    """
    return _load(
        spark.read.format("csv").schema(schema("STATION")).option("header", True)
        .option("sep", ";").option("quote", '"').option("multiLine", False)
        .option("ignoreLeadingWhiteSpace", True).option("mode", "PERMISSIVE")
        .option("enforceSchema", False),
        path,
    )


def read_municipal_zips(
    spark: SparkSession, path: str, format: str = "csv", **options: str
) -> DataFrame:
    """Zip code per municipality, from an export of the directory sheet.

    ``format`` and ``options`` go to the reader, so that a spreadsheet source on the class path
    can read the sheet itself.
    """
    columns = schema("MAPPING_MUNICIPAL_ZIP")
    if format == "csv":
        options = {"header": "true", **options}
    df = _load(spark.read.format(format).options(**options), path)
    require_columns(df, columns.names)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns.fields])


def read_zip_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Central point of each zip code from comma-separated files; bad cells become null.

    A file whose header is not that of the schema, in its order, raises.
    """
    return _load(
        spark.read.format("csv").schema(schema("MAPPING_ZIP_COOR")).option("header", True)
        .option("sep", ",").option("ignoreLeadingWhiteSpace", True)
        .option("mode", "PERMISSIVE").option("enforceSchema", False),
        path,
    )


def source_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, or anything a pattern names, exists on a file system the session reaches.

    The file system is asked for the path alone; what lies below it is not listed.
    """
    wanted = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = wanted.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(wanted)
    return found is not None and len(found) > 0
