"""Stored tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from nearstop.schemas import require_columns
from nearstop.sources.files import _load

RUN = "_run"


def table_path(root: str, name: str) -> str:
    """Path of table ``name``, which may be given as ``x``, ``x.parquet`` or ``x.parquet/``."""
    return f"{root.rstrip('/')}/{name.rstrip('/').removesuffix('.parquet')}.parquet"


def read_table(
    spark: SparkSession, name: str, root: str, partition_by: str | None = None
) -> DataFrame:
    """Table ``name`` below ``root``; a missing table raises ``SourceNotFound``.

    ``partition_by`` names a text column the table is partitioned by. Without it Spark would read
    folder names that look like numbers, such as zip groups, as numbers.
    """
    path = table_path(root, name)
    df = _load(spark.read.format("parquet"), path)
    if partition_by is not None:
        require_columns(df, [partition_by])
        as_text = [
            StructField(f.name, StringType()) if f.name == partition_by else f
            for f in df.schema.fields
        ]
        df = spark.read.schema(StructType(as_text)).parquet(path)
    return df.drop(RUN)


def spread(table: DataFrame) -> DataFrame:
    """A scanned table with at least one task per core.

    A small table is one file and would be one task. Tables with enough files stay as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)
