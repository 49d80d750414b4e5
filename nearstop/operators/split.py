"""Row numbers, quantiles and splits of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearstop.sinks.tables import append_run
from nearstop.sources.tables import RUN, read_table, table_path

QUANTILE_ERROR = 0.00001
#: Size of a sketch, and the share of rows that a quantile from it may be off by: three times the
#: bound that holds with 99 % certainty, for one run or for many that were merged.
SKETCH_ITEMS, SKETCH_ERROR = 8192, 0.002


def with_row_id(df: DataFrame, name: str = "_id") -> DataFrame:
    """Add a number unique to each row.

    It depends on how rows are spread over tasks: store the table before using the number twice.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def split_at_quantile(
    df: DataFrame, column: str, quantile: float = 0.5, error: float = QUANTILE_ERROR
) -> tuple[DataFrame, DataFrame]:
    """The rows up to an approximate quantile of ``column``, and the rows above it.

    Rows where the column is null are in neither part.
    """
    middle = df.approxQuantile(column, [quantile], error)[0]
    return df.where(F.col(column) <= middle), df.where(F.col(column) > middle)


def _sketch_table(name: str, column: str) -> str:
    return f"{name}_sketch_{column}"


def append_with_sketch(df: DataFrame, name: str, root: str, run: str, columns: list[str]) -> None:
    """``append_run`` that also keeps a sketch of each of the number ``columns`` of the run.

    The sketch of a run has a bounded size. Repeating a run replaces its rows and its sketches.
    """
    append_run(df, name, root, run)
    # Read back, so that what the sketches hold is what was stored.
    stored = df.sparkSession.read.parquet(f"{table_path(root, name)}/{RUN}={run}")
    for column in columns:
        sketch = stored.agg(
            F.kll_sketch_agg_double(F.col(column).cast("double"), SKETCH_ITEMS).alias("sketch")
        )
        append_run(sketch, _sketch_table(name, column), root, run)


def stored_quantiles(
    spark: SparkSession, name: str, root: str, column: str, quantiles: list[float]
) -> DataFrame:
    """``quantile``, ``value`` and ``n_rows`` for each of ``quantiles``, from the runs' sketches.

    Rows where the column is null do not count. No run is read again; ``value`` is off by a share
    ``SKETCH_ERROR`` of the rows at most. Without any value it is null.
    """
    sketches = read_table(spark, _sketch_table(name, column), root).where(
        F.kll_sketch_get_n_double("sketch") > 0
    )
    merged = sketches.agg(F.kll_merge_agg_double("sketch", SKETCH_ITEMS).alias("sketch"))
    known = F.kll_sketch_get_n_double("sketch")
    # An empty sketch has no quantiles, and the function takes constants only.
    found = [
        F.struct(F.lit(q).alias("quantile"), F.when(
            known > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))
        ).alias("value"), known.alias("n_rows")) for q in quantiles
    ]
    return merged.select(F.inline(F.array(*found)))


def reunite(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both parts of a split as one table, matched by column name."""
    return first.unionByName(second)
