"""Writers of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearstop.schemas import require_columns
from nearstop.sources.tables import RUN, table_path

#: The run that ``write_table`` writes.
BASE_RUN = "base"


def write_table(
    df: DataFrame, name: str, root: str, *, partition_by: str | None = None,
    sort_by: str | None = None,
) -> str:
    """Write ``df`` over table ``name`` and return its path.

    The rebalance hint lets Spark size the files from the measured data: a small table ends up as
    one file, and a partition value with very many rows is spread over several tasks and files.
    Without a partition column the rows are the base run, to which ``append_run`` adds others. A
    blank partition value becomes null, as a folder name cannot tell the two apart.

    With ``sort_by`` each file holds a range of the values of that column, in order. A filter on it
    then skips all files and row groups but those whose range has the value.
    """
    path = table_path(root, name)
    if sort_by is not None:
        require_columns(df, [sort_by])
        # Without a number of parts adaptive execution merges small ones.
        ranges = df.repartitionByRange(sort_by).sortWithinPartitions(sort_by)
        dealt, folder = ranges.withColumn(RUN, F.lit(BASE_RUN)), RUN
    elif partition_by is None:
        dealt, folder = df.withColumn(RUN, F.lit(BASE_RUN)).hint("rebalance"), RUN
    else:
        require_columns(df, [partition_by])
        value = F.col(partition_by)
        blank = F.nullif(value, F.lit("")) if dict(df.dtypes)[partition_by] == "string" else value
        dealt, folder = df.withColumn(partition_by, blank).hint("rebalance", value), partition_by
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        folder
    ).parquet(path)
    return path


def extract_table(
    df: DataFrame, columns: list[str], name: str, root: str, *, partition_by: str | None = None,
    sort_by: str | None = None,
) -> str:
    """Write the distinct rows of the given columns as table ``name``."""
    require_columns(df, columns)
    return write_table(
        df.select(*columns).dropDuplicates(), name, root, partition_by=partition_by,
        sort_by=sort_by,
    )


def append_run(df: DataFrame, name: str, root: str, run: str) -> str:
    """Add the rows of one run to table ``name``; repeating a run replaces its rows.

    The table may be new, or written by ``write_table`` without a partition column.
    """
    path = table_path(root, name)
    df.hint("rebalance").write.mode("overwrite").parquet(f"{path}/{RUN}={run}")
    return path
