"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_run: ContextVar[str] = ContextVar("run", default="")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh folder of its own. On a cluster a folder of
    one machine would be lost with it, so the setting is required there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="nearstop-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{scratch_root(spark).rstrip('/')}/nearstop/{_run.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Keep the intermediate tables of a block in a folder that is removed when the block ends.

    What the block leaves must be stored elsewhere by then: no DataFrame that reads an intermediate
    table can be used after it.
    """
    name = f"run-{uuid.uuid4().hex}/"
    folder = f"{scratch_root(spark).rstrip('/')}/nearstop/{_run.get()}{name}"
    token = _run.set(_run.get() + name)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(function: Callable) -> Callable:
    """A stage (spark, ...) that stores its results: its intermediate tables go when it ends."""
    @wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch_run(spark):
            return function(spark, *args, **kwargs)

    return run


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later steps then neither repeat the work behind ``df`` nor depend on the executors that did it.
    Unlike ``checkpoint()`` the rows are computed once and stay columnar.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
