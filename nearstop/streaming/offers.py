"""New offers as a stream, answered batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from nearstop.operators.match import nearest_stations
from nearstop.scratch import scratch_run
from nearstop.sinks.tables import append_run

OFFER = "scoutId int, zip_group string, lat double, lng double"


def nearest_of_batch(
    stations: DataFrame, root: str, name: str, k: int
) -> Callable[[DataFrame, int], None]:
    """What to do with a batch of offers: store their nearest stations as a run of table ``name``.

    The run is named after the batch, so a batch that is delivered again replaces its own rows.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch_run(batch.sparkSession):
            append_run(nearest_stations(batch, stations, k), name, root, f"batch{batch_id}")

    return store


def stream_nearest_stations(
    spark: SparkSession, offers: str, stations: DataFrame, root: str, checkpoint: str,
    name: str = "table_nearest_stream", k: int = 10, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Answer the offers in the Parquet files that have come to folder ``offers``, and end.

    ``checkpoint`` remembers which files are done: run it again for those that came since. The
    result is table ``name`` below ``root``, with the rows of ``nearest_stations``.
    """
    came = spark.readStream.schema(OFFER).option("maxFilesPerTrigger", files_per_batch).parquet(offers)
    return (
        came.writeStream.foreachBatch(nearest_of_batch(stations, root, name, k))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
