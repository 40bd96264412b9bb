"""Following an event stream in micro-batches of whole appends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.render import hour_bucket
from millrace.sources.events import (
    POSITION_SCHEMA,
    Cut,
    appends_within,
    create_stream,
    positions_folder,
    read_appends,
)

# Appends taken into one micro-batch. The driver lists their folders, so this also bounds what it holds.
APPENDS_PER_BATCH = 100

Handler = Callable[[DataFrame, int, str], None]


def follow(
    spark: SparkSession,
    path: str,
    handle: Handler,
    checkpoint: str,
    start: Cut | None = None,
    end: Cut | None = None,
    interval_ms: int | None = None,
    name: str | None = None,
    appends_per_batch: int = APPENDS_PER_BATCH,
) -> StreamingQuery:
    """Call `handle(events, batch_id, bucket)` for each micro-batch.

    The query streams over the small positions files; the events of the appends they announce are then read as a
    batch, so that a handler can use every batch operator. `bucket` is the hour of the batch as the checkpoint has it,
    so a batch that runs again gets the same one. With an `end`, or without `interval_ms`, the query stops once all
    that is there has been read.
    """
    create_stream(spark, path)
    announced = (
        spark.readStream.schema(POSITION_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", appends_per_batch)
        .parquet(positions_folder(path))
        .withColumn("bucket", hour_bucket(F.current_timestamp()))
    )

    def on_batch(appends: DataFrame, batch_id: int) -> None:
        session = appends.sparkSession
        bucket = appends.select("bucket").first().bucket
        events = read_appends(session, path, appends_within(appends, start, end), start, end)
        handle(events, batch_id, bucket)

    query = announced.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        query = query.queryName(name)
    if end is not None or interval_ms is None:
        return query.trigger(availableNow=True).start()
    return query.trigger(processingTime=f"{interval_ms} milliseconds").start()
