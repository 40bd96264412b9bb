"""Appending to an event stream, each batch exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.events import (
    EVENT_SCHEMA,
    POSITION_SCHEMA,
    append_name,
    create_stream,
    data_folder,
    path_exists,
    positions_folder,
    read_positions,
)


def segment_of(routing_key: Column, segments: int) -> Column:
    """Events with the same routing key share a segment and so stay in order."""
    return F.pmod(F.xxhash64(routing_key), F.lit(segments)).cast("int")


def _next_offset(spark: SparkSession, path: str) -> int:
    """The offset after the last event of all appends, whoever wrote them."""
    return read_positions(spark, path).agg(F.max("next_offset").alias("n")).first().n or 0


def append_events(
    df: DataFrame,
    path: str,
    writer: str,
    batch_id: int,
    event: Column,
    order: Column,
    routing_key: Column,
    segments: int = 1,
    span: tuple[int, int] | None = None,
) -> bool:
    """Append one batch to a stream; False if this batch of this writer is there already.

    `order` is a bigint that is unique within the batch and rises in the order the events are to have. Offsets are the
    order values shifted behind the current end, so they rise without sorting or numbering the rows; gaps stay gaps.
    `span` tells the first and last value that `order` can have, where that is known without running `df`.

    One writer at a time appends to a stream. An append that finds another one committed meanwhile fails, and may be
    tried again: its data is not counted and will be replaced.
    """
    spark = df.sparkSession
    create_stream(spark, path)
    name = append_name(writer, batch_id)
    data, positions = f"{data_folder(path)}/{name}", f"{positions_folder(path)}/{name}"
    if path_exists(spark, f"{positions}/_SUCCESS"):
        return False
    base = _next_offset(spark, path)
    rows = df.select(order.cast("bigint").alias("_order"), routing_key.alias("routing_key"), event.alias("event"))
    if span is None:
        ends = rows.agg(F.min("_order").alias("first"), F.max("_order").alias("last")).first()
        span = (ends.first, ends.last) if ends.first is not None else (0, -1)
    first, last = span
    following = base + last - first + 1
    shift = base - first
    rows.select(
        segment_of(F.col("routing_key"), segments).alias("segment"),
        (F.col("_order") + F.lit(shift)).alias("offset"),
        "routing_key",
        "event",
        F.current_timestamp().alias("append_ts"),
    ).write.mode("overwrite").parquet(data)

    touched = (
        spark.read.schema(EVENT_SCHEMA).parquet(data).groupBy("segment")
        .agg(F.min("offset").alias("head"), (F.max("offset") + 1).alias("tail"))
    )
    if _next_offset(spark, path) != base:
        raise RuntimeError(f"another writer appended to {path} while {name} was written; try again")
    # An empty batch still leaves one row without a segment, so that the next batch finds its offset here.
    anchor = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
    anchor.join(touched.withColumn("batch", F.lit(batch_id).cast("bigint")), "batch", "left").select(
        F.lit(writer).alias("writer"),
        "batch",
        "segment",
        "head",
        "tail",
        F.lit(following).cast("bigint").alias("next_offset"),
    ).coalesce(1).write.mode("overwrite").parquet(positions)
    return True
