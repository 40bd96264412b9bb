"""Synthetic sensor events: numbered ticks, one event per sensor and tick."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.render import constant_payload, json_line, timestamp_text


def event_numbers(spark: SparkSession, events_per_sec: float = 1.0) -> DataFrame:
    """An endless stream of (eventNumber, timestamp). Numbering goes on from the checkpoint after a restart.

    The rate source takes whole rates: above 1 the rate is rounded, below 1 every n-th tick of one second is kept.
    """
    if events_per_sec <= 0:
        raise ValueError("events_per_sec must be positive")
    source = spark.readStream.format("rate")
    if events_per_sec >= 1:
        ticks = source.option("rowsPerSecond", round(events_per_sec)).load()
        return ticks.select(F.col("value").alias("eventNumber"), "timestamp")
    step = round(1 / events_per_sec)
    ticks = source.option("rowsPerSecond", 1).load().where(F.col("value") % step == 0)
    return ticks.select(F.expr(f"value div {step}").alias("eventNumber"), "timestamp")


def sample_events(numbers: DataFrame, sensors: int = 1, data_size: int = 10) -> DataFrame:
    """Each numbered tick once per sensor 0..n-1, with the tick's time also as text and a constant payload."""
    return numbers.select(
        F.explode(F.sequence(F.lit(0), F.lit(max(sensors, 1) - 1))).alias("sensorId"),
        "eventNumber",
        "timestamp",
        timestamp_text(F.date_trunc("millisecond", "timestamp")).alias("timestampStr"),
        constant_payload(data_size).alias("data"),
    ).where(F.lit(sensors > 0))


def sample_event_lines(events: DataFrame) -> DataFrame:
    """The events as JSON in `line`, beside `sensorId` and `eventNumber`."""
    names = ("sensorId", "eventNumber", "timestamp", "timestampStr", "data")
    return events.select("sensorId", "eventNumber", json_line(events, *names).alias("line"))
