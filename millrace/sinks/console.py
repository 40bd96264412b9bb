"""Printing events where they are processed, without passing them through the driver."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def print_lines(df: DataFrame, text: str = "line", prefix: str = "") -> None:
    """Print the text column of every row to the standard error of the task that holds it."""
    lead = f"{prefix}> " if prefix else ""

    def show(rows):
        for row in rows:
            print(f"{lead}{row[0]}", file=sys.stderr, flush=True)

    df.select(text).foreachPartition(show)


def record_lines(df: DataFrame, prefix: str = "output") -> DataFrame:
    """Every record as one JSON object in `line`, nulls included, after the prefix."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.concat(F.lit(f"{prefix}> "), record).alias("line"))


def print_records(df: DataFrame, prefix: str = "output") -> None:
    print_lines(record_lines(df, prefix))
