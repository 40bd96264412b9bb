"""Text, CSV and Parquet files in hourly directories, one set of files per batch.

    <output>/bucket=2020-05-10--18/batch=<writer>-42/part-...

A batch that runs again after a failure has the same name and the same bucket, so overwriting its directory leaves each
event in the output exactly once. The writer in the name keeps jobs that share an output apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.render import hour_bucket


def _writer(df: DataFrame, file_format: str):
    writer = df.write.mode("overwrite")
    return writer.option("compression", "snappy") if file_format == "parquet" else writer


def _folder(output: str, batch: str, bucket: str) -> str:
    return f"{output.rstrip('/')}/bucket={bucket}/batch={batch}"


def write_batch(df: DataFrame, output: str, batch: str, bucket: str, file_format: str = "text") -> None:
    """Write one batch, all of it in one hourly directory. Text output takes a single string column."""
    _writer(df, file_format).format(file_format).save(_folder(output, batch, bucket))


def written_batch(df: DataFrame, output: str, batch: str, bucket: str, file_format: str = "text") -> DataFrame:
    """What `write_batch` wrote of `df`, which is not computed again."""
    folder = _folder(output, batch, bucket)
    return df.sparkSession.read.schema(df.schema).option("basePath", folder).format(file_format).load(folder)


def write_bucketed(
    df: DataFrame, output: str, batch: str, bucket_time: Column, file_format: str = "text"
) -> None:
    """Write one batch whose rows choose their hourly directory by `bucket_time`, a time that belongs to the row."""
    rows = df.withColumns({"bucket": hour_bucket(bucket_time), "batch": F.lit(batch)})
    writer = _writer(rows, file_format).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket", "batch").format(file_format).save(output)
