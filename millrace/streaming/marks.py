"""Dedup across micro-batches: the greatest counter of every key seen so far, kept as a table.

Each batch adds its per-key maxima as a new folder, `<marks>/<batch>`; every `SNAPSHOT_EVERY`-th folder holds all keys
instead, after which older folders go. Folders are partitioned by a hash of the key, and a batch reads the partitions
that its own keys fall in. The marks enter the next batch as rows that come before all its events, so the batch operator
decides, and one hot key never has to fit one task. Folders of earlier batches are never changed, hence a batch that
runs again sees the same marks and gives the same result. A folder also counts the rows of its batch: per key, and per
reason for rows that cannot be used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import (
    COUNTER,
    DUPLICATE,
    OWN,
    REASON,
    ROWS,
    SPLIT_WIDTH,
    Keyed,
    ascends,
    with_previous_max,
)
from millrace.sources.events import hadoop_path

SNAPSHOT_EVERY = 20
_IS_MARK = OWN + "is_mark"
# Partitions of the marks, by key.
PARTITIONS, PART = 64, OWN + "part"


def part_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTITIONS)).cast("int")


def _folder(marks: str, batch_id: int) -> str:
    return f"{marks.rstrip('/')}/{batch_id}"


def marks_before(
    spark: SparkSession, marks: str, batch_id: int, snapshot_every: int = SNAPSHOT_EVERY
) -> DataFrame | None:
    """The marks of all batches before `batch_id`, with possibly several rows per key."""
    if batch_id == 0:
        return None
    newest_snapshot = (batch_id - 1) // snapshot_every * snapshot_every
    folders = [_folder(marks, b) for b in range(newest_snapshot, batch_id)]
    read = [spark.read.option("basePath", folder).parquet(folder) for folder in folders]
    return reduce(DataFrame.unionByName, read).where(F.col(REASON).isNull())


def forget_marks(spark: SparkSession, marks: str, batch_id: int, snapshot_every: int) -> None:
    """Delete the folders that neither this batch, run again, nor a later one will read."""
    if batch_id % snapshot_every:
        return
    needed = batch_id - snapshot_every
    for old in range(max(0, needed - snapshot_every), needed):
        files, target = hadoop_path(spark, _folder(marks, old))
        files.delete(target, True)


def write_marks(
    keyed: Keyed,
    earlier: DataFrame | None,
    marks: str,
    batch_id: int,
    snapshot_every: int = SNAPSHOT_EVERY,
) -> DataFrame:
    """Record the maxima of this batch, or of everything when a snapshot is due, and return them as written.

    Maxima and counts combine before the shuffle, so a hot key costs no more than another. Rows that cannot be used are
    counted under their reason, without a key.
    """
    usable = F.col(REASON).isNull()
    rows = keyed.rows.select(
        *[F.when(usable, F.col(k)).alias(k) for k in keyed.keys],
        F.when(usable, F.col(COUNTER)).alias(COUNTER), REASON, F.lit(1).alias(ROWS))
    if earlier is not None and batch_id % snapshot_every == 0:
        rows = rows.unionByName(earlier.select(*keyed.keys, COUNTER, REASON, F.lit(0).alias(ROWS)))
    greatest = rows.groupBy(*keyed.keys, REASON).agg(F.max(COUNTER).alias(COUNTER), F.sum(ROWS).alias(ROWS))
    placed = greatest.withColumn(PART, part_of(keyed.keys))
    placed.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(_folder(marks, batch_id))
    forget_marks(keyed.rows.sparkSession, marks, batch_id, snapshot_every)
    return keyed.rows.sparkSession.read.schema(placed.schema).parquet(_folder(marks, batch_id))


def counts(spark: SparkSession, marks: str, batch_id: int) -> dict[str | None, int]:
    """Rows of a batch by the reason why they cannot be used; those that can are under None."""
    schema = f"{REASON} string, {ROWS} bigint"
    written = spark.read.schema(schema).parquet(_folder(marks, batch_id))
    return {row[REASON]: row.n for row in written.groupBy(REASON).agg(F.sum(ROWS).alias("n")).collect()}


def compare_batch(
    keyed: Keyed,
    marks: str,
    batch_id: int,
    order_by: str | Sequence[str],
    split_width: int = SPLIT_WIDTH,
    snapshot_every: int | None = None,
) -> DataFrame:
    """The usable rows of a batch with the greatest counter before each, over this and the earlier batches.

    The marks of this batch are written at once; calling again for the same batch replaces them.
    """
    every = snapshot_every or SNAPSHOT_EVERY
    earlier = marks_before(keyed.rows.sparkSession, marks, batch_id, every)
    written = write_marks(keyed, earlier, marks, batch_id, every)
    rows = keyed.usable.withColumn(_IS_MARK, F.lit(False))
    if earlier is not None:
        # Only keys of this batch matter: the other partitions are not read, the other keys left out before the shuffle.
        present = written.where((F.col(ROWS) > 0) & F.col(REASON).isNull())
        parts = [row[PART] for row in present.select(PART).distinct().collect()]
        carried = earlier.where(F.col(PART).isin(parts)).join(present.select(*keyed.keys), list(keyed.keys), "left_semi")
        carried = carried.select(*keyed.keys, COUNTER, F.lit(True).alias(_IS_MARK))
        rows = rows.unionByName(carried, allowMissingColumns=True)
    return with_previous_max(rows, keyed.keys, order_by, split_width).where(~F.col(_IS_MARK))


def kept(keyed: Keyed, compared: DataFrame) -> DataFrame:
    return compared.where(ascends()).select(*keyed.payload_columns)


def judged(keyed: Keyed, compared: DataFrame) -> DataFrame:
    """All rows of a compared batch with the reason why they are rejected in `REASON`, null for those that are kept."""
    verdict = F.when(~ascends(), DUPLICATE).alias(REASON)
    return compared.select(*keyed.payload_columns, verdict).unionByName(keyed.unusable.select(*keyed.payload_columns, REASON))


def rejects(keyed: Keyed, compared: DataFrame) -> DataFrame:
    """The duplicates of a compared batch and its unusable rows, with the reason of each."""
    return judged(keyed, compared).where(F.col(REASON).isNotNull()).withColumnRenamed(REASON, "reason")
