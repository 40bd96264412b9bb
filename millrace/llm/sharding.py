"""Shards of equal bytes by histogram sort."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, whole_text

#: Least number of buckets of a shard and rows that a bucket is to hold, probes of a splitter in each round, and how far
#: a splitter may be off, as a share of a bucket.
PARTS, BUCKET_ROWS, PROBES, TOLERANCE = 32, 1_000_000, 16, 0.002
LOWEST, KEYS = -(1 << 63), 1 << 63
#: A place in the order of rows: key, doc_id, number of the row.
Position = tuple[int, int, int]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the sort key of each row: 63 bits of the text's hash, then the doc_id (null lowest)."""
    text = whole_text()
    return docs.select(
        "doc_id", (F.coalesce(F.octet_length(F.col("text")), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("key"),
        F.coalesce("doc_id", F.lit(LOWEST)).cast("bigint").alias("tie"))


def _binned(keyed: DataFrame, probes: list[Position], *passed: str) -> DataFrame:
    """Number of probes that are not above each row, as `bin`; probes are sorted."""
    levels = [np.array([p[i] for p in probes], dtype=np.int64) for i in range(3)]

    def counted(columns, low: int, high: int, level: int) -> np.ndarray:
        """Of the probes from `low` to before `high`, which agree above this level, how many are not above each row."""
        at, values = levels[level][low:high], columns[level]
        if level == 2:
            return np.searchsorted(at, values, side="right")
        bins, meet = np.searchsorted(at, values, side="left"), np.isin(values, at)
        for value in np.unique(values[meet]):
            rows = values == value
            begin, end = low + np.searchsorted(at, value, "left"), low + np.searchsorted(at, value, "right")
            bins[rows] += counted([c[rows] for c in columns], begin, end, level + 1)
        return bins

    def each(batches):
        for batch in batches:
            columns = [np.asarray(batch.column(name)) for name in ("key", "tie", "number")]
            bins = counted(columns, 0, len(probes), 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(bins, pa.int32())], names=[*passed, "bin"])

    kinds = dict(keyed.dtypes)
    names = list(dict.fromkeys([*passed, "key", "tie", "number"]))
    return keyed.select(*names).mapInArrow(each, ", ".join([*(f"{c} {kinds[c]}" for c in passed), "bin int"]))


def _below(keyed: DataFrame, probes: list[Position]) -> dict[Position, int]:
    """Exact bytes below each probe: one aggregated number per bin comes to the driver."""
    found = {r["bin"]: r["bytes"] for r in _binned(keyed, probes, "size").groupBy("bin").agg(F.sum("size").alias("bytes")).collect()}
    total, out = 0, {}
    for i, probe in enumerate(probes):
        total += found.get(i, 0)
        out[probe] = total
    return out


def splitters(keyed: DataFrame, total: int, n: int) -> list[Position]:
    """n - 1 positions that cut the sorted rows into n parts of equal bytes, up to TOLERANCE.

    Each round counts the bytes below PROBES candidates for every open splitter, over all rows, and goes on between the
    two nearest. Where a single key reaches over the target, the search goes on among its doc_ids, and where one of
    these does, among the numbers of its rows. So a text that a third of all rows hold is split as well, even under a
    single doc_id.
    """
    slack = max(1.0, TOLERANCE * total / n)
    targets = [total * i // n for i in range(1, n)]
    low = [((0, LOWEST, 0), 0)] * len(targets)
    high = [((KEYS - 1, KEYS - 1, KEYS - 1), total)] * len(targets)
    chosen: list[Position | None] = [None] * len(targets)
    while None in chosen:
        probes = set()
        for i, found in enumerate(chosen):
            if found is None:
                probes.update(_between(low[i][0], high[i][0]))
        below = _below(keyed, sorted(probes)) if probes else {}
        points = sorted(below.items())
        for i, target in enumerate(targets):
            if chosen[i] is not None:
                continue
            inside = [p for p in points if low[i][0] < p[0] < high[i][0]]
            for probe in inside:
                if probe[1] <= target:
                    low[i] = max(low[i], probe)
                else:
                    high[i] = min(high[i], probe)
            near = min(low[i], high[i], key=lambda p: abs(p[1] - target))
            if abs(near[1] - target) <= slack or not _between(low[i][0], high[i][0]):
                chosen[i] = near[0]
    return sorted(chosen)


def _between(low: Position, high: Position) -> list[Position]:
    """Up to PROBES positions between two others: whole keys, then doc_ids once keys are next to each other, then numbers."""
    spread = lambda a, b: [a + (b - a) * i // (PROBES + 1) for i in range(1, PROBES + 1)]
    if high[0] - low[0] > 1:
        found = {(key, LOWEST, 0) for key in spread(low[0], high[0])}
    else:
        tie = high[1] if high[0] == low[0] else KEYS - 1
        if tie - low[1] > 1:
            found = {(low[0], t, 0) for t in spread(low[1], tie)}
        else:
            number = high[2] if high[:2] == low[:2] else KEYS - 1
            found = {(*low[:2], n) for n in spread(low[2], number)}
    return sorted(p for p in found if low < p < high)


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ("bytes"), shard, slot and grown_shard (null) of every document.

    Rows are sorted by text hash and doc_id; equal texts stand together and change shard only where a shard ends. Slots
    number the rows of a shard in that order without gaps. A null text counts one byte, like an empty one; rows that
    agree in text and doc_id stand in the order in which their keys were written, and are split like any others; an empty
    table gives an empty result.
    """
    keyed = materialise(_keyed(docs).withColumn("number", F.monotonically_increasing_id()), "shard-keys")
    whole = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).head()
    parts = max(PARTS, math.ceil(whole["rows"] / (shards * BUCKET_ROWS)))
    cuts = splitters(keyed, whole["bytes"], shards * parts) if whole["rows"] else []
    placed = _binned(keyed, cuts, "doc_id", "size", "text_crc32", "key", "tie", "number").withColumnRenamed("bin", "bucket")
    counts = {r["bucket"]: r["count"] for r in placed.groupBy("bucket").count().collect()}
    starts, before = [], 0
    for bucket in range(shards * parts):
        before = 0 if bucket % parts == 0 else before
        starts.append((bucket, before))
        before += counts.get(bucket, 0)
    # One row per bucket.
    offsets = docs.sparkSession.createDataFrame(starts, "bucket int, start bigint")
    order = Window.partitionBy("bucket").orderBy("key", "tie", "number")
    return placed.withColumn("rank", F.row_number().over(order)).join(F.broadcast(offsets), "bucket").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.expr(f"cast(bucket div {parts} as int)").alias("shard"), (F.col("start") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
