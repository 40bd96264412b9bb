"""Dedup inside a streaming query, with one long per key in Spark's state store.

For low-latency queries over sources that deliver each key in order from one micro-batch to the next. Within a
micro-batch rows may come in any order. The rows of a key are taken batch by batch: a few are held and sorted in memory;
of a key that has more, the rest waits in the state store, dealt into buckets of the order column, and is then read back
one bucket after the other. So a task holds one bucket of one key, whatever share of the rows that key has.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.columns import column
from millrace.operators.dedup import COUNTER, SPLIT_WIDTH, Keyed, order_columns

LOWEST = np.iinfo(np.int64).min
# Rows of a key held in memory before they are put aside, and the widest bucket they are dealt into.
HELD_ROWS, WIDEST = 20_000, 100_000


class GreatestCounter(StatefulProcessor):
    def __init__(self, columns: Sequence[str], order: Sequence[str], payload: Sequence[str], width: int, held_rows: int):
        # Spark hands the columns over by position, under names of its own.
        self.columns = list(columns)
        self.order = list(order)
        self.payload = list(payload)
        self.width = width
        self.held_rows = held_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        long, binary = T.LongType(), T.BinaryType()
        self.greatest = handle.getValueState("greatest", T.StructType([T.StructField("greatest", long)]))
        # Empty between micro-batches.
        self.waiting = handle.getMapState(
            "waiting", T.StructType([T.StructField("bucket", long), T.StructField("part", long)]),
            T.StructType([T.StructField("rows", binary)]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, n, parts = [], 0, Counter()
        for frame in rows:
            held.append(frame.set_axis(self.columns, axis="columns"))
            n += len(frame)
            if n > self.held_rows:
                self._put_aside(pd.concat(held, ignore_index=True), parts)
                held, n = [], 0
        if not parts:
            yield self._risen(pd.concat(held, ignore_index=True))
            return
        if held:
            self._put_aside(pd.concat(held, ignore_index=True), parts)
        for bucket in sorted(parts):
            places = [(bucket, part) for part in range(parts[bucket])]
            yield self._risen(pd.concat([_unpacked(self.waiting.getValue(place)[0]) for place in places], ignore_index=True))
            for place in places:
                self.waiting.removeKey(place)

    def _put_aside(self, rows: pd.DataFrame, parts: Counter) -> None:
        """Rows to the state store, each to the bucket of its first order column."""
        buckets = rows[self.order[0]] // self.width
        for bucket, part in rows[[COUNTER, *self.order, *self.payload]].groupby(buckets, dropna=False):
            # Rows without a position come first.
            place = LOWEST if pd.isna(bucket) else int(bucket)
            self.waiting.updateValue((place, parts[place]), (_packed(part),))
            parts[place] += 1

    def _risen(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Those of the rows, all later than the ones before, whose counter rises."""
        rows = rows.sort_values(self.order, kind="stable", na_position="first")
        counters = rows[COUNTER].to_numpy(dtype=np.int64)
        known = self.greatest.exists()
        start = np.int64(self.greatest.get()[0]) if known else LOWEST
        # Plain int64 throughout: pandas' own running maximum goes through doubles.
        running = np.maximum.accumulate(np.maximum(counters, start))
        keep = counters > np.concatenate(([start], running[:-1]))
        if not known:
            keep[0] = True
        self.greatest.update((int(running[-1]),))
        return rows.loc[keep, self.payload]

    def close(self) -> None:
        pass


def _packed(rows: pd.DataFrame) -> bytes:
    batch, out = pa.RecordBatch.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_pandas()


def keep_ascending_stateful(
    keyed: Keyed, order_by: str | Sequence[str], split_width: int | None = SPLIT_WIDTH
) -> DataFrame:
    """The rows of a streaming DataFrame whose counter rises for their key.

    Buckets are `split_width` wide, WIDEST at the most. Values cross to pandas as text, because a pandas column with nulls turns integers into doubles.
    """
    order = order_columns(keyed.rows, order_by)
    fields = [keyed.rows.schema[name] for name in keyed.payload]
    nested = [f.name for f in fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    if nested:
        raise ValueError(f"nested columns {nested}: deduplicate the text before parsing, or use streaming.marks")

    def position(name: str):
        is_time = isinstance(keyed.rows.schema[name].dataType, T.TimestampType)
        return F.unix_micros(column(name)) if is_time else column(name)

    def packed_value(field: T.StructField):
        # Instants go as microseconds: as text they would need a zone.
        value = F.unix_micros(column(field.name)) if isinstance(field.dataType, T.TimestampType) else column(field.name)
        return value.cast("string") if not isinstance(field.dataType, T.BinaryType) else value

    def restored(name: str, field: T.StructField):
        if isinstance(field.dataType, T.TimestampType):
            return F.timestamp_micros(F.col(name).cast("bigint")).alias(field.name)
        return F.col(name).cast(field.dataType).alias(field.name)

    packed_types = [f.dataType if isinstance(f.dataType, T.BinaryType) else T.StringType() for f in fields]
    rows = keyed.usable.select(
        *[column(k) for k in keyed.keys],
        COUNTER,
        *[position(name).alias(f"_order{i}") for i, name in enumerate(order)],
        *[packed_value(f).alias(f"_field{i}") for i, f in enumerate(fields)],
    )
    packed = [f"_field{i}" for i in range(len(fields))]
    kept = rows.groupBy(*[column(k) for k in keyed.keys]).transformWithStateInPandas(
        statefulProcessor=GreatestCounter(
            rows.columns, [f"_order{i}" for i in range(len(order))], packed, min(split_width or WIDEST, WIDEST), HELD_ROWS),
        outputStructType=T.StructType([T.StructField(n, t) for n, t in zip(packed, packed_types)]),
        outputMode="Append",
        timeMode="None",
    )
    return kept.select(*[restored(n, f) for n, f in zip(packed, fields)])
