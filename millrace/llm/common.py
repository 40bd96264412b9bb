"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_folder

#: What ends a word, here and in the contracts of the queries: space and the ASCII controls 9 to 13.
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(frame: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: the lineage ends there, and no executor holds the only copy."""
    folder = scratch_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def whole_text(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def by_batch(frame: DataFrame, schema: str, work: Callable[[list], dict[str, list]], *passed: str, text: str = "text") -> DataFrame:
    """Run `work` on the texts of each Arrow batch; columns named in `passed` go through untouched.

    `work` gets the texts of a batch (null as empty) and returns the new columns of `schema` as lists. The rows of one
    batch are all that a task holds.
    """
    kept = frame.select(*passed, whole_text(text).alias("_text"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    out = f"{out}, {schema}" if out else schema
    types = [(part.split()[0], part.split()[1]) for part in schema.split(", ")]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
             "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            new = work(batch.column(batch.num_columns - 1).to_pylist())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(new[name], type=arrow[kind]) for name, kind in types]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *(n for n, _ in types)])

    return kept.mapInArrow(each, out)


def rows_by_batch(frame: DataFrame, schema: str, work: Callable[[Iterator[tuple]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Run `work` over an iterator of record batches; it yields batches of `schema`."""
    return frame.mapInArrow(work, schema)


def packed(docs: DataFrame) -> DataFrame:
    """All columns of each document in one struct `row`, so that no helper column can meet a name of the input."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(frame: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `row` again, some of them replaced."""
    fields = frame.schema["row"].dataType.fields
    return frame.select(*[
        (changed[f.name].cast(f.dataType) if f.name in changed else F.col(f"row.`{f.name}`")).alias(f.name) for f in fields
    ])


def crc32_mod(column: str, n: int) -> Column:
    """crc32 of a value as text, modulo n: the fold that decides which labelled rows are held out."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))
