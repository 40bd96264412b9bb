"""Parallel arrays to rows: element i of every array field, beside the other fields repeated."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import column


def array_fields(schema: T.StructType, keep: Sequence[str] = ()) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType) and f.name not in keep]


def flatten_schema(schema: T.StructType, keep: Sequence[str] = ()) -> T.StructType:
    """The schema after flattening: each top-level array becomes its element type."""
    arrays = set(array_fields(schema, keep))
    return T.StructType([
        T.StructField(f.name, f.dataType.elementType, True) if f.name in arrays else f for f in schema.fields
    ])


def flatten(df: DataFrame, on_mismatch: str = "fail", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the first array field; all array fields advance together.

    An empty or null first array gives no rows. Arrays of different lengths stop the job, or with
    `on_mismatch="drop"` leave the record out. Arrays named in `keep` are treated as ordinary fields.
    """
    if on_mismatch not in ("fail", "drop"):
        raise ValueError(f"on_mismatch must be 'fail' or 'drop', not {on_mismatch!r}")
    arrays = array_fields(df.schema, keep)
    if not arrays:
        raise ValueError("flatten needs at least one array field")
    primary = F.size(column(arrays[0]))
    # A struct per element, built by position so that any field name works.
    zipped = F.arrays_zip(*[column(name).alias(f"a{i}") for i, name in enumerate(arrays)])
    same_size = reduce(lambda a, b: a & b, [F.size(column(a)).eqNullSafe(primary) for a in arrays[1:]], F.lit(True))
    element = T.StructType([
        T.StructField(f"a{i}", df.schema[name].dataType.elementType, True) for i, name in enumerate(arrays)
    ])
    guarded = F.when(column(arrays[0]).isNull(), F.lit(None)).when(same_size, zipped.cast(T.ArrayType(element)))
    if on_mismatch == "fail":
        message = F.lit(f"array fields differ in length: {', '.join(arrays)}")
        guarded = guarded.otherwise(F.raise_error(message).cast(T.ArrayType(element)))
    scalars = [column(c) for c in df.columns if c not in arrays]
    rows = df.select(*scalars, F.inline(guarded).alias(*[f"__millrace_element{i}" for i in range(len(arrays))]))
    return rows.select(*[
        F.col(f"__millrace_element{arrays.index(c)}").alias(c) if c in arrays else column(c) for c in df.columns
    ])
