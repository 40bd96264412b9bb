"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """The name as one identifier, whatever dots or backticks it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def with_computed_once(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters may test without running their expressions again.

    A plain projection lets the optimizer push a filter below it by copying the expressions, which for JSON parsing
    means parsing once per condition. A generator over a one-element array is a step filters are not pushed through,
    costs no shuffle and stays inside whole-stage codegen.
    """
    holder = "__millrace_computed"
    packed = df.withColumn(holder, F.struct(*[value.alias(name) for name, value in fields.items()]))
    return packed.select(*[column(c) for c in df.columns], F.inline(F.array(F.col(holder))))
