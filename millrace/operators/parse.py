"""JSON lines to typed records against a schema the user supplies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.avro_schema import Decoder
from millrace.functions.columns import column, with_computed_once
from millrace.functions.json_keys import CORRUPT, STRICT


# Helper columns. Neither Avro nor Spark's own readers give such names, so no field can meet them.
WIRE, FITS = "millrace:wire", "millrace:fits"


def _checked(df: DataFrame, schema: Decoder, text: str) -> DataFrame:
    """Add the parsed record and whether the text fits the schema."""
    wire = T.StructType([*schema.wire_type.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **STRICT}
    record = F.col(WIRE)
    # The JSON reader reports wrong types but fills missing fields with NULL, so presence is checked as well.
    good = record.getField(CORRUPT).isNull() & schema.valid(record)
    return df.withColumn(WIRE, F.from_json(column(text), wire, options)).withColumn(FITS, F.coalesce(good, F.lit(False)))


def _refuse_clashes(schema: Decoder, keep: Sequence[str]) -> None:
    clash = [f.name for f in schema.data_type.fields if f.name in keep]
    if clash:
        raise ValueError(f"kept columns clash with record fields: {', '.join(clash)}")


def records_or_not(df: DataFrame, schema: Decoder, text: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """The `keep` columns, one column per schema field, and `FITS`; where that is false the fields are null.

    Each text is parsed once, whatever filters follow.
    """
    _refuse_clashes(schema, keep)
    checked = _checked(df, schema, text).select(*[column(c) for c in keep], WIRE, FITS)
    record = schema.decode(F.col(WIRE))
    fields = {f.name: F.when(F.col(FITS), record.getField(f.name)) for f in schema.data_type.fields}
    kept = "millrace:kept"
    computed = with_computed_once(checked, {**fields, kept: F.col(FITS)})
    return computed.drop(WIRE, FITS).withColumnRenamed(kept, FITS)


def parse_records(
    df: DataFrame,
    schema: Decoder,
    text: str = "line",
    on_error: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One column per schema field, after the `keep` columns. Members the schema does not name are ignored.

    `on_error="fail"` stops the job at the first bad line, `"drop"` leaves bad lines out.
    """
    if on_error not in ("fail", "drop"):
        raise ValueError(f"on_error must be 'fail' or 'drop', not {on_error!r}")
    if on_error == "drop":
        return records_or_not(df, schema, text, keep).where(F.col(FITS)).drop(FITS)
    _refuse_clashes(schema, keep)
    record = schema.decode(F.col(WIRE))
    message = F.concat(F.lit("cannot decode record: "), column(text))

    def field(name: str, data_type: T.DataType) -> Column:
        return F.when(F.col(FITS), record.getField(name)).otherwise(F.raise_error(message).cast(data_type))

    return _checked(df, schema, text).select(
        *[column(c) for c in keep], *[field(f.name, f.dataType).alias(f.name) for f in schema.data_type.fields])


def malformed_lines(df: DataFrame, schema: Decoder, text: str = "line") -> DataFrame:
    """The rows whose text does not fit the schema."""
    return _checked(df, schema, text).where(~F.col(FITS)).drop(WIRE, FITS)
