"""Text forms of events: CSV lines, JSON lines, timestamps, UTF-8 payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import column


def utf8_text(payload: Column) -> Column:
    """Bytes as text; each invalid sequence becomes U+FFFD."""
    return F.make_valid_utf8(payload.cast("string"))


def utf8_bytes(text: Column) -> Column:
    return text.cast("binary")


def constant_payload(size: int) -> Column:
    return F.lit("x" * size)


def timestamp_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.f` in the session time zone, with at least one digit of fraction."""
    text = ts.cast("string")
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def hour_bucket(ts: Column) -> Column:
    """The hourly output directory, `yyyy-MM-dd--HH`."""
    return F.date_format(ts, "yyyy-MM-dd--HH")


def quoted_text(text: Column) -> Column:
    """Text in quotes as Avro prints it: JSON escapes, and those of C1 controls and U+2000 to U+20FF besides."""
    escaped = F.to_json(F.array(text))
    escaped = F.substring(escaped, F.lit(2), F.length(escaped) - 2)
    rare = "[\\x7F-\\x9F\\u2000-\\u20FF]"
    letters = F.transform(F.split(escaped, ""), lambda c: F.when(
        c.rlike(rare), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c)), 4, "0"))).otherwise(c))
    return F.when(escaped.rlike(rare), F.array_join(letters, "")).otherwise(escaped)


def _union_members(data_type: T.DataType) -> list[T.StructField]:
    """The branches of a union struct (see `avro_schema`); none for other types."""
    fields = data_type.fields if isinstance(data_type, T.StructType) else []
    return fields if [f.name for f in fields] == [f"member{i}" for i in range(len(fields))] else []


def nested_text(value: Column, data_type: T.DataType) -> Column:
    """A value inside another one in Avro's text form: records and maps in braces, texts and bytes in quotes."""
    if isinstance(data_type, T.ArrayType):
        items = F.transform(value, lambda v: nested_text(v, data_type.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(data_type, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.concat(
            quoted_text(e.getField("key")), F.lit(": "), nested_text(e.getField("value"), data_type.valueType)))
        text = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    elif members := _union_members(data_type):
        text = F.coalesce(*[
            F.when(value.getField(m.name).isNotNull(), nested_text(value.getField(m.name), m.dataType)) for m in members])
    elif isinstance(data_type, T.StructType):
        parts = [F.concat(quoted_text(F.lit(f.name)), F.lit(": "), nested_text(value.getField(f.name), f.dataType))
                 for f in data_type.fields]
        text = F.concat(F.lit("{"), *[p for part in parts for p in (F.lit(", "), part)][1:], F.lit("}"))
    elif isinstance(data_type, T.BinaryType):
        text = quoted_text(F.decode(value, "ISO-8859-1"))
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        plain = value.cast("string")
        text = F.when(plain.isin("NaN", "Infinity", "-Infinity"), F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(plain)
    elif isinstance(data_type, (T.BooleanType, T.IntegralType, T.DecimalType)):
        text = value.cast("string")
    else:
        text = quoted_text(value.cast("string"))
    return F.when(value.isNull(), "null").otherwise(text)


def csv_text(value: Column, data_type: T.DataType) -> Column:
    """A field's own text, null if it is null: plain for single values and arrays of them, Avro's text form for others."""
    if isinstance(data_type, T.MapType):
        return F.to_json(value)
    if members := _union_members(data_type):
        return F.coalesce(*[csv_text(value.getField(m.name), m.dataType) for m in members])
    if isinstance(data_type, T.BinaryType):
        return F.decode(value, "ISO-8859-1")
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    if isinstance(data_type, T.StructType) or isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, nested):
        return F.when(value.isNotNull(), nested_text(value, data_type))
    return value.cast("string")


def csv_field(name: str, data_type: T.DataType, quote: bool = False) -> Column:
    text = csv_text(column(name), data_type)
    if not quote:
        return text
    escaped = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), escaped).otherwise(text)


def csv_line(df: DataFrame, null_value: str | None = None, quote: bool = False) -> Column:
    """All columns joined by commas, without header; unquoted unless `quote` is set.

    A null field raises an error unless `null_value` says what to write for it.
    """
    fields = []
    for field in df.schema.fields:
        text = csv_field(field.name, field.dataType, quote)
        if null_value is not None:
            text = F.coalesce(text, F.lit(null_value))
        elif field.nullable:
            message = f"field {field.name!r} is null and no null_value is set"
            text = F.coalesce(text, F.raise_error(F.lit(message)).cast("string"))
        fields.append(text)
    # concat_ws would be shorter but silently leaves out nulls.
    separated = [part for text in fields for part in (F.lit(","), text)][1:]
    return F.concat(*separated)


def json_line(df: DataFrame, *names: str) -> Column:
    """The named columns (all by default) as one JSON object in that order; timestamps become epoch milliseconds."""
    chosen = names or tuple(df.columns)
    members = []
    for name in chosen:
        value = column(name)
        if isinstance(df.schema[name].dataType, T.TimestampType):
            value = F.unix_millis(value)
        members.append(value.alias(name))
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})
