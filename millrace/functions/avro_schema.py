"""Avro record schemas as Spark types, with the rules for reading their JSON encoding.

Text-like fields are read as variants first: the JSON reader would otherwise accept a number where the schema says
string. A union is written as null or as an object with one member named after the branch. `["null", T]` becomes T; any
other union becomes a struct with one field for each branch, `member0` and so on as Spark's own Avro reader names them, of
which all but one are null. A decimal is written as the bytes of its unscaled value, as text.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}
TEXT = r"(?s)^[\x00-\xFF]*$"


@dataclass(frozen=True)
class Decoder:
    """How a schema node looks in Spark (`data_type`) and on the wire, and how to check and convert it."""

    data_type: T.DataType
    wire_type: T.DataType
    valid: Callable[[Column], Column]
    decode: Callable[[Column], Column]
    nullable: bool = False
    # True when decode changes nothing, so that containers need no element-wise work.
    plain: bool = False
    branch: str = ""


def _same(value: Column) -> Column:
    return value


def _present(value: Column) -> Column:
    return value.isNotNull()


def _primitive(name: str, data_type: T.DataType) -> Decoder:
    return Decoder(data_type, data_type, _present, _same, plain=True, branch=name)


def _converted(name: str, wire_type: T.DataType, data_type: T.DataType, decode) -> Decoder:
    return Decoder(data_type, wire_type, _present, decode, branch=name)


def _text(name: str, data_type: T.DataType, check=None, convert=_same) -> Decoder:
    def decode(value: Column) -> Column:
        return convert(F.try_variant_get(value, "$", "string"))

    def valid(value: Column) -> Column:
        is_text = F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))
        return is_text if check is None else is_text & check(F.try_variant_get(value, "$", "string"))

    return Decoder(data_type, T.VariantType(), valid, decode, branch=name)


def _array(item: Decoder) -> Decoder:
    if item.plain:
        def valid(value: Column) -> Column:
            return value.isNotNull() & (F.size(F.array_compact(value)) == F.size(value))
    else:
        def valid(value: Column) -> Column:
            return value.isNotNull() & F.coalesce(F.forall(value, item.valid), F.lit(False))

    def decode(value: Column) -> Column:
        return value if item.plain else F.transform(value, item.decode)

    return Decoder(
        T.ArrayType(item.data_type, item.nullable), T.ArrayType(item.wire_type), valid, decode, branch="array",
        plain=item.plain,
    )


def _map(value_type: Decoder) -> Decoder:
    def valid(value: Column) -> Column:
        return value.isNotNull() & F.coalesce(F.forall(F.map_values(value), value_type.valid), F.lit(False))

    def decode(value: Column) -> Column:
        return value if value_type.plain else F.transform_values(value, lambda _, v: value_type.decode(v))

    return Decoder(
        T.MapType(T.StringType(), value_type.data_type, value_type.nullable),
        T.MapType(T.StringType(), value_type.wire_type), valid, decode, branch="map", plain=value_type.plain,
    )


def _record(name: str, fields: list[tuple[str, Decoder]]) -> Decoder:
    def valid(value: Column) -> Column:
        good = value.isNotNull()
        for field, decoder in fields:
            good = good & decoder.valid(value.getField(field))
        return good

    def decode(value: Column) -> Column:
        return F.struct(*[d.decode(value.getField(f)).alias(f) for f, d in fields])

    return Decoder(
        T.StructType([T.StructField(f, d.data_type, True) for f, d in fields]),
        T.StructType([T.StructField(f, d.wire_type, True) for f, d in fields]),
        valid, decode, branch=name, plain=all(d.plain for _, d in fields),
    )


def _optional(inner: Decoder) -> Decoder:
    def valid(value: Column) -> Column:
        return value.isNull() | inner.valid(value.getField(inner.branch))

    def decode(value: Column) -> Column:
        return F.when(value.isNotNull(), inner.decode(value.getField(inner.branch)))

    return Decoder(
        inner.data_type, T.StructType([T.StructField(inner.branch, inner.wire_type, True)]), valid, decode,
        nullable=True,
    )


def _union(branches: list[Decoder], optional: bool) -> Decoder:
    """A value of one of several branches, beside null if `optional`; it fits if exactly one branch is there and fits."""
    names = [b.branch for b in branches]
    if len({*names}) < len(names):
        raise ValueError(f"a union repeats a branch: {', '.join(names)}")

    def valid(value: Column) -> Column:
        there = [value.getField(n).isNotNull() for n in names]
        fit = [t & b.valid(value.getField(b.branch)) for t, b in zip(there, branches)]
        one = sum((F.coalesce(t, F.lit(False)).cast("int") for t in there), F.lit(0)) == 1
        any_fits = F.lit(False)
        for f in fit:
            any_fits = any_fits | F.coalesce(f, F.lit(False))
        return (value.isNull() & F.lit(optional)) | (value.isNotNull() & one & any_fits)

    def decode(value: Column) -> Column:
        # A branch that is not there stays null, whatever its own decoding makes of null.
        parts = [F.when(value.getField(b.branch).isNotNull(), b.decode(value.getField(b.branch))) for b in branches]
        return F.when(value.isNotNull(), F.struct(*[p.alias(f"member{i}") for i, p in enumerate(parts)]))

    return Decoder(
        T.StructType([T.StructField(f"member{i}", b.data_type, True) for i, b in enumerate(branches)]),
        T.StructType([T.StructField(b.branch, b.wire_type, True) for b in branches]), valid, decode, nullable=optional,
    )


HEX, INVERTED = "0123456789ABCDEF", "FEDCBA9876543210"


def _bound(value: Column, work: Callable[[Column], Column]) -> Column:
    """`work` on a value that is computed once, however often `work` names it."""
    return F.element_at(F.transform(F.array(value), work), 1)


def unscaled_text(payload: Column) -> Column:
    """Bytes of a two's-complement big-endian number as decimal digits with a sign; null beyond 38 digits and for no bytes.

    Bytes that only repeat the sign are cut off; what is left must fit 16 bytes, which are read as two unsigned halves.
    """
    def spelled(digits: Column) -> Column:
        negative = digits.rlike("^[89A-F]")
        # A negative number is the complement of its magnitude less one.
        plain = F.when(negative, F.translate(F.lpad(digits, 32, "F"), HEX, INVERTED)).otherwise(F.lpad(digits, 32, "0"))
        half = lambda text, begin: F.conv(F.substring(text, begin, 16), 16, 10).cast("decimal(20,0)")
        magnitude = _bound(plain, lambda text: F.try_add(
            F.try_multiply(half(text, 1), F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(38,0)"), half(text, 17)))
        magnitude = F.try_add(magnitude, F.when(negative, 1).otherwise(0).cast("decimal(1,0)")).cast("string")
        fits = (F.length(digits) > 0) & (F.length(digits) <= 32)
        return F.when(fits, F.concat(F.when(negative, "-").otherwise(""), magnitude))

    return _bound(F.regexp_replace(F.hex(payload), "^(?:(?:00)+(?=[0-7][0-9A-F])|(?:FF)+(?=[89A-F][0-9A-F]))", ""), spelled)


def _decimal(inner: Decoder, precision: int, scale: int) -> Decoder:
    """Bytes or fixed that hold an unscaled number; more digits than `precision` do not fit."""
    if not 0 < precision <= 38 or not 0 <= scale <= precision:
        raise ValueError(f"decimal({precision}, {scale}) is not supported: up to 38 digits, of which scale are decimals")
    data_type = T.DecimalType(precision, scale)

    def placed(text: Column) -> Column:
        sign, digits = F.regexp_extract(text, "^-?", 0), F.regexp_extract(text, "[0-9]+$", 0)
        if scale:
            digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), F.lit("0"))
            digits = _bound(digits, lambda d: F.concat(
                F.substring(d, F.lit(1), F.length(d) - scale), F.lit("."), F.right(d, F.lit(scale))))
        return F.concat(sign, digits).try_cast(data_type)

    def decode(value: Column) -> Column:
        return _bound(unscaled_text(inner.decode(value)), placed)

    def valid(value: Column) -> Column:
        return inner.valid(value) & decode(value).isNotNull()

    return Decoder(data_type, inner.wire_type, valid, decode, branch=inner.branch)


def _logical(schema: dict) -> Decoder | None:
    kind = (schema.get("type"), schema.get("logicalType"))
    if kind == ("long", "timestamp-millis"):
        return _converted("long", T.LongType(), T.TimestampType(), F.timestamp_millis)
    if kind == ("long", "timestamp-micros"):
        return _converted("long", T.LongType(), T.TimestampType(), F.timestamp_micros)
    if kind == ("int", "date"):
        return _converted("int", T.IntegerType(), T.DateType(), F.date_from_unix_date)
    return None


def _with_decimal(schema: dict, decoder: Decoder) -> Decoder:
    """The decoder of bytes or fixed, or of the decimal that they hold."""
    if schema.get("logicalType") != "decimal" or "precision" not in schema:
        return decoder  # without a precision the logical type is not valid, and Avro goes by the type beneath
    return _decimal(decoder, int(schema["precision"]), int(schema.get("scale", 0)))


def _decoder(schema, named: dict[str, Decoder], namespace: str) -> Decoder:
    if isinstance(schema, str):
        if schema in PRIMITIVES:
            return _primitive(schema, PRIMITIVES[schema])
        if schema == "string":
            return _text("string", T.StringType())
        if schema == "bytes":
            return _text("bytes", T.BinaryType(), lambda s: s.rlike(TEXT), lambda s: F.encode(s, "ISO-8859-1"))
        for full_name in (schema, f"{namespace}.{schema}"):
            if full_name in named:
                return named[full_name]
        raise ValueError(f"unknown Avro type {schema!r}")
    if isinstance(schema, list):
        others = [branch for branch in schema if branch != "null"]
        if not others:
            raise ValueError(f"a union needs a type beside null, not {json.dumps(schema)}")
        decoders = [_decoder(branch, named, namespace) for branch in others]
        optional = len(others) < len(schema)
        return _optional(decoders[0]) if optional and len(others) == 1 else _union(decoders, optional)

    logical = _logical(schema)
    if logical is not None:
        return logical
    kind = schema["type"]
    if kind == "array":
        return _array(_decoder(schema["items"], named, namespace))
    if kind == "map":
        return _map(_decoder(schema["values"], named, namespace))
    if kind == "bytes":
        return _with_decimal(schema, _decoder(kind, named, namespace))
    if kind not in ("record", "enum", "fixed"):
        return _decoder(kind, named, namespace)

    name = schema["name"]
    namespace = schema.get("namespace", namespace)
    full_name = name if "." in name or not namespace else f"{namespace}.{name}"
    if kind == "record":
        fields = [(f["name"], _decoder(f["type"], named, namespace)) for f in schema["fields"]]
        decoder = _record(full_name, fields)
    elif kind == "enum":
        symbols = list(schema["symbols"])
        decoder = _text(full_name, T.StringType(), lambda s: s.isin(symbols))
    else:
        size = int(schema["size"])
        decoder = _text(
            full_name, T.BinaryType(), lambda s: s.rlike(TEXT) & (F.length(s) == size),
            lambda s: F.encode(s, "ISO-8859-1"),
        )
        decoder = _with_decimal(schema, decoder)
    named[full_name] = decoder
    return decoder


def parse_avro_schema(text: str) -> Decoder:
    """The decoder of a record schema in Avro's JSON form; `.data_type` is its StructType."""
    if not text or not text.strip():
        raise ValueError("an Avro schema is required")
    decoder = _decoder(json.loads(text), {}, "")
    if not isinstance(decoder.data_type, T.StructType) or decoder.nullable or not decoder.branch:
        raise ValueError("the Avro schema must be a record")
    return decoder
