"""Key and counter columns taken from a JSON document without a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPE = r"^(BIGINT|DECIMAL|DOUBLE)"
WIDE_INTEGER_TYPE = r"^DECIMAL\((19|2\d|3\d),0\)$"


# What JSON itself allows; Spark's reader is more lenient by default.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# The setting under which the last of several members with one name counts, instead of being an error.
REPEATED_NAMES = "spark.sql.variant.allowDuplicateKeys"
# A name that no member and no Avro field is given.
CORRUPT = "millrace:corrupt"


def members(text: Column, names: Sequence[str]) -> Column:
    """The named top-level members of a JSON object as variants, beside the text itself if it is not an object.

    A member that is absent is SQL NULL, one that is JSON null is a variant null. Other members are skipped unread.
    """
    fields = [T.StructField(name, T.VariantType()) for name in dict.fromkeys(names)]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **STRICT})


# Strings, numbers and what stands between them in a JSON text.
TOKENS = r'"(?:[^"\\]|\\.)*+"|-?[0-9][-+.0-9eE]*|[^"0-9-]+'


def canonical_key(value: Column, type_name: Column, text: Column, name: str) -> Column:
    """Text that is equal exactly when two JSON values are equal, whatever the order of object members.

    Integers and floating numbers never compare equal, so both are tagged. Strings keep their quotes and so cannot
    collide with a tag. In arrays and objects every leaf is tagged, before the members are put in order.
    """
    plain = F.to_json(value)
    return (
        F.when((type_name == "BIGINT") | type_name.rlike(WIDE_INTEGER_TYPE), F.concat(F.lit("i:"), plain))
        .when(
            type_name.rlike(NUMERIC_TYPE),
            F.concat(F.lit("f:"), F.try_variant_get(value, "$", "double").cast("string")),
        )
        .when(type_name.rlike("^(ARRAY|OBJECT)"), _tagged(text, name))
        .otherwise(plain)
    )


def _tagged(text: Column, name: str) -> Column:
    """The nested member `name`, its numbers written as tagged strings and its strings tagged, members in order.

    The member's own text is taken apart into tokens, as parsed values no longer tell `1` from `1.0` everywhere.
    """
    schema = T.StructType([T.StructField(name, T.StringType())])
    own = F.from_json(text, schema, {"mode": "PERMISSIVE", **STRICT}).getField(name)

    def tag(token: Column) -> Column:
        integer = F.when(token == "-0", "0").otherwise(token)
        return (
            F.when(token.startswith('"'), F.concat(F.lit('"s:'), F.substring(token, 2, 2147483647)))
            .when(token.rlike("^-?[0-9].*[.eE]"), F.concat(F.lit('"f:'), token.try_cast("double").cast("string"), F.lit('"')))
            .when(token.rlike("^-?[0-9]"), F.concat(F.lit('"i:'), integer, F.lit('"')))
            .otherwise(token)
        )

    tagged = F.array_join(F.transform(F.regexp_extract_all(own, F.lit(TOKENS), F.lit(0)), tag), "")
    return F.to_json(F.try_parse_json(tagged))


def counter_value(value: Column, type_name: Column) -> Column:
    """The counter as a bigint; NULL when it is not a number or does not fit. Fractions are cut off."""
    numeric = (type_name == "BIGINT") | type_name.rlike(NUMERIC_TYPE)
    return F.when(numeric, F.try_variant_get(value, "$", "bigint"))
