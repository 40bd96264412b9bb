"""Duplicate removal by ascending counter.

A row is kept when its counter is greater than every earlier counter of the same key. Rejected rows never raise that
maximum, so one running maximum over all earlier valid rows decides, and the rule becomes a window function.

One key may hold a large part of all rows, and a plain window would sort all of them in one task. Every key is therefore
cut into buckets along the order column. Rows are read once and dealt once, by key and bucket. Both the maxima of the
buckets and the comparison within them read what was dealt: the maxima are carried forward to the later buckets of their
key and joined back on the same key and bucket. There is no list of hot keys: a key that is rare has few buckets, and what
is carried is one narrow row for each bucket after a key's first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import json_keys
from millrace.functions.columns import column, quoted, with_computed_once
from millrace.functions.render import utf8_text

# Names that start like this belong to the operators; a table that has one is refused.
OWN = "__millrace_"
COUNTER = OWN + "counter"
REASON = OWN + "reason"
BUCKET = OWN + "bucket"
PREVIOUS = OWN + "previous"
ROWS = OWN + "rows"
INSIDE, GREATEST, CARRIED = OWN + "inside", OWN + "greatest", OWN + "carried"
ROW = OWN + "row"
MEMBERS, TYPES, VALUE, TEXT, KEY = OWN + "members", OWN + "types", OWN + "value", OWN + "text", OWN + "key"

BAD_JSON = "bad json"
MISSING_KEY = "missing key"
MISSING_COUNTER = "missing counter"
BAD_COUNTER = "bad counter"
DUPLICATE = "duplicate"
MISFIT = "does not fit the schema"

# Length of a bucket in units of the first order column. With a unique integer column no bucket can hold more rows of a
# key; where many rows share a value (timestamps: one second at this width) it holds all rows of a key in that stretch.
SPLIT_WIDTH = 1_000_000

EARLIER = (Window.unboundedPreceding, -1)
LOWEST = "bigint('-9223372036854775808')"


@dataclass(frozen=True)
class Keyed:
    """Rows with key columns, a bigint counter, and the reason why a row cannot be used (NULL for usable rows)."""

    rows: DataFrame
    keys: tuple[str, ...]
    payload: tuple[str, ...]

    @property
    def usable(self) -> DataFrame:
        return self.rows.where(F.col(REASON).isNull())

    @property
    def unusable(self) -> DataFrame:
        return self.rows.where(F.col(REASON).isNotNull())

    @property
    def payload_columns(self) -> list[Column]:
        return [column(name) for name in self.payload]


def field_names(names: str | Sequence[str]) -> list[str]:
    """Field names from a comma-separated option or a list; blanks are left out."""
    parts = names.split(",") if isinstance(names, str) else names
    return [part.strip() for part in parts if part.strip()]


def refuse_own_names(df: DataFrame) -> None:
    taken = [name for name in df.columns if name.lower().startswith(OWN)]
    if taken:
        raise ValueError(f"names that start with {OWN!r} are reserved: {', '.join(taken)}")


def dedup_enabled(keys: str | Sequence[str], counter: str) -> bool:
    return bool(field_names(keys)) and bool(counter.strip())


def key_json(df: DataFrame, keys: str | Sequence[str], counter: str, text: str = "line") -> Keyed:
    """Key and counter columns read from top-level members of a JSON text column.

    Of members with one name the last counts, at any depth; Spark's reader of JSON values asks for a setting to do so.
    """
    df.sparkSession.conf.set(json_keys.REPEATED_NAMES, "true")
    names, counter = field_names(keys), counter.strip()
    refuse_own_names(df.drop(TEXT))
    wanted = json_keys.members(column(text), [*names, counter])
    parsed = df.withColumn(MEMBERS, wanted)
    member = {name: F.col(MEMBERS).getField(name) for name in [*names, counter]}
    # By position, as names of struct fields would have to be quoted again.
    types = {name: F.schema_of_variant(value) for name, value in member.items()}
    parsed = parsed.withColumn(TYPES, F.array(*types.values()))
    type_of = {name: F.col(TYPES)[i] for i, name in enumerate(types)}
    parsed = parsed.withColumn(VALUE, json_keys.counter_value(member[counter], type_of[counter]))

    key_columns = {f"{KEY}{i}": json_keys.canonical_key(member[n], type_of[n], column(text), n) for i, n in enumerate(names)}
    missing_key = F.lit(False)
    for name in names:
        missing_key = missing_key | member[name].isNull()
    reason = (
        F.when(F.col(MEMBERS).isNull() | F.col(MEMBERS).getField(json_keys.CORRUPT).isNotNull(), BAD_JSON)
        .when(missing_key, MISSING_KEY)
        .when(member[counter].isNull(), MISSING_COUNTER)
        .when(F.col(VALUE).isNull(), BAD_COUNTER)
    )
    computed = with_computed_once(parsed, {**key_columns, COUNTER: F.col(VALUE), REASON: reason})
    return Keyed(computed.drop(MEMBERS, TYPES, VALUE), tuple(key_columns), tuple(df.columns))


def key_records(df: DataFrame, keys: str | Sequence[str], counter: str, misfit: str | None = None) -> Keyed:
    """Key and counter columns of typed records; the counter must be an integer column.

    `misfit` names a boolean column that is true for rows that are no records at all; it is not part of the payload.
    """
    names = field_names(keys)
    counter = counter.strip()
    payload = [c for c in df.columns if c != misfit]
    refuse_own_names(df.select(*[column(c) for c in payload]))
    absent = [name for name in [*names, counter] if name not in df.columns]
    if absent:
        raise ValueError(f"no such field: {', '.join(absent)}")
    counter_type = df.schema[counter].dataType
    if not isinstance(counter_type, (T.LongType, T.IntegerType)):
        raise ValueError(f"counter {counter!r} must be int or long, not {counter_type.simpleString()}")
    key_columns = {f"{KEY}{i}": _comparable(column(name), df.schema[name].dataType) for i, name in enumerate(names)}
    missing_key = F.lit(False)
    for name in names:
        missing_key = missing_key | column(name).isNull()
    reason = F.when(F.col(misfit) if misfit else F.lit(False), MISFIT).when(missing_key, MISSING_KEY).when(
        column(counter).isNull(), MISSING_COUNTER)
    rows = df.withColumns({**key_columns, COUNTER: column(counter).cast("bigint"), REASON: reason})
    return Keyed(rows.drop(misfit) if misfit else rows, tuple(key_columns), tuple(payload))


def _comparable(value: Column, data_type: T.DataType) -> Column:
    """The value in a form that groups, hashes and compares alike; maps, for one, cannot be grouped at all."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value.cast("string")
    if isinstance(data_type, T.MapType):
        value = F.array_sort(F.map_entries(value))
    if isinstance(data_type, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return value


def order_columns(df: DataFrame, order_by: str | Sequence[str]) -> list[str]:
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    if not names:
        raise ValueError("order_by is required: without an order the first of two duplicates is not defined")
    if not isinstance(df.schema[names[0]].dataType, (T.IntegralType, T.TimestampType)):
        raise ValueError(f"the first order column {names[0]!r} must be an integer or a timestamp")
    return names


def with_previous_max(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: str | Sequence[str],
    split_width: int | None = SPLIT_WIDTH,
) -> DataFrame:
    """Add the greatest earlier counter of the same key, NULL for the first row of a key.

    `split_width` is the length, in units of the first order column, of the buckets that keys are cut into. None keeps
    every key whole.
    """
    order = order_columns(rows, order_by)
    if split_width is None:
        window = Window.partitionBy(*keys).orderBy(*[column(c) for c in order]).rowsBetween(*EARLIER)
        return rows.withColumn(PREVIOUS, F.max(COUNTER).over(window))

    group = [*keys, BUCKET]
    dealt = _dealt(rows, keys, _bucket(rows, order[0], split_width))
    in_bucket = Window.partitionBy(*group).orderBy(*[F.col(ROW).getField(c) for c in order]).rowsBetween(*EARLIER)
    over_buckets = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(*EARLIER)
    carried = (
        # Asking for the row keeps its columns in what is dealt, so that it is the same for both readers.
        dealt.groupBy(*group)
        .agg(F.max(F.when(F.col(ROW).isNotNull(), F.col(COUNTER))).alias(GREATEST))
        .withColumn(CARRIED, F.max(GREATEST).over(over_buckets))
        .where(F.col(CARRIED).isNotNull())
        .select(*group, CARRIED)
    )
    compared = dealt.withColumn(INSIDE, F.max(COUNTER).over(in_bucket)).join(carried, group, "left")
    previous = F.greatest(INSIDE, CARRIED).alias(PREVIOUS)
    others = [c for c in rows.columns if c not in (*keys, COUNTER)]
    unpacked = compared.select(*keys, COUNTER, previous, F.inline(F.array(ROW)).alias(*[f"{OWN}{i}" for i in range(len(others))]))
    names = {c: f"{OWN}{i}" for i, c in enumerate(others)}
    return unpacked.select(*[F.col(names.get(c, c)).alias(c) for c in rows.columns], PREVIOUS)


def _dealt(rows: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """The rows by key and bucket, other columns packed into one.

    The optimizer must not see that the packed row is never null, or it would drop columns for one of the readers and
    so read the source twice. Keys of usable rows are never null; saying so here keeps it from saying so for one reader.
    """
    others = [column(c).alias(c) for c in rows.columns if c not in (*keys, COUNTER)]
    row = F.when(F.expr("spark_partition_id() >= 0"), F.struct(*others))
    for key in keys:
        rows = rows.where(column(key).isNotNull())
    return rows.select(*keys, COUNTER, bucket.alias(BUCKET), row.alias(ROW)).repartition(*keys, BUCKET)


def _bucket(rows: DataFrame, order_column: str, split_width: int) -> Column:
    position = quoted(order_column)
    if isinstance(rows.schema[order_column].dataType, T.TimestampType):
        position = f"unix_micros({position})"
    # Rows without a position (maxima carried over from earlier batches) sort first: they go to the lowest bucket.
    return F.expr(f"coalesce(cast({position} as bigint) div {int(split_width)}, {LOWEST})")


def ascends() -> Column:
    return F.col(PREVIOUS).isNull() | (F.col(COUNTER) > F.col(PREVIOUS))


def keep_ascending(
    keyed: Keyed, order_by: str | Sequence[str], split_width: int | None = SPLIT_WIDTH
) -> DataFrame:
    """The usable rows whose counter rises for their key, with their original columns."""
    if keyed.rows.isStreaming:
        from millrace.streaming.state import keep_ascending_stateful

        return keep_ascending_stateful(keyed, order_by, split_width)
    compared = with_previous_max(keyed.usable, keyed.keys, order_by, split_width)
    return compared.where(ascends()).select(*keyed.payload_columns)


def rejected(
    keyed: Keyed, order_by: str | Sequence[str], split_width: int | None = SPLIT_WIDTH
) -> DataFrame:
    """The rows `keep_ascending` leaves out, with the reason of each."""
    compared = with_previous_max(keyed.usable, keyed.keys, order_by, split_width)
    duplicates = compared.where(~ascends()).select(*keyed.payload_columns, F.lit(DUPLICATE).alias("reason"))
    unusable = keyed.unusable.select(*keyed.payload_columns, F.col(REASON).alias("reason"))
    return duplicates.unionByName(unusable)


def dedup_json(
    df: DataFrame,
    keys: str | Sequence[str],
    counter: str,
    order_by: str | Sequence[str],
    text: str = "line",
    split_width: int | None = SPLIT_WIDTH,
) -> DataFrame:
    """Keep the JSON lines whose counter rises for their key. Without keys or counter all lines pass unread."""
    if not dedup_enabled(keys, counter):
        return df
    return keep_ascending(key_json(df, keys, counter, text), order_by, split_width)


def dedup_json_rejects(
    df: DataFrame,
    keys: str | Sequence[str],
    counter: str,
    order_by: str | Sequence[str],
    text: str = "line",
    split_width: int | None = SPLIT_WIDTH,
) -> DataFrame:
    return rejected(key_json(df, keys, counter, text), order_by, split_width)


def key_bytes(df: DataFrame, keys: str | Sequence[str], counter: str, event: str = "event") -> Keyed:
    """As `key_json` for a binary column; the bytes themselves stay untouched."""
    refuse_own_names(df)
    decoded = df.withColumn(TEXT, utf8_text(column(event)))
    keyed = key_json(decoded, keys, counter, TEXT)
    return Keyed(keyed.rows.drop(TEXT), keyed.keys, tuple(df.columns))


def dedup_bytes(
    df: DataFrame,
    keys: str | Sequence[str],
    counter: str,
    order_by: str | Sequence[str],
    event: str = "event",
    split_width: int | None = SPLIT_WIDTH,
) -> DataFrame:
    """`dedup_json` for UTF-8 payloads in a binary column."""
    if not dedup_enabled(keys, counter):
        return df
    return keep_ascending(key_bytes(df, keys, counter, event), order_by, split_width)


def dedup_records(
    df: DataFrame,
    keys: str | Sequence[str],
    counter: str,
    order_by: str | Sequence[str],
    split_width: int | None = SPLIT_WIDTH,
) -> DataFrame:
    """Keep the typed records whose counter rises for their key; records with a null key or counter are left out."""
    if not dedup_enabled(keys, counter):
        return df
    return keep_ascending(key_records(df, keys, counter), order_by, split_width)


def dedup_records_rejects(
    df: DataFrame,
    keys: str | Sequence[str],
    counter: str,
    order_by: str | Sequence[str],
    split_width: int | None = SPLIT_WIDTH,
) -> DataFrame:
    return rejected(key_records(df, keys, counter), order_by, split_width)
