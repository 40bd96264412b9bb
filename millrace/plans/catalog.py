"""The operators and jobs applied to the shared test tables, one named query each."""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import Options
from millrace.functions import render
from millrace.functions.avro_schema import parse_avro_schema
from millrace.operators import dedup
from millrace.operators.flatten import flatten
from millrace.operators.parse import malformed_lines, parse_records
from millrace.plans import jobs
from millrace.session import scratch_folder
from millrace.sinks import console
from millrace.sinks.events import append_events
from millrace.sources import events as stream
from millrace.sources.generator import sample_event_lines, sample_events

SEGMENTS = 4
ROWS_PER_SPLIT = 1000

EVENT_SCHEMA = json.dumps({
    "type": "record", "name": "Event", "fields": [
        {"name": "user_id", "type": "long"},
        {"name": "event_type", "type": "string"},
        {"name": "counter", "type": "long"},
        {"name": "event_id", "type": "long"},
    ],
})
PROPS_SCHEMA = json.dumps({"type": "record", "name": "Props", "fields": [{"name": "k", "type": "long"}]})
NOTE_SCHEMA = json.dumps({
    "type": "record", "name": "Note", "fields": [
        {"name": "id", "type": "long"}, {"name": "note", "type": ["null", "string"]},
    ],
})
AMOUNT_SCHEMA = json.dumps({
    "type": "record", "name": "Amount", "fields": [
        {"name": "id", "type": "long"},
        {"name": "amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 38, "scale": 4}},
    ],
})
ANSWER_SCHEMA = json.dumps({
    "type": "record", "name": "Answer", "fields": [
        {"name": "id", "type": "long"}, {"name": "answer", "type": ["null", "int", "string"]},
    ],
})
ORDER_SCHEMA = json.dumps({
    "type": "record", "name": "OrderLines", "fields": [
        {"name": "orderkey", "type": "long"},
        {"name": "part", "type": "long"},
        {"name": "linenumber", "type": {"type": "array", "items": "int"}},
        {"name": "suppkey", "type": {"type": "array", "items": "long"}},
        {"name": "price", "type": {"type": "array", "items": "double"}},
    ],
})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless}) if zoneless else df


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The events with a whole-number counter and the event as a JSON line."""
    rows = table(spark, folder, "events").withColumn("counter", F.floor("value"))
    return rows.withColumn("line", render.json_line(rows, "user_id", "event_type", "counter", "event_id"))


def flawed_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines, some cut short, some without key, some with a counter in quotes."""
    event_id = F.col("event_id")
    line = (
        F.when(event_id % 17 == 0, F.expr("left(line, length(line) - 1)"))
        .when(event_id % 19 == 0, F.replace("line", F.lit('"user_id"'), F.lit('"user"')))
        .when(event_id % 23 == 0, F.regexp_replace("line", '"counter":(-?[0-9]+)', '"counter":"$1"'))
        .otherwise(F.col("line"))
    )
    return events(spark, folder).withColumn("line", line)


def published(spark: SparkSession, df: DataFrame, order: str, routing_key: str = "''", appends: int = 1) -> str:
    """A stream table of the lines of `df`, written in `appends` parts in order."""
    path = scratch_folder(spark, "stream")
    size = df.agg((F.max(order) + 1).alias("n")).first().n or 0
    for part in range(appends):
        low, high = size * part // appends, size * (part + 1) // appends
        rows = df.where((F.col(order) >= low) & (F.col(order) < high))
        append_events(
            rows, path, "tables", part, render.utf8_bytes(F.col("line")), F.col(order), F.expr(routing_key), SEGMENTS,
            span=(low, max(low, high - 1)),
        )
    return path


def finished(query) -> None:
    query.awaitTermination()


def encoded(schema: str) -> str:
    return base64.b64encode(schema.encode()).decode()


# Dedup


def dedup_json(spark, folder):
    return dedup.dedup_json(events(spark, folder).select("event_id", "line"), "user_id", "counter", "event_id")


def dedup_composite(spark, folder):
    rows = events(spark, folder).select("event_id", "line")
    return dedup.dedup_json(rows, "user_id, event_type", "counter", "event_id")


def dedup_object_key(spark, folder):
    user = F.concat(F.lit('"user":'), F.col("user_id").cast("string"))
    kind = F.concat(F.lit('"type":"'), F.col("event_type"), F.lit('"'))
    members = F.when(F.col("event_id") % 2 == 0, F.concat(user, F.lit(","), kind)).otherwise(
        F.concat(kind, F.lit(", "), user)
    )
    line = F.concat(
        F.lit('{"source":{'), members, F.lit('},"counter":'), F.col("counter").cast("string"), F.lit("}")
    )
    rows = events(spark, folder).select("event_id", line.alias("line"))
    return dedup.dedup_json(rows, "source", "counter", "event_id")


def dedup_repeated_names(spark, folder):
    """A key object that repeats a member name, of which the last counts."""
    line = F.format_string('{"source":{"user":0,"kind":7,"user":%d},"counter":%d}', "user_id", "counter")
    rows = events(spark, folder).select("event_id", line.alias("line"))
    return dedup.dedup_json(rows, "source", "counter", "event_id")


def dedup_key_types(spark, folder):
    forms = ["1", "1.0", "1e0", '"1"', "null", "true", "[1,2]", "[2,1]", '{"a":1,"b":[2]}', '{"b":[2],"a":1}',
             "[1,1.0]", "[1.0,1]", '{"a":[1,2.5]}', '{"a":[1.0,2.5]}']
    key = F.array(*[F.lit(f) for f in forms])[(F.col("event_id") % len(forms)).cast("int")]
    line = F.concat(F.lit('{"key":'), key, F.lit(',"counter":'), F.col("counter").cast("string"), F.lit("}"))
    rows = events(spark, folder).select("event_id", line.alias("line"))
    return dedup.dedup_json(rows, "key", "counter", "event_id", split_width=ROWS_PER_SPLIT)


def dedup_bytes(spark, folder):
    rows = events(spark, folder).select("event_id", render.utf8_bytes(F.col("line")).alias("event"))
    kept = dedup.dedup_bytes(rows, "user_id", "counter", "event_id")
    return kept.select("event_id", render.utf8_text(F.col("event")).alias("line"))


def dedup_record(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "event_type", "counter")
    return dedup.dedup_records(rows, "user_id", "counter", "event_id")


def dedup_malformed(spark, folder):
    rows = flawed_events(spark, folder).select("event_id", "line")
    return dedup.dedup_json(rows, "user_id", "counter", "event_id")


def dedup_rejects(spark, folder):
    rows = flawed_events(spark, folder).select("event_id", "line")
    return dedup.dedup_json_rejects(rows, "user_id", "counter", "event_id")


def dedup_passthrough(spark, folder):
    return dedup.dedup_json(flawed_events(spark, folder).select("event_id", "line"), "", "counter", "event_id")


def dedup_hot_key(spark, folder):
    rows = events(spark, folder).select("event_id", "counter", F.lit("all").alias("key"))
    return dedup.dedup_records(rows, "key", "counter", "event_id", split_width=ROWS_PER_SPLIT)


def dedup_hot_third(spark, folder):
    key = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    rows = events(spark, folder).select("event_id", key.alias("key"), "counter")
    return dedup.dedup_records(rows, "key", "counter", "event_id", split_width=ROWS_PER_SPLIT)


def dedup_stream(spark, folder):
    """The text file job over a stream written in five appends."""
    path = published(spark, events(spark, folder), "event_id", "cast(user_id as string)", appends=5)
    output = scratch_folder(spark, "lines")
    options = Options({
        "input-stream": path, "output": output, "endAtTail": "true", "keyFieldNames": "user_id",
        "counterFieldName": "counter",
    })
    finished(jobs.stream_to_file(spark, options))
    return spark.read.schema("value string").text(output).select(F.col("value").alias("line"))


def dedup_parallelism(spark, folder):
    """The CSV job with a parallelism of its own and few appends in a batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    path = published(spark, events(spark, folder), "event_id", "cast(user_id as string)", appends=3)
    output = scratch_folder(spark, "csv")
    options = Options({
        "input-stream": path, "output": output, "endAtTail": "true", "avroSchema": encoded(EVENT_SCHEMA),
        "keyFieldNames": "user_id", "counterFieldName": "counter", "parallelism": "3", "appendsPerBatch": "2",
    })
    try:
        finished(jobs.stream_to_csv_file(spark, options))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return spark.read.schema("value string").text(output).select(F.col("value").alias("line"))


def rolled_files(spark, folder):
    """The text file job over four appends, one a micro-batch: the lines that each batch rolled into files of its own."""
    path = published(spark, events(spark, folder), "event_id", appends=4)
    output = scratch_folder(spark, "lines")
    options = Options({"input-stream": path, "output": output, "endAtTail": "true", "appendsPerBatch": "1"})
    finished(jobs.stream_to_file(spark, options))
    lines = spark.read.text(output).select(F.substring_index("batch", "-", -1).cast("bigint").alias("batch"))
    return lines.groupBy("batch").agg(F.count(F.lit(1)).alias("lines"))


def dedup_stream_hot(spark, folder):
    """The stream-to-stream job with one key that holds a third of all events, and so is split."""
    key = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    rows = events(spark, folder).select("event_id", key.alias("key"), "counter")
    rows = rows.withColumn("line", render.json_line(rows))
    path = published(spark, rows, "event_id", "cast(key as string)", appends=3)
    target = scratch_folder(spark, "clean")
    options = Options({
        "input-stream": path, "output-stream": target, "endAtTail": "true", "keyFieldNames": "key",
        "counterFieldName": "counter", "splitWidth": str(ROWS_PER_SPLIT), "appendsPerBatch": "2",
    })
    finished(jobs.stream_to_stream(spark, options))
    return stream.as_text(stream.read_events(spark, target)).select("line")


def dedup_stateful(spark, folder):
    """The keyed state operator inside a streaming query."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    path = published(spark, events(spark, folder), "event_id", "cast(user_id as string)")
    output, checkpoint = scratch_folder(spark, "kept"), scratch_folder(spark, "checkpoint")
    source = stream.as_text(stream.stream_events(spark, path)).select("offset", "line")
    kept = dedup.dedup_json(source, "user_id", "counter", "offset")
    finished(
        kept.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    return spark.read.schema(kept.schema).parquet(output).select("line")


# Parse, flatten, render


def parse_json(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.col("props").alias("line"))
    return parse_records(rows, parse_avro_schema(PROPS_SCHEMA), keep=("event_id",))


def parse_drop(spark, folder):
    rows = flawed_events(spark, folder).select("event_id", "line")
    parsed = parse_records(
        rows.withColumnRenamed("event_id", "position"), parse_avro_schema(EVENT_SCHEMA), on_error="drop",
        keep=("position",),
    )
    return parsed


def parse_malformed(spark, folder):
    rows = flawed_events(spark, folder).select("event_id", "line")
    return malformed_lines(rows, parse_avro_schema(EVENT_SCHEMA))


def parse_optional(spark, folder):
    """A nullable field, which JSON-encoded Avro writes as null or as {"string": …}."""
    note = F.when(F.col("turn") == 0, F.lit(None)).otherwise(F.struct(F.col("text").alias("string")))
    rows = table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), note.alias("note"))
    lines = rows.select(render.json_line(rows, "id", "note").alias("line"))
    return parse_records(lines, parse_avro_schema(NOTE_SCHEMA))


def amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Unscaled numbers as JSON text of their bytes: small and 38 digits long, of either sign, in few bytes and in many."""
    top = 10**38 - 1
    high, low = hex(top >> 64)[2:].upper(), top & (2**64 - 1)
    inverted = f"{(2**128 - 1 - top) >> 64:016X}"
    digits = F.expr(f"""case event_id % 4
        when 0 then if(length(hex(event_id)) % 2 = 0, '00', '0') || hex(event_id)
        when 1 then hex(-event_id)
        when 2 then '{high}' || lpad(hex({low} - event_id), 16, '0')
        else '{inverted}' || hex(event_id - {low}) end""")
    text = F.regexp_replace(digits, "(..)", r"\\u00$1")
    line = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"amount":"'), text, F.lit('"}'))
    return table(spark, folder, "events").select("event_id", line.alias("line"))


def parse_decimals(spark, folder):
    """Decimals of up to 38 digits from the bytes of their unscaled values."""
    rows = parse_records(amounts(spark, folder), parse_avro_schema(AMOUNT_SCHEMA))
    return rows.select("id", F.col("amount").cast("string").alias("amount"))


def parse_unions(spark, folder):
    """A field that is null, a number or a text."""
    answer = (
        F.when(F.col("turn") % 3 == 1, F.concat(F.lit('{"int":'), F.col("turn").cast("string"), F.lit("}")))
        .when(F.col("turn") % 3 == 2, F.to_json(F.struct(F.col("text").alias("string"))))
        .otherwise("null")
    )
    line = F.concat(F.lit('{"answer":'), answer, F.lit(',"id":'), F.col("conv_id").cast("string"), F.lit("}"))
    rows = parse_records(table(spark, folder, "conversations").select(line.alias("line")), parse_avro_schema(ANSWER_SCHEMA))
    return rows.select("id", F.col("answer.member0").alias("number"), F.col("answer.member1").alias("text"))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitem rows packed into parallel arrays of at most eight lines of one order."""
    items = table(spark, folder, "lineitem").withColumn("part", F.expr("cast(l_linenumber div 8 as bigint)"))
    entry = F.struct("l_linenumber", "l_suppkey", "l_extendedprice")
    packed = items.groupBy(F.col("l_orderkey").alias("orderkey"), "part").agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return packed.select(
        "orderkey",
        "part",
        F.col("entries.l_linenumber").alias("linenumber"),
        F.col("entries.l_suppkey").alias("suppkey"),
        F.col("entries.l_extendedprice").alias("price"),
    )


def flatten_arrays(spark, folder):
    return flatten(order_lines(spark, folder))


def flatten_embeddings(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", F.sequence(F.lit(0), F.size("embedding") - 1).alias("position"), "label", "embedding"
    )
    return flatten(vectors).withColumn("embedding", F.col("embedding").cast("double"))


def csv_lines(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return rows.select("c_custkey", render.csv_line(rows, null_value="").alias("line"))


def csv_nested(spark, folder):
    """Arrays of records, maps in arrays, and a record with bytes, a null and an array."""
    name, kind, nation = F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")
    entry = lambda number, text: F.struct(number.alias("nation"), text.alias("name"))
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.array(entry(nation, name), entry(F.lit(None).cast("int"), kind)).alias("entries"),
        F.array(F.create_map(F.lit("k"), nation)).alias("maps"),
        F.struct(kind.cast("binary").alias("raw"), F.array(name, F.lit(None)).alias("tags"), F.lit(True).alias("good")).alias("r"),
    )
    return rows.select("c_custkey", render.csv_line(rows).alias("line"))


def csv_quoted(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return rows.select("doc_id", render.csv_line(rows, null_value="", quote=True).alias("line"))


def json_lines(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    return rows.select("event_id", render.json_line(rows).alias("line"))


def timestamp_texts(spark, folder):
    rows = table(spark, folder, "events")
    return rows.select("event_id", render.timestamp_text(F.col("ts")).alias("ts_text"))


def utf8_round_trip(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", render.utf8_bytes(F.col("text")).alias("event"))
    return rows.select("doc_id", render.utf8_text(F.col("event")).alias("text"))


def utf8_invalid(spark, folder):
    """Bytes that are no UTF-8, in the middle and cut off at the end."""
    broken = F.concat(F.col("source").cast("binary"), F.unhex(F.lit("FF")), F.col("lang").cast("binary"), F.unhex(F.lit("C3")))
    rows = table(spark, folder, "documents").where("source is not null and lang is not null")
    return rows.select("doc_id", render.utf8_text(broken).alias("text"))


def hour_buckets(spark, folder):
    rows = table(spark, folder, "events")
    return rows.select("event_id", render.hour_bucket(F.col("ts")).alias("bucket"))


# Streams and positions


def _positioned(spark: SparkSession, folder: str) -> DataFrame:
    segment = (F.col("user_id") % SEGMENTS).cast("int")
    return table(spark, folder, "events").select(segment.alias("segment"), F.col("event_id").alias("offset"))


def read_range(spark, folder):
    start = {0: 100, 1: 2000, 2: 50}
    end = {0: 9000, 1: 5000, 2: 1_000_000_000, 3: 700}
    return stream.within(_positioned(spark, folder), start, end)


def stream_info(spark, folder):
    return stream.stream_info(_positioned(spark, folder))


def text_scan(spark, folder):
    path = published(spark, table(spark, folder, "documents").withColumnRenamed("text", "line"), "doc_id")
    events_read = stream.as_text(stream.read_events(spark, path))
    return events_read.select((F.col("offset")).alias("doc_id"), "line")


def binary_scan(spark, folder):
    path = published(spark, table(spark, folder, "documents").withColumnRenamed("text", "line"), "doc_id")
    return stream.read_events(spark, path).select(
        F.col("offset").alias("doc_id"), F.sha2("event", 256).alias("digest")
    )


def read_from_tail(spark, folder):
    """A reader that starts at the tail sees only what is appended later: here the second half of the table."""
    rows = events(spark, folder)
    half = (rows.agg(F.max("event_id").alias("n")).first().n or 0) // 2
    path = scratch_folder(spark, "stream")
    parts = [rows.where(F.col("event_id") <= half), rows.where(F.col("event_id") > half)]
    tail = None
    for batch, part in enumerate(parts):
        tail = stream.resolve_start(spark, path, at_tail=True) if batch else None
        append_events(
            part, path, "tables", batch, render.utf8_bytes(F.col("line")), F.col("event_id"),
            F.col("user_id").cast("string"), SEGMENTS,
        )
    return stream.as_text(stream.read_events(spark, path, tail)).select("line")


def console_lines(spark, folder):
    """What the console job prints of a stream that the table was written to."""
    path = published(spark, events(spark, folder), "event_id", "cast(user_id as string)", appends=2)
    return jobs.console_lines(stream.read_events(spark, path)).select("line")


def output_log(spark, folder):
    """What the record jobs log of their output: records as JSON after a word that marks them."""
    return console.record_lines(table(spark, folder, "events").select("event_id", "user_id", "event_type"))


def stream_copy(spark, folder):
    """The stream-to-stream job with a fixed routing key, read back."""
    path = published(spark, events(spark, folder), "event_id", "cast(user_id as string)", appends=2)
    target = scratch_folder(spark, "copy")
    options = Options({
        "input-stream": path, "output-stream": target, "endAtTail": "true", "fixedRoutingKey": "copied",
    })
    finished(jobs.stream_to_stream(spark, options))
    return stream.as_text(stream.read_events(spark, target)).select("routing_key", "line")


def route_events(spark, folder):
    """How many segments each routing key reaches (one) and how many events it has."""
    path = published(spark, events(spark, folder), "event_id", "cast(user_id as string)")
    return stream.read_events(spark, path).groupBy("routing_key").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("segment").alias("segments"))


def writers_take_turns(spark, folder):
    """Three writers append by turns; a reader that started at the tail after the second turn sees the other turns."""
    rows = events(spark, folder)
    size = rows.agg((F.max("event_id") + 1).alias("n")).first().n or 0
    path, tail = scratch_folder(spark, "stream"), None
    for turn in range(6):
        part = rows.where((F.col("event_id") >= size * turn // 6) & (F.col("event_id") < size * (turn + 1) // 6))
        append_events(
            part, path, f"writer{turn % 3}", turn // 3, render.utf8_bytes(F.col("line")), F.col("event_id"),
            F.col("user_id").cast("string"), SEGMENTS,
        )
        tail = stream.tail_cut(spark, path) if turn == 1 else tail
    return stream.as_text(stream.read_events(spark, path, tail)).select("line", "offset")


def generate_events(spark, folder):
    """Generator events for every tick in the events table, three sensors each."""
    rows = table(spark, folder, "events")
    ticks = rows.select(F.col("event_id").alias("eventNumber"), F.col("ts").alias("timestamp"))
    return sample_event_lines(sample_events(ticks, sensors=3, data_size=10))


def csv_job(spark, folder):
    path = published(spark, flawed_events(spark, folder), "event_id", "cast(user_id as string)", appends=3)
    output = scratch_folder(spark, "csv")
    options = Options({
        "input-stream": path, "output": output, "endAtTail": "true", "avroSchema": encoded(EVENT_SCHEMA),
        "keyFieldNames": "user_id,event_type", "counterFieldName": "counter",
    })
    finished(jobs.stream_to_csv_file(spark, options))
    return spark.read.schema("value string").text(output).select(F.col("value").alias("line"))


def parquet_job(spark, folder):
    orders = order_lines(spark, folder)
    lines = orders.select(F.expr("orderkey * 100 + part").alias("position"), "orderkey",
                          render.json_line(orders).alias("line"))
    path = published(spark, lines, "position", "cast(orderkey as string)")
    output = scratch_folder(spark, "parquet")
    options = Options({
        "input-stream": path, "output": output, "endAtTail": "true", "avroSchema": encoded(ORDER_SCHEMA),
        "keyFieldNames": "orderkey", "counterFieldName": "part", "flatten": "true",
    })
    finished(jobs.stream_to_parquet_file(spark, options))
    return spark.read.parquet(output).select("orderkey", "part", "linenumber", "suppkey", "price")


QUERIES = {
    query.__name__: query
    for query in (
        dedup_json, dedup_composite, dedup_object_key, dedup_key_types, dedup_bytes, dedup_record, dedup_malformed,
        dedup_rejects, dedup_passthrough, dedup_hot_key, dedup_hot_third, dedup_stream, dedup_stream_hot,
        dedup_stateful, parse_json, parse_drop, parse_malformed, parse_optional, flatten_arrays, flatten_embeddings,
        csv_lines, csv_quoted, json_lines, timestamp_texts, utf8_round_trip, hour_buckets,
        read_range, stream_info, text_scan, binary_scan, read_from_tail, stream_copy, route_events, writers_take_turns,
        generate_events, csv_job, parquet_job, parse_decimals, parse_unions, csv_nested, utf8_invalid, dedup_repeated_names,
        dedup_parallelism, rolled_files, console_lines, output_log,
    )
}
