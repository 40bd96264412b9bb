import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from scenarios import SCENARIOS

from millrace.operators import dedup
from millrace.operators.dedup import COUNTER
from millrace.sinks import events as events_sink
from millrace.sinks.events import append_events
from millrace.sinks.files import write_bucketed
from millrace.sources import events as stream
from millrace.streaming import state
from millrace.streaming.follow import follow


def publish(spark, path, texts, writer="w", batch_id=0, first=0, segments=1, routing_key=None, files=2):
    """Append texts in order; `routing_key` is a SQL expression over `line`."""
    rows = [(first + i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "seq bigint, line string").repartition(files)
    return append_events(
        df, path, writer, batch_id, F.col("line").cast("binary"), F.col("seq"),
        F.expr(routing_key) if routing_key else F.lit(""), segments,
    )


def texts_of(events):
    return [row.line for row in stream.as_text(events).orderBy("segment", "offset").collect()]


def test_append_and_read_back(spark, tmp_path):
    path = str(tmp_path / "s")
    stream.create_stream(spark, path)
    assert stream.stream_ends(spark, path) == {} and stream.read_events(spark, path).count() == 0
    assert publish(spark, path, ["a", "b", "c"])
    assert publish(spark, path, ["d", "e"], batch_id=1, first=1000)
    assert publish(spark, path, [], batch_id=2)
    assert publish(spark, path, ["f"], batch_id=3)
    assert texts_of(stream.read_events(spark, path)) == list("abcdef")
    assert stream.stream_ends(spark, path) == {0: (0, 6)}
    info = stream.stream_info(stream.read_events(spark, path)).collect()
    assert [tuple(row) for row in info] == [(0, 0, 6)]


def test_append_is_exactly_once(spark, tmp_path):
    path = str(tmp_path / "s")
    publish(spark, path, ["a", "b"])
    assert publish(spark, path, ["a", "b"]) is False
    # A batch that died after writing data and before its positions does not count and is replaced.
    lost = spark.createDataFrame([(0, 2, "", bytearray(b"half"), None)], stream.EVENT_SCHEMA)
    lost.write.parquet(f"{path}/data/{stream.append_name('w', 1)}")
    assert texts_of(stream.read_events(spark, path)) == ["a", "b"]
    publish(spark, path, ["c"], batch_id=1)
    assert texts_of(stream.read_events(spark, path)) == ["a", "b", "c"]
    publish(spark, path, ["d"], writer="other")
    assert texts_of(stream.read_events(spark, path)) == ["a", "b", "c", "d"]


def test_writers_take_turns(spark, tmp_path):
    """Every append starts behind the last one, whoever wrote it; a reader that starts at the tail loses nothing."""
    path = str(tmp_path / "s")
    publish(spark, path, [f"a{i}" for i in range(10)], writer="a")
    publish(spark, path, [f"b{i}" for i in range(100)], writer="b")
    tail = stream.tail_cut(spark, path)
    publish(spark, path, [f"c{i}" for i in range(10)], writer="a", batch_id=1)
    events = stream.read_events(spark, path)
    assert events.count() == events.select("offset").distinct().count() == 120
    assert sorted(texts_of(stream.read_events(spark, path, start=tail))) == [f"c{i}" for i in range(10)]
    assert len(stream.read_events(spark, path, start=tail).inputFiles()) <= 2


def test_an_orphan_stays_unseen_below_the_tail(spark, tmp_path):
    path = str(tmp_path / "s")
    publish(spark, path, ["a"], writer="a")
    orphan = spark.createDataFrame([(0, 1, "", bytearray(b"lost"), None)], stream.EVENT_SCHEMA)
    orphan.write.parquet(f"{path}/data/{stream.append_name('a', 1)}")
    publish(spark, path, ["b", "c"], writer="b")
    assert texts_of(stream.read_events(spark, path)) == ["a", "b", "c"]


def test_an_append_that_was_overtaken_fails(spark, tmp_path, monkeypatch):
    path, calls = str(tmp_path / "s"), []
    publish(spark, path, ["a"], writer="a")

    def moved(session, folder, read=events_sink._next_offset):
        calls.append(folder)
        if len(calls) == 2:
            monkeypatch.undo()
            publish(spark, path, ["other"], writer="b")
        return read(session, folder)

    monkeypatch.setattr(events_sink, "_next_offset", moved)
    with pytest.raises(RuntimeError, match="another writer"):
        publish(spark, path, ["mine"], writer="a", batch_id=1)
    assert publish(spark, path, ["mine"], writer="a", batch_id=1)
    assert texts_of(stream.read_events(spark, path)) == ["a", "other", "mine"]


def test_routing_keeps_keys_together_and_in_order(spark, tmp_path):
    path = str(tmp_path / "s")
    texts = [f"{i % 7}:{i}" for i in range(70)]
    publish(spark, path, texts, segments=3, routing_key="split_part(line, ':', 1)")
    rows = stream.as_text(stream.read_events(spark, path)).orderBy("offset").collect()
    assert [row.line for row in rows] == texts
    assert len({(row.routing_key, row.segment) for row in rows}) == 7
    assert {row.segment for row in rows} <= {0, 1, 2}


def test_cuts(spark, tmp_path):
    path = str(tmp_path / "s")
    publish(spark, path, list("abcdef"))
    for batch, texts in enumerate(["ghi", "jk"], 1):
        publish(spark, path, list(texts), batch_id=batch)

    def between(start, end):
        return "".join(texts_of(stream.read_events(spark, path, stream.parse_cut(start), stream.parse_cut(end))))

    assert between("UNBOUNDED", None) == "abcdefghijk"
    assert between('{"0": 4}', '{"0": 8}') == "efgh"
    assert between('{"0": 11}', "") == "" and between("", '{"0": 0}') == "" and between("", "{}") == ""
    assert between('{"5": 3}', "") == "abcdefghijk" and between("", '{"5": 3}') == ""
    tail = stream.resolve_start(spark, path, at_tail=True, cut={0: 1})
    assert tail == {0: 11}
    publish(spark, path, list("lm"), batch_id=3)
    assert "".join(texts_of(stream.read_events(spark, path, tail))) == "lm"
    assert "".join(texts_of(stream.read_events(spark, path, None, tail))) == "abcdefghijk"
    assert stream.resolve_start(spark, path, False, {0: 2}) == {0: 2}
    assert stream.resolve_end(spark, path) is None
    assert stream.parse_cut(stream.cut_text({1: 5, 0: 3})) == {0: 3, 1: 5}
    plan = stream.read_events(spark, path, {0: 4}, {0: 8})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,4)" in plan and "LessThan(offset,8)" in plan


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_follow_whole_appends_across_restarts(spark, tmp_path):
    path, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    seen = []

    def handle(events, batch_id, bucket):
        seen.append((batch_id, "".join(texts_of(events)), bucket))

    for batch, texts in enumerate(["abc", "de", "f"]):
        publish(spark, path, list(texts), batch_id=batch)
    run(follow(spark, path, handle, checkpoint, appends_per_batch=2))
    publish(spark, path, list("gh"), batch_id=3)
    run(follow(spark, path, handle, checkpoint, appends_per_batch=2))
    run(follow(spark, path, handle, checkpoint, appends_per_batch=2))
    assert [(batch, text) for batch, text, _ in seen] == [(0, "abcde"), (1, "f"), (2, "gh")]
    assert all(len(bucket) == len("2020-05-10--18") for *_, bucket in seen)

    seen.clear()
    run(follow(spark, path, handle, str(tmp_path / "c2"), {0: 1}, {0: 5}, appends_per_batch=1))
    assert [text for _, text, _ in seen] == ["bc", "de", "", ""]


def test_failed_batch_runs_again_with_the_same_bucket(spark, tmp_path):
    path, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    publish(spark, path, ["a"])
    seen = []

    def handle(events, batch_id, bucket):
        seen.append((batch_id, bucket, texts_of(events)))
        if len(seen) == 1:
            raise RuntimeError("planned failure")

    query = follow(spark, path, handle, checkpoint)
    with pytest.raises(Exception, match="planned failure"):
        query.awaitTermination()
    run(follow(spark, path, handle, checkpoint))
    assert len(seen) == 2 and seen[0] == seen[1]


def stateful_lines(spark, path, checkpoint, output, keys):
    source = stream.as_text(stream.stream_events(spark, path, maxFilesPerTrigger="1")).select("offset", "line")
    kept = dedup.dedup_json(source, keys, "counter", "offset")
    return (
        kept.select("line").writeStream.format("parquet").option("path", output)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


@pytest.mark.parametrize("name", ["value_kinds", "two_fields"])
def test_stateful_scenario(name, spark, tmp_path, partitions):
    keys, rows = SCENARIOS[name]
    path, checkpoint, output = (str(tmp_path / d) for d in ("s", "c", "o"))
    half = len(rows) // 2
    publish(spark, path, [text for text, _ in rows[:half]], files=1)
    run(stateful_lines(spark, path, checkpoint, output, keys))
    publish(spark, path, [text for text, _ in rows[half:]], batch_id=1, files=1)
    run(stateful_lines(spark, path, checkpoint, output, keys))
    kept = sorted(row.line for row in spark.read.schema("line string").parquet(output).collect())
    assert kept == sorted(text for text, keep in rows if keep)


def test_stateful_types_and_large_counters(spark, tmp_path):
    path, checkpoint, output = (str(tmp_path / d) for d in ("t", "c", "o"))
    rng = random.Random(7)
    edges = [2**63 - 1, -(2**63), 2**53, 2**53 + 1, 5, 6, 7]
    rows = [(i, rng.choice("ab"), rng.choice(edges), None if i % 2 else 2**53 + 1) for i in range(60)]
    schema = "seq bigint, key string, counter bigint, extra bigint"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    source = spark.readStream.schema(schema).parquet(path)
    kept = dedup.dedup_records(source, "key", "counter", "seq")
    run(kept.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    batch = dedup.dedup_records(spark.read.parquet(path), "key", "counter", "seq")
    assert sorted(map(tuple, spark.read.schema(schema).parquet(output).collect()), key=str) == sorted(
        map(tuple, batch.collect()), key=str
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stateful_hot_key_in_bounded_memory(zone, spark, tmp_path, monkeypatch):
    """One key holds a third of the rows of each micro-batch and is put aside in buckets; order is by time, over a change
    of the clocks."""
    monkeypatch.setattr(state, "HELD_ROWS", 50)
    monkeypatch.setattr(state, "WIDEST", 40_000_000)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        rng, path = random.Random(11), str(tmp_path / "t")
        rows = [(1604196000 * 10**6 + i * 9_000_000, "hot" if i % 3 else rng.choice("abc"), rng.randrange(i + 40), f"é{i}") for i in range(1500)]
        schema = "micros bigint, key string, counter bigint, note string"
        for part in range(2):
            mixed = rows[part * 750:(part + 1) * 750]
            rng.shuffle(mixed)
            spark.createDataFrame(mixed, schema).selectExpr("timestamp_micros(micros) as ts", "key", "counter", "note").coalesce(1).write.mode(
                "append").parquet(path)
        source = spark.readStream.schema("ts timestamp, key string, counter bigint, note string").parquet(path)
        kept = dedup.dedup_records(source, "key", "counter", "ts")
        output = str(tmp_path / "o")
        run(kept.writeStream.format("parquet").option("path", output).option("checkpointLocation", str(tmp_path / "c"))
            .trigger(availableNow=True).start())
        batch = dedup.dedup_records(spark.read.parquet(path), "key", "counter", "ts")
        found = sorted(map(tuple, spark.read.schema(kept.schema).parquet(output).collect()))
        assert found == sorted(map(tuple, batch.collect())) and len(found) > 20
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


class Store:
    """A map and a value as the state store gives them."""

    def __init__(self):
        self.rows, self.most = {}, 0

    def exists(self):
        return None in self.rows

    def get(self):
        return self.rows[None]

    def update(self, value):
        self.rows[None] = value

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]


@pytest.mark.parametrize("held", [20, 10_000])
def test_a_key_is_taken_in_parts(held):
    """However many rows a key has, no more than a bucket of them is compared at a time."""
    rng = random.Random(4)
    rows = [(i if i else None, 2**60 + rng.randrange(3000), f"p{i}") for i in range(3000)]
    best, want = -(2**63), []
    for _, counter, text in rows:
        if counter > best:
            best = counter
            want.append(text)
    rng.shuffle(rows)
    frames = [pd.DataFrame({"seq": pd.array([r[0] for r in rows[i:i + 16]], dtype="Int64"), COUNTER: [r[1] for r in rows[i:i + 16]],
                            "text": [r[2] for r in rows[i:i + 16]]}) for i in range(0, 3000, 16)]
    processor = state.GreatestCounter(["seq", COUNTER, "text"], ["seq"], ["text"], 100, held)
    processor.greatest, processor.waiting = Store(), Store()
    sizes, risen = [], processor._risen
    processor._risen = lambda part: sizes.append(len(part)) or risen(part)
    out = [text for frame in processor.handleInputRows(("k",), iter(frames), None) for text in frame["text"]]
    assert out == want and not processor.waiting.rows and processor.greatest.get() == (best,)
    assert max(sizes) <= 101 if held == 20 else sizes == [3000]


def test_bucketed_files(spark, tmp_path):
    df = spark.sql(
        "select 'a' as line, timestamp'2020-05-10 18:59:59' as ts union all select 'b', timestamp'2020-05-10 19:00:00'"
    )
    output = str(tmp_path / "o")
    for _ in range(2):
        write_bucketed(df, output, "w-3", F.col("ts"), "parquet")
    rows = spark.read.parquet(output).select("line", F.col("bucket").cast("string"), "batch").collect()
    assert sorted(map(tuple, rows)) == [("a", "2020-05-10--18", "w-3"), ("b", "2020-05-10--19", "w-3")]
