import base64
import json
from types import SimpleNamespace

import pytest
from pyspark.sql.readwriter import DataFrameWriter
from scenarios import SCENARIOS
from test_streams import publish, run, texts_of

from millrace.config import Options, parse_arguments
from millrace.plans import jobs
from millrace.sources import events as stream

READING = json.dumps({
    "type": "record", "name": "Reading", "fields": [
        {"name": "station", "type": "int"}, {"name": "seq", "type": "long"}, {"name": "note", "type": "string"},
    ],
})
TRACE = json.dumps({
    "type": "record", "name": "Trace", "fields": [
        {"name": "host", "type": "string"}, {"name": "seq", "type": "long"},
        {"name": "step", "type": {"type": "array", "items": "string"}},
        {"name": "load", "type": {"type": "array", "items": "double"}},
    ],
})


def options(tmp_path, **values):
    paths = {"input-stream": str(tmp_path / "in"), "output": str(tmp_path / "out")}
    return Options({**paths, "endAtTail": "true", **values})


def reading(station, seq, note="x"):
    return json.dumps({"station": station, "extra": None, "seq": seq, "note": note})


def test_arguments():
    parsed = parse_arguments(["--input-stream", "a/b", "--flatten", "--eventsPerSec", "0.5", "-x", "-3", "--k", "v"])
    assert parsed == {"input-stream": "a/b", "flatten": "true", "eventsPerSec": "0.5", "x": "-3", "k": "v"}
    with pytest.raises(ValueError):
        parse_arguments(["stray"])
    values = Options({
        "input-stream": "s", "startAtTail": "true", "input-startAtTail": "false", "endAtTail": "true",
        "input-startStreamCut": '{"0": 7}', "minNumSegments": "3",
    }).stream("input")
    assert (values.start_at_tail, values.end_at_tail, values.start_cut, values.end_cut) == (False, True, {0: 7}, None)
    assert values.segments == 3
    with pytest.raises(ValueError, match="input-stream"):
        Options({}).stream("input")
    with pytest.raises(ValueError, match="Avro schema"):
        Options({}).avro_schema(None)


def test_file_job_copies_everything_without_keys(spark, tmp_path):
    publish(spark, str(tmp_path / "in"), ["a row", "a row", "no {json"])
    run(jobs.stream_to_file(spark, options(tmp_path)))
    out = spark.read.text(str(tmp_path / "out"))
    assert sorted(row.value for row in out.collect()) == ["a row", "a row", "no {json"]
    assert out.columns == ["value", "bucket", "batch"]


@pytest.mark.parametrize("name", ["value_kinds", "taking_turns", "counter_forms"])
@pytest.mark.parametrize("width", ["2"])
def test_file_job_dedup_across_batches_and_restarts(name, width, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs.marks, "SNAPSHOT_EVERY", 2)
    keys, rows = SCENARIOS[name]
    texts = [text for text, _ in rows]
    chosen = options(
        tmp_path, keyFieldNames=keys, counterFieldName="counter", splitWidth=width, endAtTail="false",
        endStreamCut='{"0": 1000}',
    )
    third = len(texts) // 3 + 1
    for batch in range(4):
        publish(spark, str(tmp_path / "in"), texts[batch * third:(batch + 1) * third], batch_id=batch)
        run(jobs.stream_to_file(spark, chosen))
    kept = sorted(row.value for row in spark.read.text(str(tmp_path / "out")).collect())
    assert kept == sorted(text for text, keep in rows if keep)


def test_rejects_are_logged_and_written(spark, tmp_path, caplog):
    good = [reading(0, 1), reading(0, 2), reading(1, 1)]
    for batch, texts in enumerate([[*good, good[1], "bad"], [good[0], '{"station": 0}', reading(0, 3)]]):
        publish(spark, str(tmp_path / "in"), texts, batch_id=batch)
    monitored = options(
        tmp_path, keyFieldNames="station", counterFieldName="seq", rejectsOutput=str(tmp_path / "rejects"),
    )
    run(jobs.stream_to_file(spark, monitored))
    out = sorted(row.value for row in spark.read.text(str(tmp_path / "out")).collect())
    assert out == sorted([*good, reading(0, 3)])
    rejects = spark.read.schema("reason string, event string").json(str(tmp_path / "rejects"))
    assert sorted((row.reason, row.event) for row in rejects.select("reason", "event").collect()) == sorted([
        ("duplicate", good[1]), ("bad json", "bad"), ("duplicate", good[0]), ("missing counter", '{"station": 0}'),
    ])
    assert "8 events, 4 kept, 2 duplicates, unusable: {'bad json': 1, 'missing counter': 1}" in caplog.text

    typed = options(
        tmp_path, output=str(tmp_path / "rows"), avroSchema=base64.b64encode(READING.encode()).decode(),
        keyFieldNames="station", counterFieldName="seq", rejectsOutput=str(tmp_path / "typed"),
    )
    run(jobs.stream_to_parquet_file(spark, typed))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4
    rejects = spark.read.schema("reason string, event string").json(str(tmp_path / "typed"))
    counts = {row.reason: row["count"] for row in rejects.groupBy("reason").count().collect()}
    assert counts == {"duplicate": 2, "does not fit the schema": 2}


@pytest.mark.parametrize("job, dedup_on", [("stream-to-parquet-file", True), ("stream-to-csv-file", False), ("stream-to-file", True)])
def test_events_are_parsed_once_a_batch(job, dedup_on, spark, tmp_path, monkeypatch):
    """With rejects and a log of the output as well: one write parses, all else reads what was written."""
    plans = []
    for name in ("parquet", "json", "save"):
        def noted(self, *args, _write=getattr(DataFrameWriter, name), **kwargs):
            plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
            return _write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, name, noted)
    printed = []
    monkeypatch.setattr(jobs, "print_lines", lambda df, prefix="": printed.append(df))
    monkeypatch.setattr(jobs, "print_records", lambda df, prefix="": printed.append(df))
    publish(spark, str(tmp_path / "in"), [reading(0, 1), reading(0, 1), "bad", reading(0, 2)])
    plans.clear()
    keys = {"keyFieldNames": "station", "counterFieldName": "seq"} if dedup_on else {}
    run(jobs.JOBS[job](spark, options(
        tmp_path, avroSchema=base64.b64encode(READING.encode()).decode(), logOutputRecords="true", onError="drop",
        rejectsOutput=str(tmp_path / "rejects"), **keys)))
    plans += [df._jdf.queryExecution().optimizedPlan().toString() for df in printed]
    assert sum("from_json" in plan for plan in plans) == 1 and len(plans) > 3
    assert printed or job == "stream-to-file"
    assert not list((tmp_path / "out" / "_checkpoint" / "batch").glob("*"))
    rejects = spark.read.schema("reason string, event string").json(str(tmp_path / "rejects"))
    assert sorted(row.event for row in rejects.where("reason <> 'duplicate'").collect()) == ["bad"]


def test_end_at_tail_is_fixed_at_first_start(spark, tmp_path):
    path = str(tmp_path / "in")
    publish(spark, path, ["a", "b"])
    run(jobs.stream_to_file(spark, options(tmp_path)))
    publish(spark, path, ["c"], batch_id=1)
    run(jobs.stream_to_file(spark, options(tmp_path)))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_run_waits_for_an_end_cut_ahead_of_the_stream(spark, tmp_path, monkeypatch):
    path, waits = str(tmp_path / "in"), []
    publish(spark, path, ["a", "b"])

    def sleep(seconds):
        waits.append(seconds)
        publish(spark, path, ["c", "d"], batch_id=len(waits))

    monkeypatch.setattr(jobs, "time", SimpleNamespace(sleep=sleep))
    chosen = options(tmp_path, endAtTail="false", endStreamCut='{"0": 5}', checkpointIntervalMs="500")
    jobs.run(spark, "stream-to-file", chosen)
    assert waits == [0.5, 0.5]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a", "b", "c", "c", "d"]


def test_csv_job(spark, tmp_path):
    rows = [reading(0, 1), reading(0, 1, "again"), "bad", reading(0, 2), reading(1, 1)]
    publish(spark, str(tmp_path / "in"), rows)
    chosen = options(
        tmp_path, avroSchema=base64.b64encode(READING.encode()).decode(), keyFieldNames="station",
        counterFieldName="seq", logOutputRecords="true",
    )
    run(jobs.stream_to_csv_file(spark, chosen))
    out = sorted(row.value for row in spark.read.text(str(tmp_path / "out")).collect())
    assert out == ["0,1,x", "0,2,x", "1,1,x"]


def test_csv_job_without_dedup_fails_on_bad_lines(spark, tmp_path):
    publish(spark, str(tmp_path / "in"), [reading(0, 1), "bad"])
    query = jobs.stream_to_csv_file(spark, options(tmp_path, avroSchema=base64.b64encode(READING.encode()).decode()))
    with pytest.raises(Exception, match="cannot decode record"):
        query.awaitTermination()


def test_parquet_job_flattens(spark, tmp_path):
    (tmp_path / "schema.avsc").write_text(TRACE)
    rows = [
        json.dumps({"host": "a", "seq": n, "step": [f"t{n}", f"u{n}"], "load": [0.5, 1.0]}) for n in (1, 1, 2)
    ]
    publish(spark, str(tmp_path / "in"), rows)
    chosen = options(
        tmp_path, avroSchemaFile=str(tmp_path / "schema.avsc"), keyFieldNames="host",
        counterFieldName="seq", flatten="true",
    )
    run(jobs.stream_to_parquet_file(spark, chosen))
    out = spark.read.parquet(str(tmp_path / "out")).select("host", "seq", "step", "load")
    assert sorted(map(tuple, out.collect())) == [
        ("a", 1, "t1", 0.5), ("a", 1, "u1", 1.0), ("a", 2, "t2", 0.5), ("a", 2, "u2", 1.0),
    ]
    files = [p.name for p in (tmp_path / "out").glob("bucket=*/batch=*/part-*")]
    assert files and all(name.endswith(".snappy.parquet") for name in files)


def test_copy_job(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "copy")
    texts = [f'{{"k": {i % 3}, "c": {i // 6}}}' for i in range(30)]
    for batch in range(2):
        publish(
            spark, source, texts[batch * 15:(batch + 1) * 15], batch_id=batch, segments=2,
            routing_key="split_part(line, ',', 1)",
        )
    chosen = Options({
        "input-stream": source, "output-stream": target, "endAtTail": "true", "fixedRoutingKey": "k0",
    })
    run(jobs.stream_to_stream(spark, chosen))
    copied = stream.read_events(spark, target)
    assert sorted(texts_of(copied)) == sorted(texts)
    assert [tuple(r) for r in copied.select("segment", "routing_key").distinct().collect()] == [(0, "k0")]
    for key in range(3):
        mine = [text for text in texts_of(copied) if f'"k": {key}' in text]
        assert mine == [text for text in texts if f'"k": {key}' in text]
    run(jobs.stream_to_stream(spark, chosen))
    assert stream.read_events(spark, target).count() == 30

    deduped = Options(chosen.values | {
        "output-stream": str(tmp_path / "clean"), "keyFieldNames": "k", "counterFieldName": "c",
    })
    run(jobs.stream_to_stream(spark, deduped))
    assert sorted(texts_of(stream.read_events(spark, str(tmp_path / "clean")))) == sorted(set(texts))


def test_offsets_do_not_grow_over_copies(spark, tmp_path):
    hops = [str(tmp_path / name) for name in "abcd"]
    publish(spark, hops[0], [f"e{i}" for i in range(64)], segments=16, routing_key="line")
    for source, target in zip(hops, hops[1:]):
        run(jobs.stream_to_stream(spark, Options({
            "input-stream": source, "output-stream": target, "endAtTail": "true", "output-minNumSegments": "16",
            "checkpointLocation": f"{target}-checkpoint"})))
    assert max(stream.tail_cut(spark, hops[-1]).values()) <= 64
    assert texts_of(stream.read_events(spark, hops[-1])) == [f"e{i}" for i in range(64)]


def test_console_job(spark, tmp_path, monkeypatch):
    printed = []
    monkeypatch.setattr(jobs, "print_lines", lambda df: printed.extend(row.line for row in df.collect()))
    publish(spark, str(tmp_path / "in"), ["hello", "hello", "not json"])
    run(jobs.stream_to_console(spark, Options({"input-stream": str(tmp_path / "in"), "endAtTail": "true"})))
    assert sorted(printed) == ["hello", "hello", "not json"]


def test_generator_job_numbers_go_on_after_a_restart(spark, tmp_path):
    chosen = Options({
        "output-stream": str(tmp_path / "gen"), "eventsPerSec": "50", "numSensors": "2", "dataSizeBytes": "3",
        "checkpointIntervalMs": "500", "output-minNumSegments": "2",
    })
    for _ in range(2):
        query = jobs.sample_data_generator(spark, chosen)
        before = query.lastProgress["batchId"] if query.lastProgress else -1
        while not query.exception() and (not query.lastProgress or query.lastProgress["batchId"] < before + 3):
            query.awaitTermination(1)
        query.stop()
    rows = [json.loads(text) for text in texts_of(stream.read_events(spark, str(tmp_path / "gen")))]
    assert rows and all(row["data"] == "xxx" for row in rows)
    numbers = sorted((row["eventNumber"], row["sensorId"]) for row in rows)
    assert numbers == [(n, s) for n in range(len(rows) // 2) for s in range(2)]


@pytest.mark.parametrize("job", ["stream-to-file", "stream-to-stream"])
def test_crash_between_write_and_commit(job, spark, tmp_path, monkeypatch):
    texts = [f'{{"k": {i % 3}, "c": {i // 6}}}' for i in range(60)]
    for batch in range(3):
        publish(spark, str(tmp_path / "in"), texts[batch * 20:(batch + 1) * 20], batch_id=batch)
    chosen = options(
        tmp_path, keyFieldNames="k", counterFieldName="c", appendsPerBatch="1", splitWidth="5",
        **{"output-stream": str(tmp_path / "out")},
    )
    sink = {"stream-to-file": "write_batch", "stream-to-stream": "append_events"}[job]
    write, calls = getattr(jobs, sink), []

    def crash(*args, **kwargs):
        write(*args, **kwargs)
        calls.append(args)
        if len(calls) in (2, 3):
            raise RuntimeError("planned crash")

    monkeypatch.setattr(jobs, sink, crash)
    for _ in range(2):
        with pytest.raises(Exception, match="planned crash"):
            jobs.JOBS[job](spark, chosen).awaitTermination()
    run(jobs.JOBS[job](spark, chosen))
    assert len(calls) == 5
    if job == "stream-to-file":
        out = [row.value for row in spark.read.text(str(tmp_path / "out")).collect()]
    else:
        out = texts_of(stream.read_events(spark, str(tmp_path / "out")))
    assert sorted(out) == sorted(set(texts))
