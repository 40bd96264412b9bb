import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import flatten, flatten_schema, malformed_lines, parse_avro_schema, parse_records
from millrace.functions import render
from millrace.sources.generator import sample_event_lines, sample_events


def record(*fields):
    return json.dumps({
        "type": "record", "name": "R", "namespace": "n", "fields": [{"name": n, "type": t} for n, t in fields],
    })


READING = record(("station", "int"), ("turn", "long"), ("note", "string"))
TRACE = record(
    ("host", "string"),
    ("at", {"type": "array", "items": "long"}),
    *[(name, {"type": "array", "items": "double"}) for name in ("load", "heat")],
)


def test_schema_types():
    schema = parse_avro_schema(record(
        ("b", "boolean"), ("i", "int"), ("l", "long"), ("f", "float"), ("d", "double"), ("s", "string"),
        ("y", "bytes"), ("a", {"type": "array", "items": "string"}), ("m", {"type": "map", "values": "long"}),
        ("r", {"type": "record", "name": "In", "fields": [{"name": "x", "type": ["null", "int"]}]}),
        ("again", "In"), ("e", {"type": "enum", "name": "E", "symbols": ["A", "B"]}),
        ("x", {"type": "fixed", "name": "F", "size": 2}),
        ("ms", {"type": "long", "logicalType": "timestamp-millis"}), ("day", {"type": "int", "logicalType": "date"}),
    ))
    assert schema.data_type.simpleString() == (
        "struct<b:boolean,i:int,l:bigint,f:float,d:double,s:string,y:binary,a:array<string>,m:map<string,bigint>,"
        "r:struct<x:int>,again:struct<x:int>,e:string,x:binary,ms:timestamp,day:date>"
    )


@pytest.mark.parametrize("text", [
    "", '"string"', record(("u", ["int", "string", "int"])), record(("u", ["null"])), record(("u", "Nothing")),
    record(("d", {"type": "bytes", "logicalType": "decimal", "precision": 39})),
    record(("d", {"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 5})), '["null", {"type": "map", "values": "int"}]',
])
def test_schema_errors(text):
    with pytest.raises(ValueError):
        parse_avro_schema(text)


def test_parse_ignores_unknown_members_and_drops_bad_lines(lines):
    good = '{"station":3,"more":[1],"turn":71,"note":"xx"}'
    bad = [
        '{"station":3,"turn":71}',
        '{"station":3,"turn":71,"note":null}',
        '{"station":3,"turn":71,"note":5}',
        '{"station":"3","turn":71,"note":"x"}',
        '{"station":3,"turn":9223372036854775808,"note":"x"}',
        "", "5", "BAD", '{"station":3,',
    ]
    df, schema = lines([good, *bad]), parse_avro_schema(READING)
    parsed = parse_records(df, schema, on_error="drop", keep=("seq",))
    assert [tuple(r) for r in parsed.collect()] == [(0, 3, 71, "xx")]
    assert parsed.drop("seq").schema == schema.data_type
    assert {r.line for r in malformed_lines(df, schema).collect()} == set(bad)
    for text in bad:
        with pytest.raises(PySparkException, match="cannot decode record"):
            parse_records(lines([text]), schema).collect()
    assert parse_records(lines([good]), schema).first().note == "xx"


def test_parse_nested_types(lines):
    schema = parse_avro_schema(record(
        ("u", ["null", "string"]), ("y", "bytes"), ("a", {"type": "array", "items": ["null", "long"]}),
        ("m", {"type": "map", "values": "string"}), ("e", {"type": "enum", "name": "E", "symbols": ["A", "B"]}),
        ("ts", {"type": "long", "logicalType": "timestamp-millis"}),
        ("r", {"type": "record", "name": "In", "fields": [{"name": "x", "type": "string"}]}),
    ))
    good = {
        "u": {"string": "x"}, "y": "ÿ\u0001", "a": [{"long": 1}, None], "m": {"k": "v"}, "e": "B", "ts": 1500,
        "r": {"x": "in"},
    }
    bad = [
        {**good, "u": "x"}, {**good, "u": {"long": 5}}, {**good, "y": "Ā"}, {**good, "a": [{"string": "1"}]},
        {**good, "m": {"k": 1}}, {**good, "e": "C"}, {**good, "r": {"x": 1}}, {**good, "r": {}},
    ]
    texts = [json.dumps(value) for value in [good, {**good, "u": None}, *bad]]
    rows = parse_records(lines(texts), schema, on_error="drop").collect()
    assert [row.u for row in rows] == ["x", None]
    assert bytes(rows[0].y) == b"\xff\x01" and rows[0].a == [1, None] and rows[0].m == {"k": "v"}
    assert rows[0].e == "B" and rows[0].r.x == "in"
    assert rows[0].ts.timestamp() == 1.5


def decimal_bytes(number, size):
    return number.to_bytes(size, "big", signed=True).decode("latin-1")


def test_decimals(lines):
    top = 10**38 - 1
    money = {"type": "bytes", "logicalType": "decimal", "precision": 38, "scale": 2}
    fixed = {"type": "fixed", "name": "F", "size": 20, "logicalType": "decimal", "precision": 5}
    schema = parse_avro_schema(record(("m", money), ("f", fixed), ("plain", {"type": "bytes", "logicalType": "decimal"})))
    assert schema.data_type.simpleString() == "struct<m:decimal(38,2),f:decimal(5,0),plain:binary>"
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 2**63, -(2**63), 2**64 - 1, 2**64, -(2**64), 2**96 + 5, -(2**96) - 5, top, -top]
    rows = [(n, size, (n % 99999) * (-1) ** (n % 2)) for n in numbers for size in (1, 2, 8, 9, 13, 16, 17, 24)
            if -(2 ** (8 * size - 1)) <= n < 2 ** (8 * size - 1)]
    texts = [json.dumps({"m": decimal_bytes(n, size), "f": decimal_bytes(f, 20), "plain": "a"}) for n, size, f in rows]
    found = parse_records(lines(texts), schema).collect()
    assert [(int(str(row.m).replace(".", "")), int(row.f)) for row in found] == [(n, f) for n, _, f in rows]
    bad = [{"m": m, "f": f, "plain": ""} for m, f in [
        ("", decimal_bytes(1, 20)), (decimal_bytes(top + 1, 16), decimal_bytes(1, 20)), (decimal_bytes(-top - 1, 17), decimal_bytes(1, 20)),
        (decimal_bytes(2**127, 17), decimal_bytes(1, 20)), ("\u0100", decimal_bytes(1, 20)), ("a", "a"), ("a", decimal_bytes(100000, 20)), (5, "a")]]
    assert parse_records(lines([json.dumps(b) for b in bad]), schema, on_error="drop").count() == 0


def test_unions(lines):
    inner = {"type": "record", "name": "In", "fields": [{"name": "x", "type": ["int", "string"]}]}
    schema = parse_avro_schema(record(
        ("u", ["null", "int", "string"]), ("v", [inner, {"type": "array", "items": ["null", "long", "double"]}]), ("one", ["string"])))
    assert schema.data_type.simpleString() == (
        "struct<u:struct<member0:int,member1:string>,v:struct<member0:struct<x:struct<member0:int,member1:string>>,"
        "member1:array<struct<member0:bigint,member1:double>>>,one:struct<member0:string>>")
    good = {"u": {"int": 5}, "v": {"n.In": {"x": {"string": "s"}}}, "one": {"string": "o"}}
    more = {"u": None, "v": {"array": [None, {"long": 3}, {"double": 2.5}]}, "one": {"string": ""}}
    bad = [{**good, **change} for change in (
        {"u": {"long": 5}}, {"u": {}}, {"u": 5}, {"u": {"int": 5, "string": "x"}}, {"u": {"int": "5"}}, {"v": None},
        {"v": {"n.In": {"x": None}}}, {"v": {"array": [{"int": 1}]}}, {"one": "o"})]
    texts = [json.dumps(v) for v in (good, more, *bad)]
    rows = parse_records(lines(texts), schema, on_error="drop").collect()
    assert rows[0].asDict(True) == {
        "u": {"member0": 5, "member1": None}, "v": {"member0": {"x": {"member0": None, "member1": "s"}}, "member1": None},
        "one": {"member0": "o"}}
    assert rows[1].u is None and rows[1].v.asDict(True) == {"member0": None, "member1": [
        None, {"member0": 3, "member1": None}, {"member0": None, "member1": 2.5}]}
    assert len(rows) == 2
    parsed = parse_records(lines(texts[:2]), schema)
    assert sorted(row[0] for row in parsed.select(render.csv_line(parsed, null_value="-")).collect()) == [
        "-,[null, 3, 2.5],", '5,{"x": "s"},o']


def test_fields_may_have_any_name(lines):
    """Names that the operator once used for itself, and those of the text and of kept columns in other letters."""
    names = ["_good", "_ok", "_wire", "_corrupt_text", "_corrupt_record", "line", "Line", "SEQ", "value"]
    schema = parse_avro_schema(record(*[(name, "long") for name in names]))
    texts = [json.dumps({name: i for i, name in enumerate(names)}), "bad"]
    want = list(range(len(names)))
    for on_error in ("drop", "fail"):
        rows = parse_records(lines(texts if on_error == "drop" else texts[:1]), schema, on_error=on_error, keep=("seq",)).collect()
        assert [tuple(row) for row in rows] == [(0, *want)]
    kept = lines(texts).withColumnsRenamed({"seq": "_ok"}).selectExpr("line", "_ok", "_ok as _good", "_ok as _wire")
    small = parse_avro_schema(record(("value", "long")))
    assert [tuple(r) for r in parse_records(kept, small, on_error="drop", keep=("_ok", "_good", "_wire")).collect()] == [(0, 0, 0, 8)]
    assert [row.line for row in malformed_lines(kept, small).collect()] == ["bad"]
    with pytest.raises(ValueError, match="clash"):
        parse_records(lines(texts), schema, on_error="drop", keep=("line",))


def test_parse_reads_each_line_once(lines):
    parsed = parse_records(lines(["{}"]), parse_avro_schema(READING), on_error="drop")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 1 and "Python" not in plan


def test_flatten_pairs_elements(lines):
    text = '{"host":"h7","at":[5,9],"load":[0.25,-1.5],"heat":[30.0,31.5]}'
    flat = flatten(parse_records(lines([text]), parse_avro_schema(TRACE)))
    assert [tuple(row) for row in flat.collect()] == [("h7", 5, 0.25, 30.0), ("h7", 9, -1.5, 31.5)]
    assert flat.schema == flatten_schema(parse_avro_schema(TRACE).data_type)


@pytest.mark.parametrize("names", [("__millrace_element0", "x"), ("_element0", "_counter")])
def test_flatten_leaves_odd_names_alone(names, spark):
    df = spark.createDataFrame([("k", [1, 2], [3, 4])], f"_reason string, {names[0]} array<int>, {names[1]} array<int>")
    assert [tuple(row) for row in flatten(df).collect()] == [("k", 1, 3), ("k", 2, 4)]


def test_flatten_lengths(spark):
    df = spark.sql(
        "select * from values (1, array(1,2), array('a','b')), (2, array(1), array('a','b')), (3, array(), array()), "
        "(4, null, array('a')), (5, array(1,2), null), (6, array(1,2), array('a')) as t(id, n, `odd.name`)"
    )
    kept = flatten(df, on_mismatch="drop")
    assert kept.columns == ["id", "n", "odd.name"]
    assert sorted(tuple(row) for row in kept.collect()) == [(1, 1, "a"), (1, 2, "b")]
    for bad in (2, 5, 6):
        with pytest.raises(PySparkException, match="differ in length"):
            flatten(df.where(F.col("id") == bad)).collect()
    assert flatten(df.where("id in (3, 4)")).collect() == []
    with pytest.raises(ValueError, match="at least one array"):
        flatten(df.select("id"))
    assert flatten(df.where("id = 1"), keep=("odd.name",)).first()["odd.name"] == ["a", "b"]
    nested = spark.sql("select map('k', 1) as m, array(array(1, 2), array(3)) as a")
    assert [row.a for row in flatten(nested).collect()] == [[1, 2], [3]]


def test_csv_lines(spark):
    df = spark.sql("select 1 as a, 'x,\"y' as b, 1e10D as c, array(1, 2) as d, true as e, map('k', 1) as f")
    assert df.select(render.csv_line(df)).first()[0] == '1,x,"y,1.0E10,[1, 2],true,{"k":1}'
    assert df.select(render.csv_line(df, quote=True)).first()[0] == (
        '1,"x,""y",1.0E10,"[1, 2]",true,"{""k"":1}"'
    )
    nulls = spark.sql("select 1 as a, cast(null as string) as b, 2 as c")
    assert nulls.select(render.csv_line(nulls, null_value="")).first()[0] == "1,,2"
    with pytest.raises(PySparkException, match="is null"):
        nulls.select(render.csv_line(nulls)).collect()


def test_nested_csv_text(spark):
    df = spark.sql("""select named_struct('a', 1, 'b', 'x"\\\\y', 'c', cast(null as int), 'd', double('NaN'), 'e', 0.5F) as r,
        array(named_struct('k', array('p', null)), null) as l, array(map('m', array(1L, null))) as m, array(array(1, 2), array()) as n,
        array('p', null) as plain, X'41FF' as bytes, named_struct('bytes', X'0A22FF', 't', 'a\u2028b') as q,
        named_struct('in', map('z', named_struct('member0', cast(null as int), 'member1', 'u'))) as u""")
    text = df.select(render.csv_line(df)).first()[0]
    assert text == (
        '{"a": 1, "b": "x\\"\\\\y", "c": null, "d": "NaN", "e": 0.5},[{"k": ["p", null]}, null],[{"m": [1, null]}],[[1, 2], []],'
        '[p, null],A\xff,{"bytes": "\\n\\"\xff", "t": "a\\u2028b"},{"in": {"z": "u"}}')
    nothing = spark.sql("select cast(null as struct<a:int>) as r, 1 as x")
    assert nothing.select(render.csv_line(nothing, null_value="?")).first()[0] == "?,1"


def test_text_and_time(spark):
    raw = spark.createDataFrame([(bytearray(b"a\xffb"),)], "event binary")
    assert raw.select(render.utf8_text(F.col("event"))).first()[0] == "a�b"
    times = spark.sql("select explode(array(timestamp'2021-11-30 07:05:09.206', timestamp'2021-11-30 07:05:09', "
                      "timestamp'2021-11-30 07:05:09.200')) as ts")
    assert [row[0] for row in times.select(render.timestamp_text(F.col("ts"))).collect()] == [
        "2021-11-30 07:05:09.206", "2021-11-30 07:05:09.0", "2021-11-30 07:05:09.2",
    ]
    assert times.select(render.hour_bucket(F.col("ts"))).first()[0] == "2021-11-30--07"


def test_sample_events(spark):
    numbers = spark.sql("select 9L as eventNumber, timestamp_millis(1638255909206) as timestamp")
    rows = sample_event_lines(sample_events(numbers, sensors=2, data_size=5)).orderBy("sensorId").collect()
    assert [row.line for row in rows] == [
        f'{{"sensorId":{i},"eventNumber":9,"timestamp":1638255909206,'
        '"timestampStr":"2021-11-30 07:05:09.206","data":"xxxxx"}'
        for i in range(2)
    ]
    assert sample_events(numbers, sensors=0).count() == 0
    assert rows[0].eventNumber == 9
