import random

import pytest
from scenarios import SCENARIOS

from millrace.operators import dedup


def kept_lines(df):
    return sorted(row.line for row in df.select("line").collect())


@pytest.mark.parametrize("name", SCENARIOS)
@pytest.mark.parametrize("split_width", [2])
def test_scenario(name, split_width, lines, partitions):
    keys, rows = SCENARIOS[name]
    df = lines([text for text, _ in rows])
    counter = "counter" if keys else ""
    kept = dedup.dedup_json(df, keys, counter, "seq", split_width=split_width)
    assert kept_lines(kept) == sorted(text for text, keep in rows if keep)
    assert kept.columns == df.columns
    if keys and partitions == 1:
        dropped = dedup.dedup_json_rejects(df, keys, counter, "seq", split_width=split_width)
        assert kept_lines(dropped) == sorted(text for text, keep in rows if not keep)


def test_reject_reasons(lines):
    df = lines(['{"k":1,"c":1}', '{"k":1,"c":1}', "x", '{"c":1}', '{"k":1}', '{"k":1,"c":"2"}'])
    rejects = dedup.dedup_json_rejects(df, "k", "c", "seq")
    assert {row.seq: row.reason for row in rejects.collect()} == {
        1: "duplicate", 2: "bad json", 3: "missing key", 4: "missing counter", 5: "bad counter",
    }


def expected(rows):
    greatest, kept = {}, []
    for seq, key, counter in sorted(rows):
        if key is None or counter is None:
            continue
        if key not in greatest or counter > greatest[key]:
            greatest[key] = counter
            kept.append(seq)
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_random_records_against_loop(seed, spark):
    rng = random.Random(seed)
    edges = [2**63 - 1, 2**63 - 2, -(2**63), -(2**63) + 1, 2**53, 2**53 + 1, None]
    rows = []
    for i in range(400):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        counter = rng.choice(edges) if seed % 2 else rng.randrange(i + 1)
        rows.append((i * 7 - 900, key, counter))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "seq bigint, key string, counter bigint")
    for width in (None, 1, 50, 1000):
        kept = dedup.dedup_records(df, "key", "counter", "seq", split_width=width)
        assert sorted(row.seq for row in kept.collect()) == expected(rows)


def test_timestamp_order_and_second_order_column(spark):
    df = spark.sql(
        "select timestamp_micros(cast(id div 3 as bigint)) ts, cast(id % 3 as int) part, 1 as key, "
        "cast(hash(id) % 50 as bigint) as counter, id from range(300)"
    )
    rows = [(row.id, row.key, row.counter) for row in df.collect()]
    for width in (None, 10):
        kept = dedup.dedup_records(df, "key", "counter", ["ts", "part"], split_width=width)
        assert sorted(row.id for row in kept.collect()) == expected(rows)


def test_deep_record_keys(spark):
    df = spark.sql(
        "select * from values "
        "(1L, map('a', 1, 'b', 2), array(1.0D), 1L), (2L, map('b', 2, 'a', 1), array(1.0D), 1L), "
        "(3L, map('a', 1), array(1.0D), 1L), (4L, map('a', 1), array(2.0D), 1L), (5L, null, array(2.0D), 1L) "
        "as t(seq, m, d, counter)"
    )
    kept = dedup.dedup_records(df, "m,d", "counter", "seq")
    assert sorted(row.seq for row in kept.collect()) == [1, 3, 4]


def test_bytes_are_left_untouched(spark):
    rows = [(0, b'{"k":"\xff","c":1}'), (1, b'{"k":"\xff","c":1}'), (2, b'\xff\xfe'), (3, b'{"k":"\xff","c":2}')]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in rows], "seq bigint, event binary")
    kept = dedup.dedup_bytes(df, "k", "c", "seq").orderBy("seq").collect()
    assert [bytes(row.event) for row in kept] == [rows[0][1], rows[3][1]]
    passed = dedup.dedup_bytes(df, "k", "", "seq")
    assert sorted(row.seq for row in passed.collect()) == [0, 1, 2, 3]


def test_plan_time_errors(spark, lines):
    df = spark.createDataFrame([(1, "a", 1.5)], "seq bigint, key string, counter double")
    with pytest.raises(ValueError, match="int or long"):
        dedup.dedup_records(df, "key", "counter", "seq")
    with pytest.raises(ValueError, match="no such field"):
        dedup.dedup_records(df, "nope", "seq", "seq")
    with pytest.raises(ValueError, match="order_by"):
        dedup.dedup_json(lines(["{}"]), "k", "c", [])
    with pytest.raises(ValueError, match="integer or a timestamp"):
        dedup.dedup_json(lines(["{}"]), "k", "c", "line")


def test_blank_names_turn_dedup_off(lines):
    df = lines(["x", "x"])
    assert dedup.dedup_json(df, "", "c", "seq") is df
    assert dedup.dedup_json(df, " , ", "c", "seq") is df
    assert dedup.dedup_json(df, "k", " ", "seq") is df


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once(lines):
    kept = dedup.dedup_json(lines(['{"k":1,"c":1}'] * 3), "k", "c", "seq", split_width=2)
    plan = plan_of(kept)
    wide = [text for text in plan.splitlines() if "Exchange hashpartitioning" in text and "line" in text]
    assert len(wide) <= 1
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_lowest_positions_and_marks(spark):
    """Rows without a position come first even beside the smallest positions there are."""
    low = -(2**63)
    rows = [(None, "k", 5), (low, "k", 4), (low + 1, "k", 6), (low + 2, "k", 6), (2**63 - 1, "k", 7)]
    df = spark.createDataFrame(rows, "seq bigint, key string, counter bigint")
    for width in (None, 1, 2):
        kept = dedup.dedup_records(df, "key", "counter", "seq", split_width=width).collect()
        assert sorted(row.counter for row in kept) == [5, 6, 7]


def test_no_key_stays_whole_however_many_are_hot(spark):
    """More hot keys than any list would hold: every bucket has `split_width` rows of a key at the most."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # Spark may send what is small, but need not
    try:
        df = spark.sql("select id as seq, id % 12000 as key, id div 12000 % 3 as counter from range(120000)")
        compared = dedup.with_previous_max(dedup.key_records(df, "key", "counter").usable, ("key",), "seq", 24000)
        rows = compared.where(dedup.ascends())
        assert len(rows.collect()) == 36000
        plan = plan_of(rows).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan and plan.count("Range (") == 1 and plan.count("ReusedExchange") == 1


@pytest.mark.parametrize("columns", [["line"], ["seq", "line", "extra"], ["extra"]])
def test_events_are_read_once(columns, lines):
    """Whatever is taken of the result, both readers find what was dealt."""
    texts = [f'{{"k":{i % 3},"c":{i // 6}}}' for i in range(60)]
    df = lines(texts).repartition(2).selectExpr("line", "seq", "line as extra", "seq as other")
    kept = dedup.dedup_json(df, "k", "c", "seq", split_width=7).select(*columns)
    assert len(kept.collect()) == 30
    plan = plan_of(kept).split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("Scan ExistingRDD") == 1


def test_last_of_repeated_names_counts(lines):
    texts = ['{"k":{"a":1,"a":2},"c":1}', '{"k":{"a":2},"c":1}', '{"k":{"a":1},"c":1}', '{"k":{"a":{"b":1,"b":[3]},"a":{"b":1,"b":[4]}},"c":1}',
             '{"k":{"a":{"b":[4]}},"c":1}', '{"k":5,"k":6,"c":1}', '{"k":6,"c":0,"c":1}', '{"k":6,"c":1,"c":2}']
    kept = dedup.dedup_json(lines(texts), "k", "c", "seq").orderBy("seq").collect()
    assert [row.seq for row in kept] == [0, 2, 3, 5, 7]
    assert dedup.dedup_json_rejects(lines(texts), "k", "c", "seq").where("reason <> 'duplicate'").count() == 0


def test_names_of_the_payload_are_its_own(spark):
    df = spark.sql("select id as seq, 'k' as _key0, id div 2 as _counter, concat('r', id) as _reason, 5 as _hot from range(6)")
    kept = dedup.dedup_records(df, "_key0", "_counter", "seq", split_width=2).orderBy("seq")
    assert [tuple(row) for row in kept.collect()] == [(0, "k", 0, "r0", 5), (2, "k", 1, "r2", 5), (4, "k", 2, "r4", 5)]
    with pytest.raises(ValueError, match="reserved"):
        dedup.dedup_records(df.withColumnRenamed("_hot", dedup.BUCKET), "_key0", "_counter", "seq")
