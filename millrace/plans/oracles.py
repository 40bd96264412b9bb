"""The same results as `catalog` in plain SQL over the same tables."""

from __future__ import annotations

COUNTED = "(SELECT *, CAST(floor(value) AS BIGINT) AS counter FROM events)"
LINE = (
    """'{"user_id":' || user_id || ',"event_type":"' || event_type || '","counter":' || counter """
    """|| ',"event_id":' || event_id || '}'"""
)
LINES = f"(SELECT *, {LINE} AS line FROM {COUNTED} c)"

TRUNCATED = "left(line, length(line) - 1)"
RENAMED = """replace(line, '"user_id"', '"user"')"""
QUOTED = """replace(line, '"counter":' || counter || ',', '"counter":"' || counter || '",')"""
FLAWED = f"""(SELECT event_id, user_id, event_type, counter,
    CASE WHEN event_id % 17 = 0 THEN {TRUNCATED} WHEN event_id % 19 = 0 THEN {RENAMED}
         WHEN event_id % 23 = 0 THEN {QUOTED} ELSE line END AS line,
    CASE WHEN event_id % 17 = 0 THEN 'bad json' WHEN event_id % 19 = 0 THEN 'missing key'
         WHEN event_id % 23 = 0 THEN 'bad counter' END AS flaw
    FROM {LINES} l)"""

RENDERED_SECONDS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def ascending(rows: str, key: str | None, columns: str, order: str = "event_id", where: str = "TRUE") -> str:
    partition = f"PARTITION BY {key} " if key else ""
    return f"""SELECT {columns} FROM (
        SELECT *, max(counter) OVER ({partition}ORDER BY {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
        FROM (SELECT * FROM {rows} r WHERE {where}) usable) compared
        WHERE previous IS NULL OR counter > previous"""


def fraction(digits: str) -> str:
    """Digits after the point, without trailing zeros but at least one."""
    return f"CASE WHEN rtrim({digits}, '0') = '' THEN '0' ELSE rtrim({digits}, '0') END"


OBJECT_LINE = """'{"source":{' || CASE WHEN event_id % 2 = 0
    THEN '"user":' || user_id || ',"type":"' || event_type || '"'
    ELSE '"type":"' || event_type || '", "user":' || user_id END || '},"counter":' || counter || '}'"""

KEY_FORMS = """['1', '1.0', '1e0', '"1"', 'null', 'true', '[1,2]', '[2,1]', '{"a":1,"b":[2]}', '{"b":[2],"a":1}',
    '[1,1.0]', '[1.0,1]', '{"a":[1,2.5]}', '{"a":[1.0,2.5]}']"""
KEY_LINE = f"""'{{"key":' || {KEY_FORMS}[event_id % 14 + 1] || ',"counter":' || counter || '}}'"""
# 1.0 and 1e0 are one key, and so are the two objects.
KEY_CLASS = "CASE event_id % 14 WHEN 2 THEN 1 WHEN 9 THEN 8 ELSE event_id % 14 END"

CSV_TEXT = """CASE WHEN regexp_matches(text, '[",\\r\\n]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END"""

NUMBER = """CASE event_id % 4 WHEN 0 THEN event_id::HUGEINT WHEN 1 THEN -(event_id::HUGEINT)
    WHEN 2 THEN 99999999999999999999999999999999999999::HUGEINT - event_id
    ELSE event_id - 99999999999999999999999999999999999999::HUGEINT END"""
NATION = "coalesce(CAST(c_nationkey AS VARCHAR), 'null')"

MILLIS = "lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0')"
MICROS = "lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0')"

ORACLES = {
    "dedup_json": ascending(LINES, "user_id", "event_id, line"),
    "dedup_composite": ascending(LINES, "user_id, event_type", "event_id, line"),
    "dedup_object_key": ascending(COUNTED, "user_id, event_type", f"event_id, {OBJECT_LINE} AS line"),
    "dedup_key_types": ascending(COUNTED, KEY_CLASS, f"event_id, {KEY_LINE} AS line"),
    "dedup_bytes": ascending(LINES, "user_id", "event_id, line"),
    "dedup_record": ascending(COUNTED, "user_id", "event_id, user_id, event_type, counter"),
    "dedup_malformed": ascending(FLAWED, "user_id", "event_id, line", where="flaw IS NULL"),
    "dedup_rejects": f"""SELECT event_id, line, 'duplicate' AS reason FROM (
        SELECT *, max(counter) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
        FROM (SELECT * FROM {FLAWED} r WHERE flaw IS NULL) usable) compared WHERE counter <= previous
        UNION ALL SELECT event_id, line, flaw AS reason FROM {FLAWED} r WHERE flaw IS NOT NULL""",
    "dedup_passthrough": f"SELECT event_id, line FROM {FLAWED} r",
    "dedup_hot_key": ascending(COUNTED, None, "event_id, counter, 'all' AS key"),
    "dedup_hot_third": ascending(
        f"(SELECT event_id, counter, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS key FROM {COUNTED} c)",
        "key", "event_id, key, counter",
    ),
    "dedup_stream": ascending(LINES, "user_id", "line"),
    "dedup_stream_hot": ascending(
        f"(SELECT event_id, counter, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS key FROM {COUNTED} c)",
        "key", """'{"event_id":' || event_id || ',"key":' || key || ',"counter":' || counter || '}' AS line""",
    ),
    "dedup_stateful": ascending(LINES, "user_id", "line"),
    "parse_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "parse_drop": f"""SELECT event_id AS position, user_id, event_type, counter, event_id
        FROM {FLAWED} r WHERE flaw IS NULL""",
    "parse_malformed": f"SELECT event_id, line FROM {FLAWED} r WHERE flaw IS NOT NULL",
    "parse_optional": "SELECT conv_id AS id, CASE WHEN turn <> 0 THEN text END AS note FROM conversations",
    "parse_decimals": f"""SELECT event_id AS id, CASE WHEN n < 0 THEN '-' ELSE '' END || (abs(n) // 10000) || '.'
        || lpad(CAST(abs(n) % 10000 AS VARCHAR), 4, '0') AS amount FROM (SELECT event_id, {NUMBER} AS n FROM events) e""",
    "parse_unions": """SELECT conv_id AS id, CASE WHEN turn % 3 = 1 THEN CAST(turn AS INTEGER) END AS number,
        CASE WHEN turn % 3 = 2 THEN text END AS text FROM conversations""",
    "csv_nested": f"""SELECT c_custkey, c_custkey || ',[{{"nation": ' || {NATION} || ', "name": "' || c_name
        || '"}}, {{"nation": null, "name": "' || c_mktsegment || '"}}],[{{"k": ' || {NATION} || '}}],{{"raw": "' || c_mktsegment
        || '", "tags": ["' || c_name || '", null], "good": true}}' AS line FROM customer""",
    "utf8_invalid": "SELECT doc_id, source || chr(65533) || lang || chr(65533) AS text FROM documents "
                    "WHERE source IS NOT NULL AND lang IS NOT NULL",
    "dedup_repeated_names": ascending(
        COUNTED, "user_id",
        """event_id, '{"source":{"user":0,"kind":7,"user":' || user_id || '},"counter":' || counter || '}' AS line"""),
    "dedup_parallelism": ascending(
        COUNTED, "user_id", "user_id || ',' || event_type || ',' || counter || ',' || event_id AS line"),
    "rolled_files": """SELECT batch, count(*) AS lines FROM (
        SELECT CAST(len(list_filter([1, 2, 3], lambda k: event_id >= (size * k) // 4)) AS BIGINT) AS batch
        FROM events, (SELECT max(event_id) + 1 AS size FROM events)) b GROUP BY batch""",
    "console_lines": f"SELECT line FROM {LINES} l",
    "output_log": """SELECT 'output> {"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
        || event_type || '"}' AS line FROM events""",
    "flatten_arrays": """SELECT l_orderkey AS orderkey, CAST(l_linenumber // 8 AS BIGINT) AS part,
        l_linenumber AS linenumber, l_suppkey AS suppkey, l_extendedprice AS price FROM lineitem""",
    "flatten_embeddings": """SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS position, label,
        CAST(unnest(embedding) AS DOUBLE) AS embedding FROM embeddings""",
    "csv_lines": """SELECT c_custkey, c_custkey || ',' || coalesce(c_name, '') || ','
        || coalesce(CAST(c_nationkey AS VARCHAR), '') || ',' || coalesce(CAST(c_acctbal AS VARCHAR), '') || ','
        || coalesce(c_mktsegment, '') AS line FROM customer""",
    "csv_quoted": f"SELECT doc_id, doc_id || ',' || coalesce(lang, '') || ',' || coalesce({CSV_TEXT}, '') AS line "
                  "FROM documents",
    "json_lines": """SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
        || event_type || '","ts":' || (epoch_us(ts) // 1000) || '}' AS line FROM events""",
    "timestamp_texts": f"SELECT event_id, {RENDERED_SECONDS} || '.' || {fraction(MICROS)} AS ts_text FROM events",
    "utf8_round_trip": "SELECT doc_id, text FROM documents",
    "hour_buckets": "SELECT event_id, strftime(ts, '%Y-%m-%d--%H') AS bucket FROM events",
    "read_range": """SELECT segment, "offset" FROM (
        SELECT CAST(user_id % 4 AS INTEGER) AS segment, event_id AS "offset" FROM events) e
        WHERE (segment = 0 AND "offset" >= 100 AND "offset" < 9000)
           OR (segment = 1 AND "offset" >= 2000 AND "offset" < 5000)
           OR (segment = 2 AND "offset" >= 50 AND "offset" < 1000000000)
           OR (segment = 3 AND "offset" < 700)""",
    "stream_info": """SELECT CAST(user_id % 4 AS INTEGER) AS segment, min(event_id) AS head,
        max(event_id) + 1 AS tail FROM events GROUP BY 1""",
    "text_scan": "SELECT doc_id - (SELECT min(doc_id) FROM documents) AS doc_id, text AS line FROM documents",
    "binary_scan": "SELECT doc_id - (SELECT min(doc_id) FROM documents) AS doc_id, sha256(text) AS digest "
                   "FROM documents",
    "read_from_tail": f"SELECT line FROM {LINES} l WHERE event_id > (SELECT max(event_id) // 2 FROM events)",
    "stream_copy": f"SELECT 'copied' AS routing_key, line FROM {LINES} l",
    "route_events": """SELECT CAST(user_id AS VARCHAR) AS routing_key, count(*) AS events,
        CAST(1 AS BIGINT) AS segments FROM events GROUP BY user_id""",
    "writers_take_turns": f"""SELECT line, event_id AS "offset" FROM {LINES} l
        WHERE event_id >= (SELECT (max(event_id) + 1) * 2 // 6 FROM events)""",
    "generate_events": f"""SELECT CAST(s.sensor AS INTEGER) AS "sensorId", event_id AS "eventNumber",
        '{{"sensorId":' || s.sensor || ',"eventNumber":' || event_id || ',"timestamp":' || (epoch_us(ts) // 1000)
        || ',"timestampStr":"' || {RENDERED_SECONDS} || '.' || {fraction(MILLIS)}
        || '","data":"xxxxxxxxxx"}}' AS line FROM events, (SELECT unnest(range(3)) AS sensor) s""",
    "csv_job": ascending(
        FLAWED, "user_id, event_type", "user_id || ',' || event_type || ',' || counter || ',' || event_id AS line",
        where="flaw IS NULL",
    ),
    "parquet_job": """SELECT l_orderkey AS orderkey, CAST(l_linenumber // 8 AS BIGINT) AS part,
        l_linenumber AS linenumber, l_suppkey AS suppkey, l_extendedprice AS price FROM lineitem""",
}
