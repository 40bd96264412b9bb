"""Run every query against its SQL: `python tests/check_oracles.py [folder] [query ...]`."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from millrace.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark, db, folder, name):
    """None when the results agree, else a short account of how they differ."""
    df = driver.queries()[name](spark, folder)
    got = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    result = db.execute(driver.oracle_sql()[name])
    want = sorted_rows([c[0] for c in result.description], result.fetchall())
    if got == want:
        return None
    if got[0] != want[0] or len(got[1]) != len(want[1]):
        return f"{got[0]} x {len(got[1])} rows against {want[0]} x {len(want[1])}"
    return "; ".join(f"{g} != {w}" for g, w in zip(got[1], want[1]) if g != w)[:400]


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracles", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(folder), 0
    for name in sys.argv[2:] or driver.queries():
        begun = time.time()
        if name not in driver.oracle_sql():
            print(f"{name}: no oracle, {driver.queries()[name](spark, folder).count()} rows")
            continue
        problem = difference(spark, db, folder, name)
        failed += problem is not None
        print(f"{name}: {problem or 'same'} ({time.time() - begun:.1f} s)", flush=True)
    sys.exit(1 if failed else 0)
