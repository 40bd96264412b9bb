import math
import random
import re
from collections import Counter

import duckdb
from odd import ODD

from millrace.llm import search
from millrace.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(CAPITALS))


def brute(docs, items, most=10):
    """(item_id, rank, doc_id, score), every item against every document."""
    found = [(doc, Counter(terms(text))) for doc, text in docs]
    n, total = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in {*items}:
        scored = []
        for doc, counts in found:
            m = 25 + 75 * sum(counts.values()) * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in terms(text) if counts[t])
            scored.append((-score, doc is None, doc or 0))
        out += [(item, rank + 1, None if missing else doc, -s) for rank, (s, missing, doc) in enumerate(sorted(scored)[:most]) if s < 0]
    return sorted(out, key=str)


def got(docs, benchmark):
    return sorted(map(tuple, search.ranked(docs, benchmark).collect()), key=str)


def test_against_every_pair(spark, documents, monkeypatch):
    """Small graphs and blocks, so that items and documents fall into several of them."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Éa", "éa", "日本", "A1", "a1"]
    text = lambda n: rng.choice([" ", ", ", "_"]).join(words[int(len(words) * rng.random() ** 2)] for _ in range(n))
    texts = [(i, text(rng.randrange(60))) for i in range(150)] + [(None, "w1 w2 w3")] * 3 + [(7, "w1 w2 w3")] * 2 + [*enumerate(ODD)]
    items = [(i, text(rng.randrange(1, 30))) for i in range(60)] + [(60, None), (61, "?"), (62, "nowhere"), (63, "same text w1")] * 2
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(search, "GRAPH_ITEMS", 25)
    monkeypatch.setattr(search, "MINED", 9)
    monkeypatch.setattr(search, "BLOCK", 16)
    assert got(documents(texts), benchmark) == brute(texts, items)
    assert got(documents([]), benchmark) == [] == got(documents(texts), benchmark.limit(0))
    assert got(documents([None, ""]), benchmark) == []


def test_items_keep_their_sums_and_share_them():
    rng = random.Random(5)
    items = [(i, Counter(int(30 * rng.random() ** 2) for _ in range(rng.randrange(1, 25)))) for i in range(80)]
    graph = search.shared_sums(items)
    value = [n * 7 ** (t % 5) + t for t, n in graph.leaves]
    sums = list(value)
    for a, b in graph.nodes:
        sums.append(sums[a] + sums[b])
    own = dict(zip(graph.leaves, value))
    assert [(number, sum(sums[r] for r in rows)) for number, rows in graph.items] == [
        (number, sum(own[leaf] for leaf in c.items())) for number, c in items]
    # Adding along the graph takes fewer additions than adding each item alone.
    shared = len(graph.nodes) + sum(len(rows) - 1 for _, rows in graph.items)
    assert graph.nodes and shared < 0.8 * sum(len(c) - 1 for _, c in items)
    pairs = Counter(p for _, rows in graph.items for p in {(min(a, b), max(a, b)) for a in rows for b in rows if a != b})
    assert max(pairs.values()) == 1


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    own = duckdb.connect()
    for name in ("documents", "benchmark"):
        own.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    assert sorted(map(tuple, QUERIES["op13_ranked_search"](spark, folder).collect())) == sorted(own.sql(search.ranked_sql()).fetchall())
