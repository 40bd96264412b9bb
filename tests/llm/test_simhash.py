import random

import xxhash
from odd import ODD
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import connected


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [words[i:i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] if words else []
    hashes = [xxhash.xxh64(b" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows):
    """rows: (doc_id, fingerprint). The smallest doc_id each row can reach over links of 2 or fewer bits."""
    prints = {f for _, f in rows}
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for doc, f in rows:
        if doc is not None:
            least[find(f)] = min(doc, least.get(find(f), doc))
    return [least.get(find(f)) for _, f in rows]


def test_corpus(corpus, texts):
    rows = {row.doc_id: row for row in simhash.near_duplicates(corpus).collect()}
    prints = [(doc, brute_fingerprint(text)) for doc, text in texts.items()]
    for (doc, value), component in zip(prints, brute_components(prints)):
        assert (rows[doc].fingerprint, rows[doc].component_id) == (f"{value:016x}", component)


def test_odd_texts(documents):
    rows = simhash.near_duplicates(documents([*ODD, (None, "same text here"), (None, "alone here")])).collect()
    found = {row.doc_id: row for row in rows if row.doc_id is not None}
    assert len(rows) == len(ODD) + 2
    for doc, text in enumerate(ODD):
        assert found[doc].fingerprint == f"{brute_fingerprint(text):016x}"
    assert [found[i].component_id for i in (0, 1, 2)] == [0, 0, 0] and found[7].component_id == 6
    assert sorted(str(row.component_id) for row in rows if row.doc_id is None) == ["6", "None"]
    assert simhash.near_duplicates(documents([])).count() == 0


def test_links_lose_nothing_in_large_buckets(spark, monkeypatch):
    """Fingerprints that crowd around a few centres, with buckets beyond the limit for pairs."""
    monkeypatch.setattr(simhash, "PAIRWISE", 4)
    rng, prints = random.Random(5), set()
    for centre in (0, (1 << 64) - 1, rng.getrandbits(64)):
        for _ in range(120):
            value = centre
            for _ in range(rng.randrange(6)):
                value ^= 1 << rng.choice([rng.randrange(64), rng.randrange(4), 33])
            prints.add(value)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    rows = [(doc, value) for doc, value in enumerate(sorted(prints, key=lambda v: rng.random()))]
    signed = [(doc, value - (1 << 64) if value >> 63 else value) for doc, value in rows]
    found = {row.fp: row.component_id for row in simhash.classes(spark.createDataFrame(signed, "doc_id bigint, fp bigint")).collect()}
    assert [found[f] for _, f in signed] == brute_components(rows)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    found = {row.node: row.root for row in connected(links).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_one_of_each(documents):
    docs = documents(["the same words in here", "the same words in here", "other words stand in this one", None, "", (9, "x y z"), (9, "x y z"),
                      (None, "q r s"), (None, "q r s"), (2, "the same words in here")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(row.doc_id), row.text) for row in kept.collect()) == [
        ("0", "the same words in here"), ("2", "other words stand in this one"), ("3", None), ("9", "x y z"), ("None", "q r s")]


def test_one_of_each_component_without_ids(documents, monkeypatch):
    """Fingerprints 1 and 2 bits apart, and two apart only over a third one."""
    prints = {"a": 0, "b": 1, "c": 3 << 10, "d": 7 << 10, "e": 31 << 10, "f": 255 << 40, "g": 255 << 40 | 3, "h": 255 << 20}
    frame = documents([(None, text) for text in "abcdefgh"] + [(4, "h")])
    as_frame = lambda docs, *passed: docs.select(
        *passed, F.element_at(F.create_map(*[F.lit(x) for pair in prints.items() for x in pair]), F.col("text")).cast("bigint").alias("fp"))
    monkeypatch.setattr(simhash, "fingerprints", as_frame)
    kept = sorted((str(row.doc_id), row.text) for row in simhash.one_of_each(frame).collect())
    groups = [{"a", "b", "c", "d", "e"}, {"f", "g"}]
    assert ("4", "h") in kept and len(kept) == 3
    assert all(sum(text in group for doc, text in kept if doc == "None") == 1 for group in groups)
