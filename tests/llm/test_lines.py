import re

import pytest
from odd import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import line_dedup
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(60))


def n_words(line):
    return len([w for w in re.split("[\\x20\\x09-\\x0d]+", line) if w])


def shortest_runs(lines):
    """From each line that is not blank, the shortest run of lines with over 50 words: first and last, from 1."""
    n = [*map(n_words, lines)]
    for i in range(len(lines)):
        last = next((j for j in range(i, len(lines)) if sum(n[i:j + 1]) > 50), None)
        if n[i] and last is not None:
            yield i + 1, last + 1


def chunks_of(lines, cut):
    """First and last line of every chunk that counts; `cut` says where the rolling hash is 0."""
    n, found, begin = [*map(n_words, lines)], set(shortest_runs(lines)), 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or n[i] > 50 or n[i + 1] > 50 or cut[i] and (i == 0 or not cut[i - 1]):
            if (i > begin or n[i] > 50) and any(n[begin:i + 1]):
                found.add((begin + 1, i + 1))
            begin = i + 1
    return sorted(found)


def brute(spark, docs):
    """What is left of each (doc_id, text), in order of doc_id; only the rolling hashes come from Spark."""
    split = {doc: (text or "").split("\n") for doc, text in docs}
    pairs = sorted({(i > 0, lines[i - 1] if i else "", line) for lines in split.values() for i, line in enumerate(lines)})
    frame = spark.createDataFrame(pairs, "inside boolean, a string, b string").select(
        "*", F.expr(f"pmod(xxhash64(if(inside, xxhash64(a), null), xxhash64(b)), {line_dedup.EVERY}) = 0").alias("cut"))
    cut = {(row.inside, row.a, row.b): row.cut for row in frame.collect()}
    first, left, found = {}, {}, {}
    for doc, lines in sorted(split.items()):
        found[doc] = chunks_of(lines, [cut[i > 0, lines[i - 1] if i else "", line] for i, line in enumerate(lines)])
        for a, b in found[doc]:
            first.setdefault("\n".join(lines[a - 1:b]), (doc, b))
    for doc, lines in split.items():
        gone = set()
        for a, b in found[doc]:
            place = first["\n".join(lines[a - 1:b])]
            if place[0] != doc or a > place[1]:
                gone |= {*range(a, b + 1)}
        left[doc] = "\n".join(x for i, x in enumerate(lines) if i + 1 not in gone)
    return left


@pytest.mark.parametrize("bound", [line_dedup.BROADCAST_ROWS, 0])
def test_corpus(spark, corpus, texts, monkeypatch, bound):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", bound)
    left = {row.doc_id: row.text or "" for row in line_dedup.cleaned(corpus).collect()}
    assert left == brute(spark, list(texts.items()))
    assert any(left[doc] != text for doc, text in texts.items())
    for row in line_dedup.summary(corpus).collect():
        lines = texts[row.doc_id].split("\n")
        gone = {n for part in row.removed.split(",") if part for n in range(int(part.split("-")[0]), int(part.split("-")[1]) + 1)}
        assert (row.n_lines, row.n_removed) == (len(lines), len(gone))
        assert "\n".join(x for i, x in enumerate(lines) if i + 1 not in gone) == left[row.doc_id]


def test_shifted_passages_go_and_the_rest_stays(spark, documents):
    block = [f"line {i} of the block" for i in range(12)]
    tabs = "\t".join(f"v{i}" for i in range(60))
    docs = ["\n".join(["first", *block, "end"]), "\n".join(["a", "b", "c", *block]), f"x\n{LONG}\ny", f"{LONG}\nz", f"{tabs}\nq", f"r\n{tabs}",
            "\n".join(["same old words"] * 60), *ODD]
    frame = documents(docs)
    cleaned = line_dedup.cleaned(frame)
    assert cleaned.columns == frame.columns and cleaned.schema == frame.schema
    rows = {row.doc_id: row for row in cleaned.collect()}
    assert {doc: row.text or "" for doc, row in rows.items()} == brute(spark, list(enumerate(docs)))
    assert rows[0].text == docs[0] and rows[1].text == "a\nb\nc" and rows[2].text == docs[2] and rows[3].text == "z"
    assert rows[4].text == docs[4] and rows[5].text == "r" and rows[7].text is None
    assert {*rows[6].text.split("\n")} == {"same old words"}
    assert all(row.n_chars == (None if row.text is None else len(row.text)) for row in rows.values())


def test_repeated_rows_and_ids(documents):
    text = "\n".join(f"line {i} here" for i in range(9))
    rows = line_dedup.cleaned(documents([(1, text), (1, text), (None, text)])).collect()
    whole = [row for row in rows if row.text == text]
    # Rows that agree in doc_id and text are one document and fare alike.
    assert len(rows) == 3 and [row.doc_id for row in whole] == [1, 1]
    assert line_dedup.summary(documents([])).count() == 0 == line_dedup.cleaned(documents([])).count()
    assert [row.n_removed for row in line_dedup.summary(documents([(None, None), (None, None), (2, "")])).collect()] == [0, 0, 0]


def test_lines_that_only_share_a_hash_are_left_alone(documents, monkeypatch):
    """With a hash of two values nearly all lines collide; what is not the same line is found by its bytes."""
    split = line_dedup._split
    monkeypatch.setattr(line_dedup, "_split", lambda rows: split(rows).withColumn("marks", F.expr(
        "transform(marks, (m, i) -> struct(if(lines[i] like 'once%', 7L, m.hash) as hash, m.words as words))")))
    block = "\n".join(f"line {i} of one block" for i in range(12))
    docs = [f"{block}\nonce a\nonce b\nonce c", f"{block}\nonce d\nonce e\nonce f", "once g\nonce h\nonce i\nonce j"]
    left = [row.text for row in line_dedup.cleaned(documents(docs)).orderBy("doc_id").collect()]
    assert left[0] == docs[0] and left[2] == docs[2]
    assert left[1].endswith("once d\nonce e\nonce f") and len(left[1]) < len(docs[1]) // 2


@pytest.mark.parametrize("stage", [False, True])
def test_no_repeated_run_of_lines_stays(spark, corpus, texts, stage):
    """Neither in the query nor in the stage of the pipeline, which remove the same lines."""
    gone = {}
    for row in QUERIES["op3_line_dedup"](spark, FOLDER).collect():
        ranges = [tuple(map(int, part.split("-"))) for part in row.removed.split(",") if part]
        gone[row.doc_id] = {n for a, b in ranges for n in range(a, b + 1)}
        assert row.n_removed == len(gone[row.doc_id])
    if stage:
        work = dict(corpus_pipeline.STAGES)["line dedup"]
        for row in work(spark, corpus, FOLDER).collect():
            lines = texts[row.doc_id].split("\n")
            assert row.text == "\n".join(x for i, x in enumerate(lines) if i + 1 not in gone[row.doc_id])
        return
    seen, repeats = {}, 0
    for doc, text in sorted(texts.items()):
        lines = (text or "").split("\n")
        for first, last in shortest_runs(lines):
            run = "\n".join(lines[first - 1:last])
            place = seen.setdefault(run, (doc, last))
            if place[0] < doc or first > place[1]:
                repeats += 1
                assert gone[doc] >= set(range(first, last + 1))
    left = {line for doc, text in texts.items() for n, line in enumerate((text or "").split("\n")) if n + 1 not in gone[doc]}
    assert repeats > 100 and left == {line for text in texts.values() for line in (text or "").split("\n")}
