import zlib

import numpy as np
from odd import ODD
from pyspark.sql import functions as F

from millrace.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(rows) == docs.count() and rows["score"].between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(rows["doc_id"], rows["held_out"]))
    held = rows[rows["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98
    sure = held[held["accepted"]]
    assert len(sure) > 0.9 * len(held) and (sure["lang"] == sure["lang_pred"]).mean() >= 0.98
    # Languages of the held-out fold are never read, those of a document are no input of its prediction.
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    again = language.languages(docs.withColumn("lang", F.when(~fold, F.col("lang")))).toPandas()
    assert again.sort_values("doc_id").reset_index(drop=True).equals(rows.drop(columns="lang").sort_values("doc_id").reset_index(drop=True))


def test_odd_tables(documents, spark):
    texts = [*ODD, "12 + 34 = ?!", (None, "x"), (3, "again")]
    rows = language.languages(documents(texts)).collect()
    assert len(rows) == len(texts)
    none = [row for row in rows if row.lang_pred == "und"]
    assert len(none) == 4 and all(row.score == 0 and not row.accepted for row in none)
    assert {row.lang_pred for row in rows if row not in none} == {"en"} and all(0 <= row.score <= 1 for row in rows)
    for frame in (documents(texts, lang=None), documents([(None, "some text"), (None, "x")])):
        assert {(row.lang_pred, row.score) for row in language.languages(frame).collect()} == {("und", 0.0)}
    assert language.languages(documents([])).count() == 0


def test_training_texts_are_bounded_and_distinct(documents, monkeypatch):
    """A text that most rows repeat, under one doc_id and under many, counts once."""
    monkeypatch.setattr(language, "MAX_PER_LANGUAGE", 40)
    monkeypatch.setattr(language, "MAX_TRAIN", 60)
    frame = documents([(3, "one and the same")] * 500 + [(i, "one and the same") for i in range(400)] + [(i, f"text number {i}") for i in range(300)])
    frame = frame.union(documents([(i, f"texte {i} ici") for i in range(300)], lang="fr"))
    rows = language.training_texts(frame, 3, 1).collect()
    assert len(rows) == 60 == len({row.text for row in rows})
    assert min(sum(row.lang == lang for row in rows) for lang in ("en", "fr")) == 30


def test_subwords_are_those_of_each_word():
    words = ["a", "été", "日本語", "longerword", "a"]
    ids, owner = language.subwords(words)
    for at, word in enumerate(words):
        own, _ = language.subwords([word])
        n = len(f"<{word}>".encode())
        assert sorted(ids[owner == at]) == sorted(own) and len(own) == 1 + sum(max(0, n - k + 1) for k in language.SIZES)


def test_scores_are_calibrated():
    rng = np.random.default_rng(2)
    logits = rng.normal(size=(4000, 3))
    p = np.exp(3 * logits) / np.exp(3 * logits).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=row) for row in p])
    model = language._calibrated(language.Model(["a", "b", "c"], np.zeros((1, 3)), np.zeros(3)), logits, y)
    assert 2.5 < model.scale < 3.5
    best = language._softmax(model.scale * logits)
    sure = best.max(1) >= model.accepted
    assert 0 < sure.mean() < 1 and (best.argmax(1) == y)[sure].mean() >= language.PRECISION
