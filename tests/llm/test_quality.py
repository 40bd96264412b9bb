import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd import ODD
from pyspark.sql import functions as F

from millrace.llm import quality_model, quality_rules, toxicity
from millrace.llm.common import materialise

FOLDER = "/root/testdata/sf0.01"


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    covered = {k for found in places.values() if len(found) > 1 for i in found for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len({*lines}), len(covered))


def check(frame, texts):
    rows = quality_rules.quality_rules(frame).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = counted(texts[row.doc_id] or "")
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (row.base_failed and row.kept)
    return {row.doc_id: row for row in rows}


def test_counts_of_the_corpus(corpus, texts):
    check(corpus, texts)


def test_odd_texts_and_groups(documents):
    again = "one two three four five six seven eight nine\n" * 4 + "tail"
    texts = [*ODD, again, "a b c d e f g h a b c d e f g h x y z q", "line\n\nline\n \nline"]
    check(documents(texts), dict(enumerate(texts)))
    check(documents(texts, lang=None, source=None), dict(enumerate(texts)))
    assert quality_rules.quality_rules(documents([])).count() == 0
    kept = quality_rules.passing(documents(texts))
    assert kept.columns == documents(texts).columns


def plain_mcd(x, share, steps):
    """Mean and scaled covariance of one group by sorting, from the two starts."""
    floor = np.diag([f**2 for f in quality_rules.FLOOR.values()])
    quartile = lambda q: np.quantile(x, q, axis=0, method="inverted_cdf")
    spread = np.maximum((quartile(.75) - quartile(.25)) / 1.349, list(quality_rules.FLOOR.values()))
    best = None
    for mean, cov in ((quartile(.5), np.diag(spread**2)), (x.mean(0), np.cov(x.T, bias=True) + floor)):
        for _ in range(steps):
            d = ((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(1)
            near = x[d <= np.quantile(d, share, method="inverted_cdf")]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) + floor
        found = np.linalg.slogdet(cov)[1], mean, cov
        best = found if best is None or found[0] < best[0] - 1e-9 else best
    d = ((x - best[1]) @ np.linalg.inv(best[2]) * (x - best[1])).sum(1)
    return best[1], best[2] * max(1.0, np.quantile(d, .5, method="inverted_cdf") / 5.348)


def test_distances_equal_those_of_a_plain_computation(corpus):
    """Sources of 1 to over 100 documents in two languages (one of them null), against the same blend."""
    rank = F.col("doc_id") % 11
    source = F.when(F.col("doc_id") == 5, "one").when(rank < 1, "few").when(rank < 4, "some").when(rank < 5, None).otherwise("most")
    lang = F.when(F.col("doc_id") % 3 == 0, None).otherwise("x")
    # Written first, as the query and the stage of the pipeline do.
    rows = materialise(quality_rules.measured(corpus.select("doc_id", lang.alias("lang"), source.alias("source"), "text")), "measured")
    points = rows.where(~quality_rules._failed()).select(
        "doc_id", "lang", "source", *[c.alias(n) for n, c in quality_rules._transformed().items()]).toPandas().fillna({"lang": "-", "source": "-"})
    want, sizes = {}, []
    for _, of_lang in points.groupby("lang"):
        everywhere = plain_mcd(of_lang[quality_rules.NAMES].to_numpy(), quality_rules.SHARE, quality_rules.STEPS)
        for _, group in of_lang.groupby("source"):
            x, n = group[quality_rules.NAMES].to_numpy(), len(group)
            own = plain_mcd(x, quality_rules.SHARE, quality_rules.STEPS)
            mean, cov = (n / (n + quality_rules.LENT) * a + quality_rules.LENT / (n + quality_rules.LENT) * b for a, b in zip(own, everywhere))
            want |= dict(zip(group["doc_id"], ((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(1)))
            sizes.append(n)
    found = quality_rules.judged(rows, quality_rules.fitted(rows)).where("not base_failed").select("doc_id", "distance").toPandas()
    assert len(found) == len(want) == len(points) and min(sizes) == 1 and max(sizes) > 50
    assert np.allclose(found["distance"], [want[d] for d in found["doc_id"]], rtol=1e-6)


@pytest.fixture(scope="module")
def many(spark):
    """60,000 points of one source, more than a sketch of their percentiles holds."""
    part = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 30)) / (1 << 30)
    points = spark.range(60_000).select(F.lit("x").alias("lang"), F.lit(None).cast("string").alias("source"), *[
        (3 * least * part(i) * part(i)).alias(name) for i, (name, least) in enumerate(quality_rules.FLOOR.items())])
    return materialise(points, "many")


def test_estimates_rest_on_all_points_of_large_groups(many):
    """Medians, quartiles and limits are those of every point: a plain computation by sorting, however rows are dealt."""
    mean, cov = plain_mcd(many.select(*quality_rules.NAMES).toPandas().to_numpy(), quality_rules.SHARE, quality_rules.STEPS)
    for dealt in (many, many.repartition(13)):
        found = quality_rules.estimates(dealt).where("own").first()
        assert np.allclose(found["mean"], mean, rtol=1e-9)
        factor = np.zeros((6, 6))
        factor[np.tril_indices(6)] = found["factor"]
        assert np.allclose(factor.T @ factor, np.linalg.inv(cov), rtol=1e-6, atol=1e-6)


@pytest.mark.parametrize("listed", [0, 100, 10_000])
def test_percentiles_are_values_at_their_exact_place(spark, monkeypatch, listed):
    """Ties, single rows, null keys, values apart by one bit, and cells that have to be cut again and again."""
    monkeypatch.setattr(quality_rules, "LISTED", listed)
    rng = np.random.default_rng(3)
    groups = {"one": [2.5], "ties": [0.0] * 900 + [1.0] * 100 + [1.5], None: list(rng.random(3000) ** 8),
              "close": list(np.nextafter(1.0, 2.0, dtype=float) * np.ones(500)) + [1.0] * 500 + [np.nextafter(1.0, 0.0)],
              "wide": list(10.0 ** rng.uniform(-12, 12, 2000)), "tight": list(7 + rng.random(2000) * 1e-9)}
    rows = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values], "g string, value double")
    shares = [0.25, 0.5, 0.75]
    found = {(r.g, r.share): (r.value, r.total) for r in quality_rules.percentiles(rows.repartition(5), ["g"], shares).collect()}
    assert found == {(k, q): (np.quantile(v, q, method="inverted_cdf"), len(v)) for k, v in groups.items() for q in shares}


def test_rules_keep_good_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = quality_rules.quality_rules(docs).join(labels, "doc_id").where("not base_failed")
    good, bad = ({r.kept: r["count"] for r in found.where(f"quality = {q}").groupBy("kept").count().collect()} for q in (1, 0))
    assert good.get(False, 0) <= 0.01 * good[True] and bad.get(True, 0) <= 0.2 * bad[False]


def area(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    ones = y.sum()
    return (order[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("module, query, label, fold, least", [
    (quality_model, "quality", "quality", (4, 2), 0.97), (toxicity, "toxicity", "toxic", (5, 0), 0.75)])
def test_held_out_labels(module, query, label, fold, least, spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = getattr(module, query)(docs, labels).join(labels, "doc_id", "left").toPandas()
    assert len(rows) == docs.count() and rows["score"].between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % fold[0] == fold[1]) for d, h in zip(rows["doc_id"], rows["held_out"]))
    held = rows[rows["held_out"] & rows[label].notna()]
    assert area(held["score"].to_numpy(), held[label].to_numpy()) > least
    # Labels of the held-out fold are never read: turning them over changes nothing.
    turned = labels.withColumn(label, F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(fold[0])) == fold[1],
                                             1 - F.col(label)).otherwise(F.col(label)))
    again = getattr(module, query)(docs, turned).toPandas()
    assert np.allclose(again.sort_values("doc_id")["score"], rows.sort_values("doc_id")["score"])


def test_training_rows_are_bounded(spark):
    """One doc_id on a third of the rows, in copies and in different texts, gives one training row."""
    rows = [(7, f"text {i % 5}") for i in range(2000)] + [(i, f"own {i}") for i in range(4000)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)] * 2 + [(7, 1), (None, 1)], "doc_id bigint, toxic int")
    for most in (100, 10_000):
        found = toxicity.training_rows(docs, labels, "toxic", 5, 0, most).collect()
        assert len(found) == min(most, sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(4000)))
        assert len({row.text for row in found}) == len(found)


@pytest.mark.parametrize("work", [quality_model.quality, toxicity.toxicity])
def test_models_take_odd_tables(work, documents, spark):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(8)] * 2 + [(None, 1, 1), (3, None, None)], empty.schema)
    for labels in (empty, some):
        rows = work(documents([*ODD, (None, "x"), (3, "again")]), labels).collect()
        assert len(rows) == len(ODD) + 2 and all(0 <= row.score <= 1 for row in rows)
        assert work(documents([]), labels).count() == 0


def test_worst_sentence_is_located():
    model = toxicity.Model({"bad": 0, "worse": 1}, np.array([3.0, 9.0]), -4.0)
    text = "All is well. This is bad! And this is Worse, much worse\nend"
    score, sentences = model.score(text)
    parts = [1 / (1 + np.exp(-z)) for z in (-4.0, -1.0, 5.0, -4.0)]
    assert np.isclose(score, 1 - np.prod(1 - np.array(parts)))
    assert [text[b:e].strip() for b, e, _ in sentences] == ["This is bad", "And this is Worse, much worse"]


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = quality_model.learn(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.9
