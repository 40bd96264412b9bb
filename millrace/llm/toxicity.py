"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, are learned from labels of documents."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, crc32_mod, materialise, rows_by_batch, whole_text
from millrace.llm.decontaminate import normal

#: Most labelled documents that the model is fitted on, features it weighs, and documents a feature must stand in.
MAX_TRAIN, VOCABULARY, MIN_DOCUMENTS = 20_000, 400, 8
STEPS, RATE, PENALTY = 400, 0.15, 3e-5
#: Beside the word itself, its beginnings of so many letters are features, as inflected words share them.
BEGINNINGS = (5, 6, 7)
KEPT_WORDS = 400_000
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(word: str) -> list[str]:
    """A word in its plain form, and its beginnings, marked as such."""
    plain = normal(word)
    return [plain, *(f"{plain[:n]}-" for n in BEGINNINGS if len(plain) > n)] if plain else []


class _Ids(dict):
    """Ids of the weighed features of raw words."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[word] = tuple(self.terms[f] for f in features(word) if f in self.terms)
        return found


@dataclass
class Model:
    terms: dict[str, int]
    weight: np.ndarray
    bias: float
    _ids: _Ids | None = None

    def __getstate__(self):
        return {**self.__dict__, "_ids": None}

    def found(self, text: str) -> tuple[list[tuple[int, int, list[int]]], int]:
        """Sentences with weighed words (begin, end, distinct ids), and the number of sentences without."""
        if self._ids is None:
            self._ids = _Ids(self.terms)
        ids = self._ids
        if not any(map(ids.__getitem__, {*_GAPS.sub(" ", text).split()})):
            return [], len(_SENTENCE.findall(text)) or 1
        out, plain = [], 0
        for match in _SENTENCE.finditer(text):
            known = {i for found in map(ids.__getitem__, match.group().split()) for i in found}
            if known:
                out.append((match.start(), match.end(), sorted(known)))
            else:
                plain += 1
        return out, plain

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The probability that some sentence is toxic, and each sentence with weighed words with its own."""
        sentences, plain = self.found(text)
        own = [(b, e, float(self.bias + self.weight[ids].sum())) for b, e, ids in sentences]
        clear = -plain * np.logaddexp(0, self.bias) - sum(np.logaddexp(0, z) for _, _, z in own)
        return float(-np.expm1(clear)), [(b, e, float(1 / (1 + np.exp(-z)))) for b, e, z in own]


_GAPS = re.compile(r"[.!?\n]")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int) -> DataFrame:
    """`y` and `text` of up to `most` labelled documents outside the held-out fold, chosen by the hash of doc_id.

    The chosen labels number `most` rows at the most, so they are broadcast to the documents, whose texts stay where
    they are. Repeated labels of a document count once, the larger one; of documents that share a doc_id the text with
    the least hash counts, once; null labels and ids are left out. So there are `most` rows at the most.
    """
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (crc32_mod("doc_id", folds) != held)).groupBy(
        "doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "y", "text")).alias("row"))
    return one.select("row.y", "row.text")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of `labels.toxic`; without labelled documents every sentence gets the same small score."""
    rows = materialise(training_rows(docs, labels, "toxic", 5, 0, MAX_TRAIN), "training")

    def counted(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if y else other).update({f for w in {*_GAPS.sub(" ", text).split()} for f in features(w)} | {""})
        words = [*(toxic.keys() | other.keys())]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()),
                                          pa.array([other[w] for w in words], pa.int64())], names=["word", "toxic", "other"])

    counts = rows_by_batch(rows, "word string, toxic bigint, other bigint", counted).groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # Written once: the totals and the best words are both read from there.
    counts = materialise(counts.where(f"toxic + other >= {MIN_DOCUMENTS} or word = ''"), "words")
    totals = counts.filter("word = ''").head()  # every document counts the empty word once
    if not totals or not totals["toxic"]:
        return Model({}, np.zeros(0), -12.0)
    gain = F.expr(f"abs(ln((toxic + 0.5) / ({totals['toxic']} + 1)) - ln((other + 0.5) / ({totals['other']} + 1)))")
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    top = counts.filter("word <> ''").orderBy((gain / spread).desc(), "word").limit(VOCABULARY)
    terms = {r["word"]: i for i, r in enumerate(top.select("word").collect())}
    model = Model(terms, np.zeros(len(terms)), -6.0)

    def read(batches):
        for batch in batches:
            ys, plains, ids = [], [], []
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sentences, plain = model.found(text)
                ys.append(y)
                plains.append(plain)
                ids.append([i for s in sentences for i in (*s[2], -1)])
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(plains, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["y", "plain", "ids"])

    found = rows_by_batch(rows, "y int, plain bigint, ids array<int>", read).toPandas()  # MAX_TRAIN rows at most
    return _learn(model, found["y"].to_numpy(float), found["plain"].to_numpy(float), list(found["ids"]))


def _learn(model: Model, y: np.ndarray, plain: np.ndarray, ids: list) -> Model:
    lengths = np.array([len(i) for i in ids])
    flat = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids]) if lengths.sum() else np.zeros(0, dtype=np.int64)
    document = np.repeat(np.arange(len(ids)), lengths)
    ends = flat < 0
    sentence = np.cumsum(ends) - ends
    word, of = flat[~ends], sentence[~ends]
    owner, n = document[ends], int(ends.sum())
    theta = np.concatenate([model.weight, [model.bias]])
    first = second = np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, b = theta[:-1], theta[-1]
        z = np.bincount(of, w[word], minlength=n) + b
        clear = np.bincount(owner, np.logaddexp(0, z), minlength=len(y)) + plain * np.logaddexp(0, b)
        clear = np.maximum(clear, 1e-9)
        # d(-log likelihood) / d(clear): 1 for documents without toxic sentence, -1 / (e^clear - 1) for the others.
        slope = np.where(y > 0, -1 / np.expm1(np.minimum(clear, 50)), 1.0)
        share = 1 / (1 + np.exp(-z))
        at = slope[owner] * share
        gradient = np.concatenate([np.bincount(word, at[of], minlength=len(w)), [at.sum() + (slope * plain).sum() / (1 + np.exp(-b))]])
        gradient = gradient / len(y) + PENALTY * np.concatenate([w, [0.0]])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(model.terms, theta[:-1], float(theta[-1]))


def scored(docs: DataFrame, model: Model, *passed: str) -> DataFrame:
    """The columns in `passed`, `score`, `n_offending` sentences that are toxic by themselves, and where the worst one
    begins and ends in characters (null without one)."""
    def work(texts):
        out = {"score": [], "n_offending": [], "worst_begin": [], "worst_end": []}
        for text in texts:
            score, sentences = model.score(text)
            bad = [s for s in sentences if s[2] >= 0.5]
            worst = max(bad, key=lambda s: (s[2], -s[0]), default=(None, None, 0))
            out["score"].append(min(1.0, max(0.0, score)))
            out["n_offending"].append(len(bad))
            out["worst_begin"].append(worst[0])
            out["worst_end"].append(worst[1])
        return out

    return by_batch(docs, "score double, n_offending bigint, worst_begin bigint, worst_end bigint", work, *passed)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending, worst_begin and worst_end of every document.

    Null and empty texts count as one empty sentence. Ids that are null are never held out; repeated rows stay repeated.
    """
    return scored(docs, fit(docs, labels), "doc_id").select(
        "doc_id", F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_offending", "worst_begin", "worst_end")
