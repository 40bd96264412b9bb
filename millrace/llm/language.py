"""Languages of texts: averaged embeddings of hashed subwords, a linear softmax on top, and calibrated rejection."""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, crc32_mod, rows_by_batch

#: The model is fitted on at most MAX_TRAIN texts, MAX_PER_LANGUAGE of a language, and on MAX_WORDS words of each, drawn
#: over the whole text, beside PIECES short pieces of up to PIECE_WORDS words.
MAX_TRAIN, MAX_PER_LANGUAGE, MAX_WORDS, PIECES, PIECE_WORDS = 6000, 1500, 80, 3, 8
#: Rows and columns of the embedding, lengths of subwords, and the descent.
BUCKETS, WIDTH, SIZES, EPOCHS, BATCH, RATE = 1 << 15, 16, (2, 3, 4), 5, 64, 0.5
#: One text in CALIBRATED is kept out of the descent to set the scale of scores and the score from which predictions
#: are accepted: the least one above which PRECISION of them are right.
CALIBRATED, PRECISION = 5, 0.99
KEPT_WORDS, CHUNK = 200_000, 100_000
#: Odd multiplier of the rolling hash of subwords, modulo 2^64.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; none where the text has no letter."""
    return _WORD.findall(text.lower()) if any(map(str.isalpha, text)) else []


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words, marked at both ends, and of their parts of SIZES bytes; and the place of the word of each."""
    marked = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words]
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    found, owners = [np.array([zlib.crc32(m) % BUCKETS for m in marked], dtype=np.int64)], [np.arange(len(words))]
    for size in SIZES:
        last = max(0, len(data) - size + 1)
        rolled = np.full(last, size, dtype=np.uint64)
        for k in range(size):
            rolled = rolled * MULTIPLIER + data[k:last + k]
        inside = owner[:last] == owner[size - 1:]
        found.append(((rolled * MULTIPLIER >> np.uint64(24)) % np.uint64(BUCKETS)).astype(np.int64)[inside])
        owners.append(owner[:last][inside])
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class Model:
    """Share of each bucket in the logit of each language, the bias, the scale of logits and the accepted score."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    scale: float = 1.0
    accepted: float = 1.0
    _rows: dict[str, int] = field(default_factory=dict)
    _sums: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_rows": {}, "_sums": None}

    def _learn_words(self, words: list[str]) -> None:
        """Adds rows of the sum over the subwords of each new word, and their number."""
        ids, owner = subwords(words)
        at = len(self._rows)
        if self._sums is None or at + len(words) > len(self._sums):
            grown = np.zeros((2 * (at + len(words)), len(self.languages) + 1))
            grown[:at] = 0 if self._sums is None else self._sums[:at]
            self._sums = grown
        for k in range(len(self.languages)):
            self._sums[at:at + len(words), k] = np.bincount(owner, self.table[ids, k], len(words))
        self._sums[at:at + len(words), -1] = np.bincount(owner, minlength=len(words))
        self._rows.update(zip(words, range(at, at + len(words))))

    def logits(self, words: list[str]) -> np.ndarray:
        """The mean over the subwords of all words; each distinct word is looked up once."""
        total = np.zeros(len(self.languages) + 1)
        for begin in range(0, len(words), CHUNK):
            chunk = words[begin:begin + CHUNK]
            if len(self._rows) > KEPT_WORDS:
                self._rows.clear()
            if new := [w for w in {*chunk} if w not in self._rows]:
                self._learn_words(new)
            total += self._sums[[*map(self._rows.__getitem__, chunk)]].sum(0)
        return total[:-1] / total[-1] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        """The most probable language and its probability."""
        words = words_of(text) if self.languages else []
        if not words:
            return UNKNOWN, 0.0
        p = _softmax(self.scale * self.logits(words))
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def training_texts(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """`lang`, `key` and `text` of distinct labelled texts outside the held-out fold, chosen by their hashes.

    Only hashes are compared to choose: up to MAX_PER_LANGUAGE of each language, then MAX_TRAIN in all, languages taking
    turns. A text that many rows repeat counts once, before the choice and after it. Rows without doc_id are left out.
    """
    usable = docs.where((crc32_mod("doc_id", folds) != held) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("lang", "text").alias("key"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    chosen = usable.select("lang", "key").distinct().withColumn("turn", turn).where(f"turn <= {MAX_PER_LANGUAGE}").orderBy(
        "turn", "key").limit(MAX_TRAIN).select("key")
    return usable.join(F.broadcast(chosen), "key").dropDuplicates(["key"]).select("lang", "key", "text")


def examples(text: str, key: int) -> list[np.ndarray]:
    """Buckets of words drawn over the whole text, and of short pieces of it."""
    words, rng = words_of(text), random.Random(key)
    if not words:
        return []
    drawn = [words if len(words) <= MAX_WORDS else rng.sample(words, MAX_WORDS)]
    for _ in range(PIECES):
        at = rng.randrange(len(words))
        drawn.append(words[at:at + rng.randint(1, PIECE_WORDS)])
    return [np.sort(subwords(ws)[0]) for ws in drawn]


def fit(docs: DataFrame) -> Model:
    """A model of `docs.lang`; tasks turn texts into buckets, of which the driver gets a bounded number."""
    def each(batches):
        for batch in batches:
            rows = [(lang, key, nth, ids) for lang, key, text in zip(*(c.to_pylist() for c in batch.columns))
                    for nth, ids in enumerate(examples(text, key))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32())))], names=["lang", "key", "nth", "ids"])

    found = rows_by_batch(training_texts(docs, 3, 1), "lang string, key bigint, nth int, ids array<int>", each).toArrow().combine_chunks()
    languages, y = np.unique(np.array(found["lang"].to_pylist(), dtype=object).astype(str), return_inverse=True)
    key, nth = found["key"].to_numpy(), found["nth"].to_numpy()
    order = np.lexsort((nth, key, y))  # the same whatever task had which text
    ids = [part.values.to_numpy() for part in found["ids"].combine_chunks()] if len(order) else []
    return learn(languages.tolist(), [ids[i] for i in order], y[order], key[order] % CALIBRATED == 0)


def learn(languages: list[str], ids: list[np.ndarray], y: np.ndarray, apart: np.ndarray) -> Model:
    """Stochastic gradient descent on all examples but those `apart`, on which scores are then calibrated."""
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(3)
    embedding = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    output, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))

    def batch_of(chosen):
        n = np.array([len(ids[i]) for i in chosen])
        at = np.concatenate([ids[i] for i in chosen])
        return at, n, np.add.reduceat(embedding[at], np.cumsum(n) - n, axis=0) / n[:, None]

    used = np.flatnonzero(~apart) if (~apart).any() else np.arange(len(y))
    steps = EPOCHS * -(-len(used) // BATCH)
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(used)
        for begin in range(0, len(order), BATCH):
            chosen = order[begin:begin + BATCH]
            at, n, hidden = batch_of(chosen)
            slope = _softmax(hidden @ output + bias)
            slope[np.arange(len(chosen)), y[chosen]] -= 1
            rate = RATE * (1 - done / steps)
            back = np.repeat(rate * slope @ output.T / n[:, None], n, axis=0)
            touched, where = np.unique(at, return_inverse=True)
            embedding[touched] -= np.stack([np.bincount(where, back[:, k], len(touched)) for k in range(WIDTH)], axis=1)
            output -= rate * hidden.T @ slope
            bias -= rate * slope.mean(0)
            done += 1
    model = Model(languages, embedding @ output, bias)
    held = np.flatnonzero(apart) if apart.any() else used
    logits = np.concatenate([batch_of(held[b:b + BATCH])[2] for b in range(0, len(held), BATCH)]) @ output + bias
    return _calibrated(model, logits, y[held])


def _calibrated(model: Model, logits: np.ndarray, y: np.ndarray) -> Model:
    """Sets the scale with the least loss, and the least score from which PRECISION of the predictions are right."""
    def loss(scale):
        return -np.log(np.maximum(_softmax(scale * logits)[np.arange(len(y)), y], 1e-12)).mean()

    model.scale = float(min(np.geomspace(0.1, 20, 60), key=loss))
    p = _softmax(model.scale * logits)
    order = np.argsort(-p.max(1), kind="stable")
    right = np.cumsum(p.argmax(1)[order] == y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= PRECISION)
    model.accepted = float(p.max(1)[order[good[-1]]]) if len(good) else 1.0
    return model


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every document.

    `accepted` is false where the calibrated score is too low to be relied on, and where there is none: null texts and
    those without a letter are `und` with score 0, as is every text while there is no labelled one. Null ids are never
    held out and never learned from; repeated rows stay repeated; an empty table gives an empty result.
    """
    model = fit(docs)

    def work(texts):
        found = [model.predict(t) for t in texts]
        return {"lang_pred": [lang for lang, _ in found], "score": [score for _, score in found]}

    scored = by_batch(docs, "lang_pred string, score double", work, "doc_id")
    return scored.select("doc_id", F.coalesce(crc32_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score",
                         ((F.col("score") > 0) & (F.col("score") >= model.accepted)).alias("accepted"))
