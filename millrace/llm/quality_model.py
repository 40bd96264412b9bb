"""Quality by a generalised additive model with pairwise interactions, boosted in cycles over its features."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, crc32_mod, rows_by_batch
from millrace.llm.toxicity import training_rows

#: Most labelled documents that the model is fitted on; bins of a feature, of a feature in a pair, pairs, cycles.
MAX_TRAIN, BINS, PAIR_BINS, PAIRS, CYCLES, RATE, LEAVES, PENALTY = 20_000, 32, 8, 6, 120, 0.1, 4, 1.0
THRESHOLD = 0.7
FEATURES = ("log_words", "word_length", "capitals", "digits", "symbols", "stops", "shouts", "pipes", "other_letters",
            "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "line_length", "symbol_words", "single_letters")
_SYMBOLS = b"#*$%&|<>"
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def features(text: str) -> list[float]:
    """Statistics of a whole text, in the order of FEATURES; shares are 0 where there is nothing to share."""
    data = text.encode("utf-8", "surrogatepass")
    size, words = max(1, len(data)), data.split()
    n = max(1, len(words))
    without = lambda letters: (len(data) - len(data.translate(None, letters))) / size
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = max(1, len(words) - 1)
    return [
        float(np.log1p(len(words))), sum(map(len, counts.elements())) / n if words else 0.0, without(_CAPITALS), without(_DIGITS),
        without(_SYMBOLS), without(b".,;:?"), without(b"!"), without(b"|"), (len(data) - len(text)) / size,
        len(counts) / n, max(counts.values(), default=0) / n, len({*zip(words, words[1:])}) / pairs,
        len({*lines}) / max(1, len(lines)), float(np.log1p(size / max(1, len(lines)))),
        sum(c for w, c in counts.items() if w[-1] in _SYMBOLS) / n, sum(c for w, c in counts.items() if len(w) == 1) / n,
    ]


@dataclass
class Additive:
    """Lookup tables over bins: one per feature, one per chosen pair."""

    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    bias: float
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_cuts[i], x[:, i], side="right"), np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-total))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins in two; place 0 if there is none."""
    g, h = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    whole_g, whole_h = gradient.sum(), weight.sum()
    if not len(g):
        return 0.0, 0
    gain = g**2 / (h + PENALTY) + (whole_g - g) ** 2 / (whole_h - h + PENALTY) - whole_g**2 / (whole_h + PENALTY)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree of up to LEAVES leaves over the bins of one feature, grown at the best cut, as the value of each bin."""
    leaves = [(0, len(gradient))]
    while len(leaves) < LEAVES:
        found = [(*_best_cut(gradient[a:b], weight[a:b]), k) for k, (a, b) in enumerate(leaves)]
        gain, at, k = max(found)
        if gain <= 1e-9 or not at:
            break
        a, b = leaves[k]
        leaves[k:k + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(gradient))
    for a, b in leaves:
        out[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + PENALTY)
    return out


def _quarters(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut on each axis over the bins of a pair: its gain, and the value of each bin."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    best, cell = 0.0, None
    for a in range(gradient.shape[0] - 1):
        for b in range(gradient.shape[1] - 1):
            corner = lambda s: np.array([s[a, b], s[a, -1] - s[a, b], s[-1, b] - s[a, b], s[-1, -1] - s[a, -1] - s[-1, b] + s[a, b]])
            gs, hs = corner(g), corner(h)
            gain = float((gs**2 / (hs + PENALTY)).sum())
            if gain > best:
                best, cell = gain, (a, b, gs / (hs + PENALTY))
    out = np.zeros_like(gradient)
    if cell:
        a, b, (q0, q1, q2, q3) = cell
        out[:a + 1, :b + 1], out[:a + 1, b + 1:], out[a + 1:, :b + 1], out[a + 1:, b + 1:] = q0, q1, q2, q3
    return best, out


def learn(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boosts every feature in turn, a shallow tree and a small step at a time; then the PAIRS pairs whose one tree
    explains most of what is left."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(rate / (1 - rate)))
    cuts = [_cuts(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    model = Additive(cuts, [np.zeros(len(c) + 1) for c in cuts], bias)
    if not len(x):
        return model
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    total = np.full(len(y), bias)
    for _ in range(CYCLES):
        for j, at in enumerate(bins):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(at, y - p, minlength=size), np.bincount(at, p * (1 - p), minlength=size))
            model.tables[j] += step
            total += step[at]
    model.pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    shape = lambda i, j: (len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)

    def grown(i, j):
        p, (rows, columns) = 1 / (1 + np.exp(-total)), shape(i, j)
        at = coarse[i] * columns + coarse[j]
        return at, _quarters(np.bincount(at, y - p, minlength=rows * columns).reshape(rows, columns),
                             np.bincount(at, p * (1 - p), minlength=rows * columns).reshape(rows, columns))

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda ij: -grown(*ij)[1][0])
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros(shape(i, j)) for i, j in model.pairs]
    for _ in range(CYCLES // 4):
        for k, (i, j) in enumerate(model.pairs):
            at, (_, step) = grown(i, j)
            model.pair_tables[k] += RATE * step
            total += RATE * step.ravel()[at]
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Additive:
    """A model of `labels.quality` from at most MAX_TRAIN documents; tasks turn texts to features before the driver sees them."""
    rows = training_rows(docs, labels, "quality", 4, 2, MAX_TRAIN)

    def each(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([features(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))], names=["y", "x"])

    found = rows_by_batch(rows, "y int, x array<double>", each).toPandas()
    found = found.iloc[np.lexsort([*np.array(found["x"].tolist()).T, found["y"]])] if len(found) else found
    x = np.array(found["x"].tolist(), dtype=float).reshape(len(found), len(FEATURES))
    return learn(x, found["y"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null and empty texts have the features of an empty text. Ids that are null are never held out; repeated rows stay
    repeated; without labels every score is the same.
    """
    model = fit(docs, labels)
    scored = by_batch(docs, "score double", lambda texts: {"score": model.score(np.array([features(t) for t in texts])).tolist()}, "doc_id")
    return scored.select("doc_id", F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
