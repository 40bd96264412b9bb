"""Benchmark leaks: passages near an item in a latent space, confirmed by longest common subsequences and its answer."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, materialise, packed, rows_by_batch, unpacked, whole_text

#: Words of a block; passages are two blocks, each block begins one. Least number of dimensions kept, one for each item at
#: least; further ones used while fitting, and how much more all items count there than all passages of the documents.
BLOCK, RANK, EXTRA, ROUNDS, BOOST = 16, 160, 32, 2, 5.0
#: Items of fewer words are no passages and never leak.
LEAST_WORDS = 8
#: Blocks whose words are held against the items that the latent space does not hold, at once.
STRETCH = 64
#: Words in more than this share of all documents (and in as many at least) have no weight in the retrieval.
COMMON_SHARE, COMMON_DOCUMENTS = 0.05, 50
#: Products of two weights are summed as whole multiples of 1 / UNIT, so that sums depend on no order; a task sends what
#: it has summed from so many pairs of terms on.
UNIT, PAIRS = 1 << 24, 1 << 19
#: Share of an item's words, in order, that proves a leak; with the answer, fewer do.
LCS, PARAPHRASE_LCS, ANSWER_LCS, ANSWER_SHARE = 0.75, 0.6, 0.9, 0.25
#: A passage is a candidate for an item from so large a cosine on, and if so much of the item's weight projects on it;
#: both for items no longer than a block, and less for longer ones, of which a passage holds a part.
COSINE, MASS = 0.3, 0.36
#: Items of whose weight less than this share lies in the latent space, or with fewer weighed words, are compared with
#: every passage that holds enough of their words.
RETAINED, WEIGHED_WORDS = 0.9, 5
#: Documents whose passages are searched at once, and passages compared with all items at once.
DOCUMENTS, ROWS = 256, 2048
KEPT_WORDS = 400_000
_NO_WORD = re.compile(r"[\W_]+")


def normal(word: str) -> str:
    """A word in lower case without punctuation; may be empty."""
    return _NO_WORD.sub("", word.lower())


class _Ids(dict):
    """Ids of raw words: that of the term, -1 for words that no benchmark item has, -2 for what is no word."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        plain = normal(word)
        found = self[word] = self.terms.get(plain, -1) if plain else -2
        return found


@dataclass
class Index:
    """Terms of the benchmark, their weights and latent vectors, and the items. All of it grows with the benchmark only."""

    terms: dict[str, int]
    items: list[tuple[int, list[int]]]
    weight: np.ndarray
    latent: np.ndarray | None = None
    vectors: np.ndarray | None = None
    least: np.ndarray | None = None
    cosines: np.ndarray | None = None
    masks: list[dict[int, int]] = field(default_factory=list)
    shares: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    _ids: _Ids | None = None

    def __getstate__(self):
        return {**self.__dict__, "_ids": None}

    def ids(self, text: str) -> np.ndarray:
        if self._ids is None:
            self._ids = _Ids(self.terms)
        words = text.split()
        found = np.fromiter(map(self._ids.__getitem__, words), dtype=np.int32, count=len(words))
        return found[found != -2] if len(found) and found.min() == -2 else found


def common_subsequence(mask: dict[int, int], n: int, words) -> int:
    """Length of the longest common subsequence of n terms, given as the bits of their places, and other words."""
    rest = full = (1 << n) - 1
    for word in words:
        if at := mask.get(word):
            both = rest & at
            rest = ((rest + both) | (rest - both)) & full
    return n - rest.bit_count()


def _rows(passages: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length."""
    out = np.zeros((len(passages), len(weight)), dtype=np.float32)
    for row, ids in zip(out, passages):
        ids = ids[ids >= 0]
        np.add.at(row, ids, weight[ids])
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def _document_frequency(tokens: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many documents each term stands, over all documents, and the number of documents."""
    found = tokens.select(F.explode(F.array_distinct("ids")).alias("term")).where("term >= 0").groupBy("term").count()
    counts = np.zeros(n_terms, dtype=np.int64)
    for row in found.collect():  # one row per benchmark term
        counts[row["term"]] = row["count"]
    return counts, tokens.count()


@dataclass
class Weighed:
    """The passages of a block of documents that have terms of some weight, all of their terms in one row after the other."""

    first: np.ndarray  # number of the first passage of each document, with or without such terms
    passage: np.ndarray  # number of each passage here
    starts: np.ndarray  # where its terms start and end
    ends: np.ndarray
    term: np.ndarray  # in rising order within a passage
    times: np.ndarray
    norm: np.ndarray  # length of the weights of each passage


def _weighed(weight: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> Weighed | None:
    """The weighed passages of the documents whose ids are `flat`, each from one of the `offsets` to the next."""
    lengths = np.diff(offsets)
    passages = np.maximum(1, -(-lengths // BLOCK) - 1)
    first = np.concatenate([[0], np.cumsum(passages)])
    at = np.flatnonzero((flat >= 0) & (weight[np.maximum(flat, 0)] > 0))
    if not len(at):
        return None
    doc = np.searchsorted(offsets, at, side="right") - 1
    block = (at - offsets[doc]) // BLOCK
    inside = np.concatenate([block < passages[doc], block > 0])
    key = (np.concatenate([first[doc] + block, first[doc] + block - 1]) * len(weight) + np.concatenate([flat[at]] * 2))[inside]
    key, times = np.unique(key, return_counts=True)
    passage, term = key // len(weight), key % len(weight)
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    norm = np.sqrt(np.add.reduceat((times * weight[term]) ** 2, starts))
    return Weighed(first, passage[starts], starts, np.append(starts[1:], len(passage)), term, times, norm)


def _blocks(ids: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of DOCUMENTS documents at a time in one array, and where each of them begins."""
    for begin in range(0, len(ids), DOCUMENTS):
        part = ids.slice(begin, DOCUMENTS)
        offsets = part.offsets.to_numpy().astype(np.int64)
        yield part.values.to_numpy()[offsets[0]:offsets[-1]], offsets - offsets[0]


def _pairs(weight: np.ndarray, found: Weighed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each two terms of a passage, the lower one first, their key and the product of their weights in it.

    A passage has unit length. ROWS passages are taken at once; each has 2 * BLOCK terms at most.
    """
    for begin in range(0, len(found.starts), ROWS):
        starts, ends = found.starts[begin:begin + ROWS], found.ends[begin:begin + ROWS]
        term, times = (column[starts[0]:ends[-1]] for column in (found.term, found.times))
        value = times * weight[term] / np.repeat(found.norm[begin:begin + ROWS], ends - starts)
        after = np.repeat(ends - starts[0], ends - starts) - np.arange(len(term))
        left = np.repeat(np.arange(len(term)), after)
        right = left + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
        yield term[left] * len(weight) + term[right], np.rint(UNIT * value[left] * value[right]).astype(np.int64)


def _summed(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, part = np.concatenate(keys), np.concatenate(sums)
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[starts], np.add.reduceat(part[order], starts)


def _gram(tokens: DataFrame, index: Index) -> DataFrame:
    """`low`, `high` and `total`: the products of each two terms summed over all passages of all documents, in units of
    1 / UNIT, both ways round and sorted by `low`. That is the Gram matrix of the passages without its zeros.

    Tasks sum before the shuffle. Rows grow with the pairs of benchmark terms that meet in a passage, not with documents.
    """
    weight, width = index.weight, len(index.terms)

    def each(batches):
        keys, sums, held = [], [], 0

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(keys[0], pa.int64()), pa.array(sums[0], pa.int64())], names=["pair", "part"])

        for batch in batches:
            for flat, offsets in _blocks(batch.column(0)):
                if (found := _weighed(weight, flat, offsets)) is None:
                    continue
                for key, part in _pairs(weight, found):
                    keys.append(key)
                    sums.append(part)
                    held += len(key)
                    if held > 2 * PAIRS:
                        keys, sums = ([column] for column in _summed(keys, sums))
                        held = len(keys[0])
                        if held > PAIRS:
                            yield sent()
                            keys, sums, held = [], [], 0
        if keys:
            keys, sums = ([column] for column in _summed(keys, sums))
            yield sent()

    pairs = rows_by_batch(tokens.select("ids"), "pair bigint, part bigint", each).groupBy("pair").agg(F.sum("part").alias("total"))
    ways = pairs.selectExpr("total", f"cast(pair div {width} as int) as a", f"cast(pair % {width} as int) as b").select(
        "total", F.explode(F.expr("if(a = b, array(struct(a as low, b as high)), array(struct(a as low, b as high), struct(b as low, a as high)))")).alias("p"))
    return ways.select("p.low", "p.high", "total").repartition("low").sortWithinPartitions("low", "high")


def _decompose(gram: DataFrame, index: Index, items: list[np.ndarray]) -> np.ndarray:
    """The leading right singular vectors of all passages behind `gram` and all items, by randomised subspace iteration.

    Each round is one job: tasks multiply their rows of the Gram matrix with the basis, and the driver, which gets one
    row of the product for each term, makes the basis orthogonal again. All items together count BOOST times as much as
    all passages, however many documents there are.
    """
    rank = max(RANK, len(items))
    size = min(rank + EXTRA, len(index.terms))
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.standard_normal((len(index.terms), size)))[0].astype(np.float32)
    own = _rows(items, index.weight)
    total = gram.where("low = high").agg(F.sum("total")).first()[0]
    share = (own**2).sum() / (BOOST * total) if total else 0.0
    projected = basis
    for _ in range(ROUNDS + 1):
        def each(batches, basis=basis):
            for batch in batches:
                if batch.num_rows:
                    low, high, total = (column.to_numpy() for column in batch.columns)
                    starts = np.flatnonzero(np.diff(low, prepend=-1))
                    part = np.add.reduceat((total * share).astype(np.float32)[:, None] * basis[high], starts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(low[starts], pa.int32()), pa.array([row.tobytes() for row in part], pa.binary())], names=["term", "part"])

        projected = (own.T @ (own @ basis)).astype(np.float64)
        for row in rows_by_batch(gram, "term int, part binary", each).collect():  # a few rows for each benchmark term
            projected[row["term"]] += np.frombuffer(row["part"], dtype=np.float32)
        before, basis = basis, np.linalg.qr(projected)[0].astype(np.float32)
    # projected is the Gram matrix times the last but one basis; its small part there gives the order of directions.
    _, turned = np.linalg.eigh(before.T @ projected)
    return before @ turned[:, ::-1][:, :rank].astype(np.float32)


def read_items(benchmark: DataFrame) -> Index:
    """The items of `benchmark` (item_id, text): collected, as the query set that every document is held against.

    Null texts and those of fewer than LEAST_WORDS words are left out; rows that agree in both columns count once.
    """
    rows = benchmark.select("item_id", whole_text().alias("text")).distinct().orderBy("item_id", "text").collect()
    words = [(r["item_id"], [w for w in map(normal, r["text"].split()) if w]) for r in rows]
    words = [(i, ws) for i, ws in words if len(ws) >= LEAST_WORDS]
    terms = {t: n for n, t in enumerate(sorted({w for _, ws in words for w in ws}))}
    items = [(i, [terms[w] for w in ws]) for i, ws in words]
    index = Index(terms, items, np.ones(len(terms), dtype=np.float32))
    for _, ids in items:
        mask: dict[int, int] = {}
        for place, term in enumerate(ids):
            mask[term] = mask.get(term, 0) | 1 << place
        index.masks.append(mask)
    return index


def tokens_of(index: Index, rows: DataFrame, *passed: str) -> DataFrame:
    """The columns in `passed` and `ids`, the term of each word of the whole text (-1 for others): texts are read once."""
    return materialise(by_batch(rows, "ids array<int>", lambda texts: {"ids": [index.ids(t) for t in texts]}, *passed), "tokens")


def fit(index: Index, tokens: DataFrame) -> Index:
    """Weights and latent space from all documents and all items."""
    if not index.items:
        return index
    counts, n = _document_frequency(tokens, len(index.terms))
    common = counts > max(COMMON_SHARE * n, COMMON_DOCUMENTS)
    index.weight = np.where(common, 0, np.log((n + 2) / (counts + 1))).astype(np.float32)
    own = [np.array(ids, dtype=np.int32) for _, ids in index.items]
    basis = _decompose(materialise(_gram(tokens, index), "gram"), index, own)
    index.latent = (basis * index.weight[:, None]).astype(np.float32)
    whole, weighed, found = [], [], []
    for ids in own:
        terms, times = np.unique(ids, return_counts=True)
        whole.append(((times * index.weight[terms]) ** 2).sum())
        weighed.append((index.weight[ids] > 0).sum())
        found.append(times @ index.latent[terms])
    whole, found = np.array(whole), np.array(found, dtype=np.float32)
    inside = (found**2).sum(1)
    lost = np.flatnonzero((inside < RETAINED * whole) | (np.array(weighed) < WEIGHED_WORDS))
    part = np.minimum(1, BLOCK / np.array([len(ids) for ids in own]))
    index.vectors = found
    index.least = (MASS * part * inside).astype(np.float32)
    index.cosines = (COSINE * np.sqrt(part) * np.sqrt(inside)).astype(np.float32)
    # Items that go the other way are no candidates here.
    index.least[lost] = np.inf
    index.shares = _shares([index.items[i] for i in lost], lost, len(index.terms)) if len(lost) else None
    return index


def build_index(docs: DataFrame, benchmark: DataFrame) -> Index:
    """The fitted index of `benchmark` for `docs`."""
    index = read_items(benchmark)
    return fit(index, tokens_of(index, docs))


def _near(index: Index, flat: np.ndarray, offsets: np.ndarray) -> dict[int, dict[int, list[tuple[int, float]]]]:
    """Candidates of each document of a block: its items, each with the passages near it and their cosines.

    `flat` holds the ids of all words, `offsets` where each document begins. A passage meets all items in one product of
    its latent vector with theirs; passages whose whole weight is too small for any item are left out before.
    """
    found = _weighed(index.weight, flat, offsets)
    if found is None:
        return {}
    first, starts, ends, term, times, norm = found.first, found.starts, found.ends, found.term, found.times, found.norm
    # A projection is no longer than the passage: the item with the least claim decides.
    claim = np.nanmin(index.least / np.maximum(np.linalg.norm(index.vectors, axis=1), 1e-9))
    out: dict[int, dict[int, list]] = {}
    chosen = np.flatnonzero(norm >= claim)
    for begin in range(0, len(chosen), ROWS):
        part = chosen[begin:begin + ROWS]
        sizes = ends[part] - starts[part]
        where = np.repeat(starts[part] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        latent = np.add.reduceat(times[where, None] * index.latent[term[where]], np.cumsum(sizes) - sizes, axis=0).astype(np.float32)
        dots = latent @ index.vectors.T
        for row, item in zip(*np.nonzero((dots >= index.least) & (dots >= norm[part, None] * index.cosines))):
            number = int(found.passage[part[row]])
            owner = int(np.searchsorted(first, number, side="right") - 1)
            cosine = float(dots[row, item] / (norm[part[row]] * np.linalg.norm(index.vectors[item])))
            out.setdefault(owner, {}).setdefault(int(item), []).append((number - int(first[owner]), cosine))
    return out


def _shares(items: list[tuple[int, list[int]]], numbers: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each term, the items that have it and the share of their words that it makes up: starts by term, items, shares."""
    held = sorted((term, at, count / len(ids)) for at, (_, ids) in zip(numbers.tolist(), items) for term, count in Counter(ids).items())
    found, at, share = (np.array(column) for column in zip(*held))
    return np.searchsorted(found, np.arange(n_terms + 1)), at, share


def _held(index: Index, ids: np.ndarray) -> np.ndarray:
    """Items of whose words enough stand among `ids` at all, in any order: a common subsequence is no longer than that."""
    starts, items, shares = index.shares
    present = np.unique(ids[ids >= 0])
    sizes = starts[present + 1] - starts[present]
    at = np.repeat(starts[present] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    return np.flatnonzero(np.bincount(items[at], shares[at], len(index.items)) >= PARAPHRASE_LCS - 1e-4)


Leak = tuple[int, int, int, float | None, float, float]


def leaks_of(index: Index, flat: np.ndarray, offsets: np.ndarray) -> list[list[Leak]]:
    """For each document of a block (item_id, begin, end, cosine, share, answer share) of each item that leaks into it.

    Begin and end count words. Candidates come from the latent space. An item that it does not hold can't leak where its
    words are missing in a stretch of the text; it is compared wherever they are not, and has no cosine.
    """
    out = []
    near = _near(index, flat, offsets) if np.isfinite(index.least).any() else {}
    reach = max(len(own) for _, own in index.items)
    for doc, (begin, end) in enumerate(zip(offsets[:-1], offsets[1:])):
        ids, found = flat[begin:end], {}
        for item, passages in near.get(doc, {}).items():
            for passage, cosine in passages:
                if leak := _leak(index, ids, item, passage, passage + 1, cosine):
                    found[item] = leak
                    break
        if index.shares and len(ids):
            n_passages = max(1, -(-len(ids) // BLOCK) - 1)
            for first in range(0, n_passages, STRETCH):
                last = min(first + STRETCH, n_passages)
                for item in _held(index, ids[max(0, first * BLOCK - reach):(last + 1) * BLOCK + reach]):
                    if item not in found and (leak := _leak(index, ids, item, first, last, None)):
                        found[item] = leak
        out.append(list(found.values()))
    return out


def leaks_of_batch(index: Index, ids: pa.Array) -> list[list[Leak]]:
    """`leaks_of` the documents of an Arrow column of ids, DOCUMENTS at a time."""
    if not index.items:
        return [[] for _ in range(len(ids))]
    return [found for flat, offsets in _blocks(ids) for found in leaks_of(index, flat, offsets)]


def _leak(index: Index, ids: np.ndarray, item: int, first: int, last: int, cosine: float | None) -> Leak | None:
    """The first leak of an item around the passages from `first` to before `last`."""
    item_id, own = index.items[item]
    n, mask = len(own), index.masks[item]
    begins = np.maximum(0, np.arange(first, last) * BLOCK - n)
    ends = np.minimum(len(ids), (np.arange(first, last) + 2) * BLOCK + n)
    offset = begins[0]
    known = np.zeros(len(index.terms) + 1, dtype=bool)  # the last one is for -1
    known[own] = True
    shared = known[ids[offset:ends[-1]]]
    # Only words of the item count for the subsequence.
    words, here = ids[offset:ends[-1]][shared].tolist(), np.cumsum(np.append(0, shared))
    lows, highs = here[begins - offset], here[ends - offset]
    for at in np.flatnonzero(highs - lows >= PARAPHRASE_LCS * n):
        if common_subsequence(mask, n, words[lows[at]:highs[at]]) < PARAPHRASE_LCS * n:
            continue
        begin, region = int(begins[at]), ids[begins[at]:ends[at]].tolist()
        share, place = _best(mask, n, region)
        if share < PARAPHRASE_LCS:
            continue
        n_last = max(1, round(ANSWER_SHARE * n))
        answer: dict[int, int] = {}
        for bit, term in enumerate(own[-n_last:]):
            answer[term] = answer.get(term, 0) | 1 << bit
        stretch = region[place:place + n + n // 2]
        answered = common_subsequence(answer, n_last, stretch) / n_last
        if share >= LCS or answered >= ANSWER_LCS:
            return item_id, begin + place, begin + place + len(stretch), cosine, share, answered
    return None


def _best(mask: dict[int, int], n: int, region: list[int]) -> tuple[float, int]:
    """The best share of an item in stretches of one and a half times its length, and where that stretch begins."""
    length, step = n + n // 2, max(1, n // 8)
    if common_subsequence(mask, n, region) < PARAPHRASE_LCS * n:
        return 0.0, 0
    starts = range(0, max(1, len(region) - length + step), step)
    best = max(starts, key=lambda s: (common_subsequence(mask, n, region[s:s + length]), -s))
    return common_subsequence(mask, n, region[best:best + length]) / n, best


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that leaks into it: doc_id, item_id, begin, end, cosine, lcs and answer.

    Documents without a leak, null and empty ones have no row. Repeated documents each have theirs, rows without doc_id
    have theirs under a null one, repeated items count once, and an empty benchmark or table gives an empty result.
    """
    index, kind = read_items(benchmark), dict(benchmark.dtypes)["item_id"]
    tokens = tokens_of(index, docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id")
    index = fit(index, tokens)

    def each(batches):
        for batch in batches:
            out = [(doc, *leak) for doc, found in zip(batch.column(0).to_pylist(), leaks_of_batch(index, batch.column(1))) for leak in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate([
                    pa.int64(), pa.string() if kind == "string" else pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()])],
                names=["doc_id", "item_id", "begin", "end", "cosine", "lcs", "answer"])

    return rows_by_batch(tokens, f"doc_id bigint, item_id {kind if kind == 'string' else 'bigint'}, begin bigint, end bigint, "
                         "cosine double, lcs double, answer double", each)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no benchmark item leaks, unchanged. They are written once with their terms."""
    index = read_items(benchmark)
    tokens = tokens_of(index, packed(docs).withColumn("text", F.col("row.text")), "row")
    index = fit(index, tokens)

    def each(batches):
        for batch in batches:
            yield batch.select(["row"]).filter(pa.array([not found for found in leaks_of_batch(index, batch.column(1))], pa.bool_()))

    return unpacked(rows_by_batch(tokens, tokens.select("row").schema, each))
