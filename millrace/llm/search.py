"""Ranked lexical search of many queries at once: sums of terms that queries share are computed once for each document."""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, rows_by_batch, whole_text

#: Fixed values of the score: length share in percent, scale of parts and of weights.
LENGTH_SHARE, PART_SCALE, WEIGHT_SCALE = 75, 1_000_000_000, 1000
#: Items that share one graph, symbols of an item that are searched for shared pairs, documents whose sums a task holds.
GRAPH_ITEMS, MINED, BLOCK = 512, 64, 512
#: ASCII bytes that are no part of a term become spaces; A to Z become small letters.
_SPACED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text: maximal runs of ASCII letters, digits and all other characters beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_SPACED).split()


@dataclass
class Graph:
    """Sums that a group of items shares. Row i below len(leaves) is a term times its repeats in an item; each further
    row adds two earlier rows; each item adds its rows."""

    leaves: list[tuple[int, int]]
    nodes: list[tuple[int, int]] = field(default_factory=list)
    items: list[tuple[int, list[int]]] = field(default_factory=list)


def shared_sums(items: list[tuple[int, Counter]]) -> Graph:
    """The graph of items (number, terms with repeats): the pair of rows that most items hold becomes a row of its own,
    until no two items share a pair.

    Of an item with more than MINED rows that others hold too, the most widely held ones are searched for pairs; the rest
    are added as they are, so this bounds the search and leaves the sums whole.
    """
    held = Counter(leaf for _, terms in items for leaf in terms.items())
    leaves = sorted(held)
    row = {leaf: i for i, leaf in enumerate(leaves)}
    open_rows, rest = [], []
    for _, terms in items:
        rows = sorted((leaf for leaf in terms.items() if held[leaf] > 1), key=lambda leaf: (-held[leaf], leaf))
        open_rows.append({row[leaf] for leaf in rows[:MINED]})
        rest.append([row[leaf] for leaf in terms.items() if row[leaf] not in open_rows[-1]])
    pairs, holders = Counter(), defaultdict(set)
    for at, rows in enumerate(open_rows):
        ordered = sorted(rows)
        for k, a in enumerate(ordered):
            holders[a].add(at)
            pairs.update((a, b) for b in ordered[k + 1:])
    heap = [(-n, pair) for pair, n in pairs.items() if n > 1]
    heapq.heapify(heap)
    graph = Graph(leaves)
    while heap:
        n, pair = heapq.heappop(heap)
        if pairs[pair] != -n:
            if pairs[pair] > 1:
                heapq.heappush(heap, (-pairs[pair], pair))
            continue
        a, b = pair
        made = len(leaves) + len(graph.nodes)
        graph.nodes.append(pair)
        for at in holders[a] & holders[b]:
            rows = open_rows[at]
            rows -= {a, b}
            for other in rows:
                for gone in (a, b):
                    pairs[min(gone, other), max(gone, other)] -= 1
                new = (other, made)
                pairs[new] += 1
                if pairs[new] == 2:
                    heapq.heappush(heap, (-2, new))
            pairs[pair] -= 1
            rows.add(made)
            holders[a].discard(at)
            holders[b].discard(at)
            holders[made].add(at)
    graph.items = [(number, sorted(rows) + more) for (number, _), rows, more in zip(items, open_rows, rest)]
    return graph


@dataclass
class Queries:
    """The items of a benchmark: their ids, the terms they hold, and the graphs that add up their scores."""

    ids: list
    terms: dict[bytes, int]
    graphs: list[Graph]


def read_queries(benchmark: DataFrame) -> Queries:
    """`benchmark` (item_id, text) as the stated query set; rows that agree in both count once, each other one ranks for
    itself. Items without terms are left out."""
    rows = benchmark.select("item_id", whole_text().alias("text")).distinct().orderBy("item_id", "text").collect()
    items = [(r["item_id"], Counter(terms_of(r["text"]))) for r in rows]
    items = [(i, terms) for i, terms in items if terms]
    known = {t: n for n, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    numbered = [(at, Counter({known[t]: n for t, n in terms.items()})) for at, (_, terms) in enumerate(items)]
    return Queries([i for i, _ in items], known,
                   [shared_sums(numbered[at:at + GRAPH_ITEMS]) for at in range(0, len(numbered), GRAPH_ITEMS)])


def postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """`doc_id`, `n`, the number of terms of the whole text, and the numbers `ids` of query terms in it with the
    occurrences `tfs` of each."""
    def each(batches):
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                found = Counter(i for i in map(terms.get, words) if i is not None)
                n.append(len(words))
                ids.append([*found.keys()])
                tfs.append([*found.values()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "ids", "tfs"])

    return rows_by_batch(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")),
                         "doc_id bigint, n bigint, ids array<int>, tfs array<bigint>", each)


def weights(found: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """The weight of each query term, the number of documents with a term, and their terms, over all postings."""
    total = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).head()
    held = np.zeros(n_terms, dtype=np.int64)
    # One row per term of the query set.
    for row in found.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        held[row["id"]] = row["count"]
    n = total["docs"]
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in held], dtype=np.int64), n, total["terms"]


class Best:
    """The `most` best rows of one item so far: score descending, then doc_id ascending (null last)."""

    def __init__(self, most: int):
        self.most, self.least, self.rows = most, 1, []

    def add(self, scores: np.ndarray, docs: list) -> None:
        self.rows += [(-int(s), doc is None, doc or 0) for s, doc in zip(scores, docs)]
        if len(self.rows) >= 4 * self.most:
            self.trim()

    def trim(self) -> list:
        self.rows = sorted(self.rows)[:self.most]
        if len(self.rows) == self.most:
            self.least = -self.rows[-1][0]
        return self.rows


def ranked(docs: DataFrame, benchmark: DataFrame, most: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the `most` best documents of each benchmark item.

    Documents are read once, into postings of query terms. A task then holds a block of documents at a time: it fills one
    row of the graph for each term, adds shared rows once, and every item takes what is there. It passes on its own best
    rows of each item, so few rows are shuffled and ranked by item.

    Null and empty texts have no terms and never rank; items without terms have no rows, nor have items none of whose
    terms occur. Repeated documents rank side by side; equal scores go by doc_id, null last; empty tables give an empty result.
    """
    queries = read_queries(benchmark)
    kind = dict(benchmark.dtypes)["item_id"]
    found = materialise(postings(docs, queries.terms), "postings")
    weight, n_docs, n_terms = weights(found, len(queries.terms))

    def each(batches):
        best = [Best(most) for _ in queries.ids]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                score_block(queries, batch.slice(at, BLOCK), weight, n_docs, n_terms, best)
        rows = [(item, None if missing else doc, -score) for item, b in enumerate(best) for score, missing, doc in b.trim()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                         names=["item", "doc_id", "score"])

    local = rows_by_batch(found.where("size(ids) > 0"), "item int, doc_id bigint, score bigint", each)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    # One row per item of the query set.
    names = docs.sparkSession.createDataFrame([*enumerate(queries.ids)], f"item int, item_id {kind}")
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def score_block(queries: Queries, block: pa.RecordBatch, weight: np.ndarray, n_docs: int, n_terms: int, best: list[Best]) -> None:
    """Adds the documents of a block to the best rows of each item."""
    docs = block.column(0).to_pylist()
    # Whole numbers of any size: lengths times documents pass 64 bits on large corpora.
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms for n in block.column(1).to_pylist()], dtype=np.int64)
    ids, tfs = block.column(2).flatten().to_numpy(), block.column(3).flatten().to_numpy()
    owner = np.repeat(np.arange(len(docs)), np.diff(block.column(2).offsets.to_numpy()))
    base = np.zeros((len(weight), len(docs)), dtype=np.int64)
    base[ids, owner] = weight[ids] * ((PART_SCALE * tfs) // (1000 * tfs + 8 * m[owner]))
    for graph in queries.graphs:
        first = len(graph.leaves)
        sums = np.empty((first + len(graph.nodes), len(docs)), dtype=np.int64)
        leaves = np.array(graph.leaves, dtype=np.int64)
        np.multiply(base[leaves[:, 0]], leaves[:, 1:], out=sums[:first])
        for k, (a, b) in enumerate(graph.nodes):
            np.add(sums[a], sums[b], out=sums[first + k])
        for item, rows in graph.items:
            score = sums[rows[0]] if len(rows) == 1 else sums[rows].sum(axis=0)
            good = np.flatnonzero(score >= best[item].least)
            if len(good):
                best[item].add(score[good], [docs[i] for i in good])


def ranked_sql(most: int = 10) -> str:
    """`ranked` of documents and benchmark, in SQL."""
    capitals, small = (("ABCDEFGHIJKLMNOPQRSTUVWXYZ").lower() if low else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for low in (0, 1))
    words = lambda text: rf"unnest(regexp_extract_all(translate({text}, '{capitals}', '{small}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
    items AS (SELECT row_number() OVER () AS iid, item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
    words AS (SELECT rid, {words('text')} AS term FROM docs),
    tfs AS (SELECT rid, term, count(*) AS tf FROM words GROUP BY ALL),
    lengths AS (SELECT rid, sum(tf)::BIGINT AS n FROM tfs GROUP BY rid),
    total AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM lengths),
    asked AS (SELECT iid, term, count(*) AS times FROM (SELECT iid, {words('text')} AS term FROM items) GROUP BY ALL),
    held AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
    weighed AS (SELECT term, floor({WEIGHT_SCALE} * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM held, total),
    scored AS (SELECT iid, rid, sum(times * w * (({PART_SCALE} * tf) // (1000 * tf + 8 * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * nd) // l))))::BIGINT AS score
               FROM asked JOIN weighed USING (term) JOIN tfs USING (term) JOIN lengths USING (rid), total GROUP BY ALL),
    placed AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
               FROM scored JOIN docs USING (rid) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed JOIN items USING (iid) WHERE rank <= {most}"""
