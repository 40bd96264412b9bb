import random

import numpy as np
from odd import ODD

import corpus_pipeline
from millrace.llm import byte_bpe, decontaminate, line_dedup, quality_rules, simhash
from millrace.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ITEM = ("the river that turned at noon kept seven green boats under its old bridge while the keeper counted lanterns and "
        "wrote that the ninth lantern was always cold")


def test_leaks_equal_containment(spark):
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda text: " " + " ".join(w for w in map(decontaminate.normal, text.split()) if w) + " "
    items = {row.item_id: plain(row.text) for row in benchmark.collect()}
    want = {(row.doc_id, item) for row in docs.collect() for item, words in items.items() if words in plain(row.text)}
    got = {(row.doc_id, row.item_id) for row in decontaminate.leaks(docs, benchmark).collect()}
    assert want and want <= got and len(got - want) <= len(want) // 10


def test_paraphrases_and_clean_documents(documents, spark):
    rng = random.Random(2)
    filler = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("al", "en", "ir", "om", "us", "ey")]
    noise = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    words = ITEM.split()
    near = " ".join(w for i, w in enumerate(words) if i % 6 != 2)
    texts = [*ODD, noise(300), f"{noise(100)} {ITEM.upper()}! {noise(90)}", f"{noise(40)} {near} {noise(200)}",
             f"{noise(50)} {' '.join(words[:8])} {noise(50)}", noise(30), f"{noise(20)} {' '.join(sorted(words))} {noise(20)}"]
    benchmark = spark.createDataFrame([(1, ITEM), (2, "wholly other things that nobody here has ever said about mountains"),
                                       (3, None), (4, ""), (1, ITEM)], "item_id bigint, text string")
    found = decontaminate.leaks(documents(texts), benchmark).collect()
    n = len(ODD)
    assert {(row.doc_id, row.item_id) for row in found} == {(n + 1, 1), (n + 2, 1)}
    left = decontaminate.clean(documents(texts), benchmark)
    assert {row.doc_id for row in left.collect()} == set(range(len(texts))) - {n + 1, n + 2}
    nothing = benchmark.limit(0)
    assert decontaminate.leaks(documents(texts), nothing).count() == 0 == decontaminate.leaks(documents([]), benchmark).count()
    assert decontaminate.clean(documents(texts), nothing).count() == len(texts)


def all_leaks(index, ids):
    """Leaks by comparing every item with every passage: no retrieval and no bound on shared words."""
    out = set()
    for (item, own), mask in zip(index.items, index.masks):
        n, last = len(own), max(1, round(decontaminate.ANSWER_SHARE * len(own)))
        answer = {}
        for place, term in enumerate(own[-last:]):
            answer[term] = answer.get(term, 0) | 1 << place
        for first in range(max(1, -(-len(ids) // decontaminate.BLOCK) - 1)):
            region = ids[max(0, first * decontaminate.BLOCK - n):(first + 2) * decontaminate.BLOCK + n]
            share, at = decontaminate._best(mask, n, region)
            answered = decontaminate.common_subsequence(answer, last, region[at:at + n + n // 2]) / last
            if share >= decontaminate.LCS or share >= decontaminate.PARAPHRASE_LCS and answered >= decontaminate.ANSWER_LCS:
                out.add(item)
    return out


def test_no_leak_is_lost_in_a_large_benchmark(documents, spark):
    """900 items, more than dimensions of any decomposition here: copies and paraphrases in every document."""
    rng = random.Random(6)
    spoken = [f"{a}{b}{c}{d}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lnrst" for d in ("ak", "em", "ip", "ol", "uf")]
    draw = lambda n: [spoken[int(len(spoken) * rng.random() ** 2)] for _ in range(n)]
    items = [draw(rng.randrange(12, 50)) for _ in range(900)]
    texts = []
    for at, words in enumerate(items):
        far = items[at - 7]
        near = [w if i % 4 or i > 0.7 * len(far) else "unheard" for i, w in enumerate(far)]  # a paraphrase that keeps the answer
        texts.append(" ".join([*draw(rng.randrange(40)), *words, *draw(rng.randrange(40)), *near, *draw(rng.randrange(40))]))
    texts.append(" ".join(draw(3000) + items[5] + draw(500)))
    docs = documents(texts)
    benchmark = spark.createDataFrame([(i, " ".join(ws)) for i, ws in enumerate(items)], "item_id bigint, text string")
    got = {(row.doc_id, row.item_id) for row in decontaminate.leaks(docs, benchmark).collect()}
    assert {(i, i) for i in range(900)} <= got
    index = decontaminate.build_index(docs, benchmark)
    assert np.isfinite(index.least).sum() > 500  # most items are searched for in the latent space, the rest is not lost
    for doc in [*range(0, 900, 45), 900]:
        assert {item for i, item in got if i == doc} == all_leaks(index, index.ids(texts[doc]).tolist())


def test_short_items_and_documents_without_id(documents, spark):
    """Items of a few words are no passages: documents that hold them stay. Rows without doc_id and repeated ones leak."""
    texts = [(None, f"so {ITEM} it was"), (4, f"so {ITEM} it was"), (4, f"so {ITEM} it was"), (5, "the keeper counted the lanterns"), (6, None)]
    benchmark = spark.createDataFrame([(1, ITEM), (2, "the"), (3, "the keeper counted the lanterns")], "item_id bigint, text string")
    found = decontaminate.leaks(documents(texts), benchmark).collect()
    assert sorted((str(row.doc_id), row.item_id) for row in found) == [("4", 1), ("4", 1), ("None", 1)]
    assert all(row.lcs == 1.0 and row.end - row.begin >= len(ITEM.split()) for row in found)
    assert sorted(row.doc_id for row in decontaminate.clean(documents(texts), benchmark).collect()) == [5, 6]


def test_recall_with_many_items(spark):
    """Stand-ins cut from documents beside the benchmark, more items than documents in the sample: recall against all pairs."""
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {row.doc_id: row.text for row in docs.collect()}
    rng = random.Random(9)
    items = [(row.item_id, row.text) for row in benchmark.collect()]
    for text in [t for _, t in sorted(texts.items()) if len(t.split()) > 80][:400]:
        words = text.split()
        at = rng.randrange(len(words) - 60)
        items.append((1000 + len(items), " ".join(w for w in words[at:at + rng.randrange(15, 60)] if rng.random() > 0.15)))
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    few = docs.where("doc_id % 25 = 3")
    got = {(row.doc_id, row.item_id) for row in decontaminate.leaks(few, asked).collect()}
    index = decontaminate.read_items(asked)
    want = {(row.doc_id, item) for row in few.collect() for item in all_leaks(index, index.ids(row.text).tolist())}
    assert len(want) > 10 and got <= want and len(got) >= 0.95 * len(want)


def passage_vectors(index, texts):
    """Unit TF-IDF rows of all passages of all texts, one passage at a time."""
    block, out = decontaminate.BLOCK, []
    for ids in map(index.ids, texts):
        for begin in range(0, max(1, len(ids) - block), block):
            row = np.zeros(len(index.terms))
            for term in ids[begin:begin + 2 * block]:
                if term >= 0:
                    row[term] += index.weight[term]
            if row.any():
                out.append(row / np.linalg.norm(row))
    return np.array(out)


def held_of_best(index, docs):
    """What the latent space holds of all passages and items, as a share of what the best one of its size holds."""
    rows = passage_vectors(index, [row.text or "" for row in docs.collect()])
    own = decontaminate._rows([np.array(ids, dtype=np.int32) for _, ids in index.items], index.weight)
    want = rows.T @ rows * (len(own) / (5 * len(rows))) + own.T @ own
    weight = np.where(index.weight > 0, index.weight, 1)[:, None]
    basis = np.linalg.qr(index.latent / weight)[0]
    assert len(index.terms) > 2 * basis.shape[1]  # a space of all terms would hold everything
    return np.trace(basis.T @ want @ basis) / np.linalg.eigvalsh(want)[::-1][:basis.shape[1]].sum()


def test_the_latent_space_is_that_of_all_documents(spark):
    """Over 500 texts, and repeated ones, which count each time."""
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.union(docs.where("doc_id < 30"))
    assert held_of_best(decontaminate.build_index(docs, benchmark), docs) >= 0.995


def test_the_stage_fits_on_all_its_documents(spark, monkeypatch):
    fitted, fit = [], decontaminate.fit
    monkeypatch.setattr(decontaminate, "fit", lambda index, tokens: fitted.append(fit(index, tokens)) or fitted[-1])
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    corpus_pipeline.benchmark_stage(spark, docs, "/root/testdata/sf0.01")
    assert len(fitted) == 1 and held_of_best(fitted[0], docs) >= 0.995


def test_subsequences_against_a_table():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        mask = {}
        for i, x in enumerate(a):
            mask[x] = mask.get(x, 0) | 1 << i
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_subsequence(mask, len(a), b) == best[-1][-1]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, FOLDER)
        assert after.schema == kept.schema
        kept = after
    rules = {row.doc_id for row in quality_rules.quality_rules(docs).where("kept").collect()}
    first = docs.where(docs.doc_id.isin(list(rules)))
    lines = line_dedup.cleaned(first)
    groups = simhash.near_duplicates(lines).where("doc_id = component_id")
    single = lines.join(groups.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    leaked = decontaminate.leaks(single, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).select("doc_id")
    last = single.join(leaked, "doc_id", "left_anti")
    want = byte_bpe.round_trip(last, byte_bpe_file(), pattern()).collect()
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and 0 < len(got) < docs.count()


def byte_bpe_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


def test_every_query_has_one_row_per_document(spark):
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    for name in ("op3_line_dedup", "op6_sharding"):
        assert QUERIES[name](spark, FOLDER).count() == n
