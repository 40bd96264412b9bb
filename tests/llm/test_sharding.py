import zlib

from odd import ODD

from millrace.llm import sharding


def check(frame, texts, spread):
    rows = sharding.shard(frame).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(doc) for doc, _ in texts)
    by_shard = {s: sorted(r.slot for r in rows if r.shard == s) for s in {r.shard for r in rows}}
    assert set(by_shard) <= set(range(8)) and all(slots == list(range(len(slots))) for slots in by_shard.values())
    whole = dict(texts)
    for r in rows:
        data = (whole[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= spread
    return rows


def test_corpus(corpus, texts):
    largest = max(len(t.encode()) for t in texts.values())
    check(corpus, list(texts.items()), 2 * largest)


def test_one_text_with_a_third_of_the_rows(documents):
    texts = [(i, "copy of one text") if i % 3 == 0 else (i, f"text {i} " + "x" * (i % 7)) for i in range(900)]
    rows = check(documents(texts), texts, 200)
    # Equal texts stay together up to the ends of shards, in order of doc_id.
    copies = sorted((r.shard, r.slot, r.doc_id) for r in rows if r.doc_id % 3 == 0)
    assert [doc for _, _, doc in copies] == sorted(doc for _, _, doc in copies)
    assert len({s for s, _, _ in copies}) <= 5


def test_odd_tables(documents):
    check(documents(ODD), list(enumerate(ODD)), 10**9)
    check(documents([(None, "a"), (1, None)]), [(None, "a"), (1, None)], 10)
    rows = check(documents([(4, "same")] * 50), [(4, "same")] * 50, 5)
    assert sorted({r.shard for r in rows}) == list(range(8))
    assert sharding.shard(documents([])).count() == 0


def test_one_row_repeated_a_third_of_the_time(documents):
    """Rows that agree in doc_id and text are split like any others; so are those without doc_id."""
    for doc in (5, None):
        texts = [(doc, "the same text of one document")] * 1000 + [(i, f"text {i} " + "x" * (i % 20)) for i in range(10, 2010)]
        check(documents(texts), texts, 120)
