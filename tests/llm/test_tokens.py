import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from odd import ODD

from millrace.llm import byte_bpe, token_counts

RANKS, PIECES, PATTERN = (
    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def mixtures(n, seed=3):
    rng = random.Random(seed)
    letters = [*"ab The's\n\t  \r.,!19$é　\x85\x1c\x0bßΩ漢🙂é​▁", "<s>", "<|endoftext|>", "<0x0A>", "    "]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_ids_are_those_of_the_ranks(reference, texts, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", 500)  # the table of words is emptied now and then
    codec = byte_bpe.ByteBpe(RANKS, PATTERN)
    every = [*list(texts.values())[:60], *(t or "" for t in ODD), *mixtures(4000), "".join(map(chr, range(0x2000, 0x3100)))]
    for text, packed in zip(every, codec.encode(every)):
        ids = np.frombuffer(packed, dtype="<u4")
        assert ids.tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_offsets_cover_split_characters():
    codec = byte_bpe.ByteBpe(RANKS, PATTERN)
    for text in ["", "plain words", "a🙂b 漢字 é", *mixtures(300)]:
        ids = np.frombuffer(codec.encode([text])[0], dtype="<u4")
        begins, ends, split = codec.offsets(ids, text.encode())
        at, splits = 0, 0
        for token, begin, end in zip(ids, begins, ends):
            data = text.encode()
            splits += data[at] & 0xC0 == 0x80
            assert begin == len(data[:at].decode("utf-8", "ignore"))
            at += len(codec.bytes_of[token])
            assert text[begin:end].encode().find(codec.bytes_of[token]) >= 0
        assert split == splits


def test_round_trip(documents, reference):
    rows = byte_bpe.round_trip(documents(ODD), RANKS, PATTERN).collect()
    for row in rows:
        text = ODD[row.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert (row.n_tokens, row.ends_at) == (len(ids), len(text))
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoded = byte_bpe.encode(documents(ODD), RANKS, PATTERN, "doc_id")
    assert {row.doc_id: row.text for row in byte_bpe.decode(encoded, RANKS, PATTERN, "doc_id").collect()} == {
        doc: text or "" for doc, text in enumerate(ODD)}
    assert len(rows) == len(ODD) and byte_bpe.round_trip(documents([]), RANKS, PATTERN).count() == 0


def test_every_prefix_has_its_count(pieces, texts, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 50)
    counter = token_counts.PrefixCounter(PIECES)
    for text in [*mixtures(1500), *(t[:150] for t in list(texts.values())[:40]), "a" * 150, " " * 40 + "x" * 90, "ab" * 70]:
        counts = np.cumsum(counter.steps(text), dtype=int).tolist()
        assert counts == [len(ids) for ids in pieces.encode([text[:k + 1] for k in range(len(text))], num_threads=1)]


def test_counts(documents, pieces, corpus, texts):
    for frame, wanted in ((documents(ODD), dict(enumerate(ODD))), (corpus, texts)):
        rows = token_counts.token_counts(frame, PIECES, 1000).collect()
        assert len(rows) == len(wanted)
        for row in rows:
            text = wanted[row.doc_id] or ""
            n = len(pieces.encode(text))
            assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 1000)
            assert len(pieces.encode(text[:row.cut])) <= 1000 and (row.cut == len(text) or n > 1000)
            if row.cut < len(text):
                assert len(pieces.encode(text[:row.cut + 1])) > 1000
    table = token_counts.prefix_table(documents(ODD), PIECES, "doc_id")
    assert {r.doc_id: r.n_tokens for r in token_counts.answers(table, 10, "doc_id").collect()} == {
        doc: len(pieces.encode(text or "")) for doc, text in enumerate(ODD)}
    assert token_counts.token_counts(documents([]), PIECES).count() == 0
