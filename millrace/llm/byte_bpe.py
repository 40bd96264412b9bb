"""Byte-level BPE: ids, character offsets and the way back, with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from array import array
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.common import by_batch

#: Words a worker remembers, and the longest of them; the table is emptied when it is full.
KEPT_WORDS, KEPT_LENGTH = 800_000, 64
#: Characters with the property White_Space. Fixed values.
SPACES = (" \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")
_CUT = re.compile(f" (?=[^{SPACES}])")


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabularies of this kind.

    Printable bytes stand for themselves, the rest are numbered upwards from code point 256.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class ByteBpe:
    """Encodes texts by a file of ranks; texts are cut at the matches of `pattern`, special strings are plain text.

    A space before a character that is no white space always begins a match, so the stretches between such spaces are
    encoded by themselves, each distinct one once, and their ids are strung together.
    """

    def __init__(self, ranks_file: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = {}
        for line in Path(ranks_file).read_bytes().splitlines():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
        letters = byte_characters()
        spelled = {token: "".join(letters[b] for b in token) for token in ranks}
        # Two neighbours merge whenever their union is a token, the union of the lowest rank first.
        merges = [(spelled[token[:i]], spelled[token[i:]])
                  for token, _ in sorted(ranks.items(), key=lambda x: x[1])
                  for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        model = models.BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        reverse = {c: b for b, c in enumerate(letters)}
        by_rank = {rank: bytes(reverse[c] for c in spelled[token]) for token, rank in ranks.items()}
        self.bytes_of = [by_rank.get(i, b"") for i in range(max(by_rank, default=-1) + 1)]
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.words: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        first, *words = text.split(" ")
        found = list(map(self.words.get, words))
        new = {w for w, f in zip(words, found) if f is None} if None in found else ()
        if any(not w or w[0] in SPACES for w in new):  # spaces in a row, or before other white space
            first, *words = _CUT.split(text)
            found = list(map(self.words.get, words))
            new = {w for w, f in zip(words, found) if f is None}
        fresh = self.tokenizer.encode_batch_fast([first, *(" " + w for w in new)], add_special_tokens=False)
        ids = [array("I", f.ids).tobytes() for f in fresh]
        if new:
            learned = dict(zip(new, ids[1:]))
            found = [f or learned[w] for w, f in zip(words, found)]
            if len(self.words) + len(learned) > KEPT_WORDS:
                self.words.clear()
            self.words.update((w, f) for w, f in learned.items() if len(w) <= KEPT_LENGTH)
        return ids[0] + b"".join(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return [self._encode(text) for text in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; a character that tokens split comes back whole once its tokens stand together."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """Begin and end of each token in characters, and how many tokens begin inside a character.

        A token that holds a part of a character covers that character.
        """
        ends = np.cumsum(self.lengths[ids])
        begins = ends - self.lengths[ids]
        first = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(first)])  # characters begun before each byte
        inside = ~first[begins] if len(ids) else first[:0]
        return before[begins] - inside, before[ends], int(inside.sum())


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(ranks_file: str, pattern: str) -> ByteBpe:
    """One encoder for each worker process."""
    if (ranks_file, pattern) not in _LOADED:
        _LOADED[ranks_file, pattern] = ByteBpe(ranks_file, pattern)
    return _LOADED[ranks_file, pattern]


def encode(docs: DataFrame, ranks_file: str, pattern: str, *passed: str) -> DataFrame:
    """The columns in `passed`, `ids`, `begins` and `ends` (characters) of every whole text; a null text is empty."""
    def work(texts):
        codec, out = loaded(ranks_file, pattern), {"ids": [], "begins": [], "ends": []}
        for text, packed in zip(texts, codec.encode(texts)):
            ids = np.frombuffer(packed, dtype="<u4")
            begins, ends, _ = codec.offsets(ids, text.encode())
            out["ids"].append(ids.astype(np.int32))
            out["begins"].append(begins.astype(np.int32))
            out["ends"].append(ends.astype(np.int32))
        return out

    return by_batch(docs, "ids array<int>, begins array<int>, ends array<int>", work, *passed)


def decode(encoded: DataFrame, ranks_file: str, pattern: str, *passed: str) -> DataFrame:
    """The columns in `passed` and `text` of `ids`; bytes that form no character become U+FFFD."""
    from pyspark.sql import functions as F

    def work(lists):
        codec = loaded(ranks_file, pattern)
        return {"text": [codec.decode(np.array(json.loads(x or "[]"), dtype=np.int64)).decode("utf-8", "replace") for x in lists]}

    return by_batch(encoded.withColumn("_ids", F.to_json("ids")), "text string", work, *passed, text="_ids")


def round_trip(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and of the decoded bytes, n_split and ends_at of every document.

    `n_split` counts tokens that begin inside a character, `ends_at` is the end offset of the last token in characters.
    Null and empty texts have no tokens; repeated rows stay repeated.
    """
    def work(texts):
        codec = loaded(ranks_file, pattern)
        out = {name: [] for name in ("n_tokens", "ids_sha256", "decoded_sha256", "n_split", "ends_at")}
        for packed in codec.encode(texts):
            ids = np.frombuffer(packed, dtype="<u4")
            data = codec.decode(ids)
            _, ends, split = codec.offsets(ids, data)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(data).hexdigest())
            out["n_split"].append(split)
            out["ends_at"].append(int(ends[-1]) if len(ids) else 0)
        return out

    return by_batch(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split bigint, ends_at bigint", work, "doc_id")
