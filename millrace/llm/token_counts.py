"""Exact token counts of every prefix of a text, by dynamic programming over the last token of each prefix."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.common import by_batch

#: Words, and as many prefixes of words, that a worker remembers, and the longest of them; a full table is emptied.
KEPT_WORDS, KEPT_LENGTH = 500_000, 64
SPACE = "▁"
_RUNS = re.compile(" +[^ ]*")


class PrefixCounter:
    """Counts the tokens that a merge model with byte fallback gives every prefix of a text.

    The model merges the neighbours whose union has the best score, leftmost first. Then a row of tokens is the
    encoding of its text if each two neighbours in it are the encoding of theirs, and exactly one token can come last
    in the encoding of a prefix. So `last token of a prefix` follows from those of shorter prefixes, and its count is
    one more than that of the prefix before it. No token has a space mark after another character, so words are counted
    by themselves, each distinct one once.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        names = range(model.get_piece_size())
        self.score = {model.id_to_piece(i): model.get_score(i) for i in names
                      if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.score):
            raise ValueError("words can't be counted by themselves: the model has pieces that reach over a space")
        self.halves = {}  # what is merged last into each piece that merging can reach
        for piece in self.score:
            *before, parts = self._merges(piece)
            if len(parts) == 1:
                self.halves[piece] = tuple(before[-1]) if before else (piece, piece)
        self.pieces = self.halves.keys()
        self.rank = {p: -1.0 if len(p) == 1 else -score for p, score in self.score.items()}
        self.endings: dict = {}  # a tree of the pieces from their ends; "" holds the piece
        for piece in self.pieces:
            node = self.endings
            for letter in reversed(piece):
                node = node.setdefault(letter, {})
            node[""] = piece
        self.reach = max(map(len, self.pieces), default=1)
        self.fits: dict[tuple[str, str], bool] = {}
        self.prefixes: dict[str, tuple[str, int, bytes]] = {"": ("", 0, b"")}
        self.words = _Words(self)

    def _merges(self, text: str) -> list[list[str]]:
        """The parts of a text before each merge, and at the end."""
        parts, score = list(text), self.score
        steps = [parts]
        while True:
            found = [(score[u], -i) for i, u in enumerate(map(str.__add__, parts, parts[1:])) if u in score]
            if not found:
                return steps
            at = -max(found)[1]
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2:]]
            steps.append(parts)

    def _fit(self, left: str, right: str) -> bool:
        """Whether two pieces side by side are the encoding of their text.

        Takes the merges of both back, the latest first. Pieces that face each other at the border must not have had
        a union to merge into before the one that was just taken back.
        """
        rank, limit = self.rank, float("inf")
        while True:
            joined = rank.get(left + right)
            if joined is not None and joined < limit:
                return False
            if rank[left] > rank[right]:
                limit, left = rank[left], self.halves[left][1]
            elif len(right) > 1:
                limit, right = rank[right] + 1, self.halves[right][0]
            else:
                return True

    def _last(self, word: str, end: int, last: dict[int, str]) -> str:
        """The last token of the first `end` characters; empty if the last character is in no piece."""
        found, node, at = [], self.endings, end
        while at and (node := node.get(word[at - 1])) is not None:
            at -= 1
            if "" in node:
                found.append(node[""])
        for piece in reversed(found):
            left = last[end - len(piece)]
            if not left:
                return piece
            fit = self.fits.get((left, piece))
            if fit is None:
                fit = self.fits[left, piece] = self._fit(left, piece)
            if fit:
                return piece
        return ""

    def word_steps(self, word: str) -> bytes:
        """The change of the count with each character of a word, as signed bytes; the steps of its prefixes are kept."""
        known, n = self.prefixes, len(word)
        kept, begin = n <= KEPT_LENGTH, 0
        if kept:
            begin = n
            while word[:begin] not in known:
                begin -= 1
        last, counts = {0: ""}, {0: 0}
        for end in range(max(0, begin + 1 - self.reach), begin + 1):
            last[end], counts[end], steps = known[word[:end]]
        steps = bytearray(steps)
        for end in range(begin + 1, n + 1):
            piece = last[end] = self._last(word, end, last)
            added = 1 if piece else len(word[end - 1].encode("utf-8", "surrogatepass"))
            count = counts[end] = counts[end - (len(piece) or 1)] + added
            steps.append((count - counts[end - 1]) & 0xFF)
            if kept:
                known[word[:end]] = piece, count, bytes(steps)
        if len(known) > KEPT_WORDS:
            self.prefixes = {"": known[""]}
        return bytes(steps)

    def steps(self, text: str) -> np.ndarray:
        """The change of the token count with each character of a text; their running sum is the count of each prefix."""
        if not text:
            return np.zeros(0, dtype=np.int8)
        text = text.replace(SPACE, " ")
        words = text.split(" ")
        if "  " in text or text[0] == " ":  # spaces in a row can be one piece
            words = [w[1:] for w in _RUNS.findall(" " + text)]
        found = np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype=np.int8)
        # The model puts a space before the text; it counts with the first character.
        steps = found[1:].copy()
        steps[0] += found[0]
        return steps


class _Words(dict):
    """Steps of words, worked out when first asked for."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> bytes:
        found = self.counter.word_steps(SPACE + word.replace(" ", SPACE))
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found


_LOADED: dict[str, PrefixCounter] = {}


def loaded(model_file: str) -> PrefixCounter:
    """One counter for each worker process."""
    if model_file not in _LOADED:
        _LOADED[model_file] = PrefixCounter(model_file)
    return _LOADED[model_file]


def prefix_table(docs: DataFrame, model_file: str, *passed: str) -> DataFrame:
    """The columns in `passed` and `steps`, one signed byte a character, of every whole text.

    The token count of the first k characters is the sum of the first k steps. Null and empty texts have no steps.
    """
    return by_batch(docs, "steps binary", lambda texts: {"steps": [loaded(model_file).steps(t).tobytes() for t in texts]}, *passed)


def answers(table: DataFrame, budget: int, *passed: str) -> DataFrame:
    """From a prefix table: `n_tokens`, and `cut`, the longest prefix in characters of `budget` tokens at most."""
    def each(batches):
        import pyarrow as pa
        for batch in batches:
            totals, cuts = [], []
            for steps in batch.column(batch.num_columns - 1).to_pylist():
                total, cut = _answer(np.frombuffer(steps or b"", dtype=np.int8), budget)
                totals.append(total)
                cuts.append(cut)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(totals, pa.int64()), pa.array(cuts, pa.int64())],
                names=[*batch.schema.names[:-1], "n_tokens", "cut"])

    kept = table.select(*passed, "steps")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(each, ", ".join([*fields, "n_tokens bigint", "cut bigint"]))


def _answer(steps: np.ndarray, budget: int) -> tuple[int, int]:
    counts = np.cumsum(steps, dtype=np.int64)
    if not len(counts):
        return 0, 0
    if counts[-1] <= budget:
        return int(counts[-1]), len(counts)
    within = np.flatnonzero(counts <= budget)
    return int(counts[-1]), int(within[-1]) + 1 if len(within) else 0


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and cut of every document.

    `cut` is the length in characters of the longest prefix that keeps to the limit. Null texts count as empty: no
    bytes, no tokens. Repeated rows stay repeated.
    """
    def work(texts):
        counter = loaded(model_file)
        out = {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": [], "over_limit": [], "cut": []}
        for text in texts:
            total, cut = _answer(counter.steps(text), limit)
            out["n_tokens"].append(total)
            out["over_limit"].append(total > limit)
            out["cut"].append(cut)
        return out

    return by_batch(docs, "n_bytes bigint, n_tokens bigint, over_limit boolean, cut bigint", work, "doc_id")
