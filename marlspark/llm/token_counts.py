"""Tokens of whole texts under a unigram vocabulary, counted without making the tokens.

Aho-Corasick finds all vocabulary pieces that end at a place; a Viterbi recursion carries the best score and the number
of pieces of the path that has it. Rules are those of the unigram tokenizers: starts are looked at in ascending order
and only a better score wins, so of equal paths into a place the one with the longest last piece stays; a character
without a piece of its own costs 10 more than the worst piece and, with byte fallback, counts as its UTF-8 bytes;
sums are doubles and start anew in each word. The counts are those of the tokenizer that ``tokenizer`` makes of the same
vocabulary (Unigram with the Metaspace splitter: spaces become the mark U+2581, one is put before a text that has none,
and a word goes from a mark to the next).

The recursion is run once for each distinct word of a worker, and sums are taken. Words of more than 64 characters are
not kept, so what a worker keeps is bounded in bytes too.

Defined results: a null or empty text has 0 tokens and score 0; a text without spaces is one word, whatever its length;
repeated rows are counted each; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import map_arrow, small_batches
from marlspark.llm.vocab import MARK, Vocabulary, vocabulary

UNKNOWN_PENALTY = 10.0
#: Words whose result is kept by a worker at a time, and their length.
KEPT, KEPT_LENGTH = 200_000, 64


class Counted:
    """pieces: (piece, score) of the vocabulary; fallback: whether unknown characters become bytes."""

    def __init__(self, pieces: list[tuple[str, float]], fallback: bool = True):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for piece, score in pieces:
            self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.fallback = fallback
        self.known: dict[str, tuple[int, float]] = {}

    def best(self, s: str) -> tuple[int, float]:
        """(pieces, score) of the best path through s."""
        n = len(s)
        score, count = [None] * (n + 1), [0] * (n + 1)
        score[0] = 0.0
        at = 0
        for end, (size, own) in self.found.iter(s):
            while at < end:  # places where no piece ends
                at += 1
                self._unknown(s, at, score, count)
            start = end + 1 - size
            if score[start] is None:
                continue
            new, old = score[start] + own, score[end + 1]
            if old is None or new > old:
                score[end + 1], count[end + 1] = new, count[start] + 1
        while at < n:
            at += 1
            self._unknown(s, at, score, count)
        return count[n], score[n]

    def _unknown(self, s: str, at: int, score: list, count: list) -> None:
        """The single character before place at, if the vocabulary has no piece for it; it is looked at last."""
        c = s[at - 1]
        if c in self.single:
            return
        new = score[at - 1] + self.unknown
        if score[at] is None or new > score[at]:
            score[at], count[at] = new, count[at - 1] + (len(c.encode()) if self.fallback else 1)

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        words = text.replace(" ", MARK).split(MARK)
        if len(words) > 1 and not words[0]:
            words = words[1:]  # the text has a mark of its own in front
        tokens, total, known = 0, 0.0, self.known
        for w, n in Counter(words).items():
            hit = known.get(w)
            if hit is None:
                hit = self.best(MARK + w)
                if len(w) <= KEPT_LENGTH:
                    if len(known) >= KEPT:
                        known.clear()
                    known[w] = hit
            tokens += n * hit[0]
            total += n * hit[1]
        return tokens, total


def tokenizer(v: Vocabulary):
    """The tokenizer library's own tokenizer of the vocabulary, whose counts these are."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    own = Tokenizer(models.Unigram(list(zip(v.pieces, v.logp, strict=True)), unk_id=v.unknown, byte_fallback=bool(v.bytes_)))
    own.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="always", split=True)
    return own


@lru_cache(maxsize=2)
def counter(path: str) -> Counted:
    """One for each worker process and vocabulary."""
    v = vocabulary(path)
    return Counted(list(zip(v.pieces, v.logp, strict=True)), bool(v.bytes_))


def count_tokens(docs: DataFrame, *, vocab_path: str, text: str = "text", keep: list[str]) -> DataFrame:
    """The columns of keep, n_tokens and token_score of each text; one Arrow pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = counter(vocab_path)
        for batch in small_batches(batches, "_text"):
            found = [counted.text(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            made = [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], "n_tokens", "token_score"])

    frame = docs.select(*keep, F.col(text).alias("_text"))
    return map_arrow(frame, run, ", ".join([f"`{n}` {t}" for n, t in frame.dtypes if n != "_text"] + ["n_tokens bigint", "token_score double"]))
