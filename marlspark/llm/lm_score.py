"""Marginal log-probability of whole texts over the subword lattice of an existing unigram vocabulary.

The pieces of the vocabulary have its own scores as log-probabilities (see vocab). A text is a sequence of words and
one end; every word begins with the word mark, and as no piece crosses a mark, the sum over all segmentations of a text
is the product of those of its words. The sum of a word is taken by the forward recursion in log space, once for each
distinct word. Pieces with and without a mark together have the share 1, so the lattice is a distribution over words.

What the training texts add are words: with c occurrences of a word in n tokens of v types, P(word) is (c - D) / n plus
D v / n times its lattice probability, so the lattice spreads what the discount D leaves over all words, seen or not.
Texts come from one of a few classes (languages), each with counts of its own that back off to those of all classes by a
fifth; the class of a text is summed over too, and never read from the text's row. With learned=False the score is the
lattice's alone. Tables of words grow with the corpus and are joined; what is broadcast is the piece scores (as large
as the vocabulary) and the words that make up at least 1 / head of all tokens, at most ``head`` of them.

Rows are told apart by 128 bits of their text and the columns that are kept, not by their place, so a task that runs
again gives the same; rows that are equal in all of these are scored once and given as often as they came.

Defined results: a null or empty text is the end alone; a null class counts as a class; with more than max_classes
classes the smaller ones are taken together; with no training text at all every score is the lattice's; rows that are
repeated are scored alike; a text without spaces is one word, whatever its length; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspark.llm.frames import map_arrow, row_key, small_batches, written
from marlspark.llm.vocab import MARK, vocabulary

DISCOUNT, GLOBAL_SHARE = 0.7, 0.2
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Stands for the end of a text among words, which cannot hold a space.
END = b" "
FLUSH = 150_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_LOWER).split() if text else []


@lru_cache(maxsize=2)
def lattice_pieces(vocab_path: str) -> tuple[list[bytes], np.ndarray, float]:
    """Pieces as bytes with a space for the word mark, their log-probabilities, and that of the end of a text.

    Pieces that no word can hold (runs of marks, controls) are left out and the rest sums to 1. Every single byte is a
    piece, and the mark, so each word has a segmentation.
    """
    v = vocabulary(vocab_path)
    share: dict[bytes, float] = {}
    for i in v.normal:
        piece = v.pieces[i].replace(MARK, " ").encode()
        if piece.count(b" ") == (piece[:1] == b" "):
            share[piece] = math.exp(v.logp[i])
    least = min(share.values(), default=1.0)
    for piece in [b" ", *(bytes([x]) for x in range(256) if x != 32)]:
        share.setdefault(piece, least)
    pieces = sorted(share)
    value = np.array([share[p] for p in pieces])
    whole = value.sum()
    # an end comes as often as the mark alone: it is a piece without a word
    return pieces, np.log(value / whole), math.log(share[b" "] / whole)


class Lattice:
    """log P(word) as the sum over all of its segmentations into pieces, the word mark in front."""

    #: Words of more bytes are run one at a time, by the pieces that Aho-Corasick finds in them.
    LONG = 200

    def __init__(self, pieces: list[bytes], scores: np.ndarray):
        self.index = {p: i for i, p in enumerate(pieces)}
        self.scores, self.longest = np.asarray(scores, np.float64), max(map(len, pieces))
        self.found = None

    def _same_length(self, words: list[bytes]) -> np.ndarray:
        """The log-space recursion over places, for all words of one length at once; sums holds the last places only."""
        n, size, get = len(words), len(words[0]), self.index.get
        sums = {0: np.zeros(n)}
        for a in range(size):
            here = sums.pop(a)
            for b in range(a + 1, min(size, a + self.longest) + 1):
                there = sums.get(b)
                if there is None:
                    there = sums[b] = np.full(n, -np.inf)
                piece = np.fromiter((get(w[a:b], -1) for w in words), np.int64, n)
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    there[hit] = np.logaddexp(there[hit], here[hit] + self.scores[piece[hit]])
        return sums[size]

    def _long(self, word: bytes) -> float:
        """The same recursion for one word, in time in proportion to the pieces that occur in it."""
        if self.found is None:
            import ahocorasick

            self.found = ahocorasick.Automaton()
            for p, i in self.index.items():
                self.found.add_word(p.decode("latin-1"), (len(p), float(self.scores[i])))
            self.found.make_automaton()
        ring = self.longest + 1
        sums = [-math.inf] * ring
        sums[0], at = 0.0, 0
        for end, (size, own) in self.found.iter(word.decode("latin-1")):
            while at <= end:  # every byte is a piece, so every place is reached
                at += 1
                sums[at % ring] = -math.inf
            new, old = sums[(end + 1 - size) % ring] + own, sums[at % ring]
            sums[at % ring] = new if old == -math.inf else max(new, old) + math.log1p(math.exp(-abs(new - old)))
        return sums[at % ring]

    def forward_all(self, words: list[bytes], block: int = 4096) -> np.ndarray:
        """For each word, given without its mark, the log of its marginal probability."""
        marked = [b" " + w for w in words]
        out = np.zeros(len(words))
        size = np.array([len(w) for w in marked])
        order = np.argsort(size, kind="stable")
        a = 0
        while a < len(order):
            if size[order[a]] > self.LONG:
                out[order[a]] = self._long(marked[order[a]])
                a += 1
                continue
            b = min(int(np.searchsorted(size[order], size[order[a]], side="right")), a + block)
            rows = order[a:b]
            out[rows] = self._same_length([marked[i] for i in rows])
            a = b
        return out


def _count(classes: dict[str, int], rest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], int] = {}

        def flush() -> pa.RecordBatch:
            cls, words = zip(*held, strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(cls, pa.int32()), pa.array(list(held.values()), pa.int64())], names=["word", "cls", "n"])
            held.clear()
            return out

        for batch in small_batches(batches, "_text"):
            for text, cls, learn in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                # class -1: a word of a text that is not learned from, to be scored only
                c = classes.get(cls, rest) if learn else -1
                for w, n in Counter(words_of(text)).items():
                    held[c, w] = held.get((c, w), 0) + n
                if learn:
                    held[c, END] = held.get((c, END), 0) + 1
                if len(held) > FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


class Model:
    """Sizes of the training text, by class; small, whatever the corpus."""

    def __init__(self, n: list[int], v: list[int], types: int, learned: bool = True):
        self.n, self.v, self.total, self.types, self.learned = n, v, sum(n), types, learned

    def words(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Natural log of P(word) in each class (columns), from its counts and its log-probability in the lattice."""
        if not self.learned or not self.total:
            return np.repeat(spelled[:, None], counts.shape[1], axis=1)
        n, v = np.array(self.n, np.float64), np.array(self.v, np.float64)
        with np.errstate(divide="ignore"):
            seen = np.log(np.maximum(counts - DISCOUNT, 0) / np.maximum(n, 1))
            left = np.log(np.where(n > 0, DISCOUNT * v / np.maximum(n, 1), 1.0))
            whole = np.log(np.maximum(counts.sum(1) - DISCOUNT, 0) / self.total)
            rest = math.log(DISCOUNT * self.types / self.total)
        everywhere = np.logaddexp(whole, rest + spelled)
        unseen = left + np.logaddexp(math.log(GLOBAL_SHARE) + everywhere, math.log(1 - GLOBAL_SHARE) + spelled)[:, None]
        return np.logaddexp(seen, unseen)


def _score_words(model: Model, vocab_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, scores, stop = lattice_pieces(vocab_path)
        lattice = Lattice(pieces, scores)
        for batch in batches:
            words = batch.column(0).to_pylist()
            counts = np.array(batch.column(1).to_pylist(), np.float64).reshape(len(words), -1)
            spelled = lattice.forward_all([b"" if w == END else w for w in words])
            spelled[[w == END for w in words]] = stop
            out = model.words(counts, spelled)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.sum(1).astype(np.int64)), lists], names=["word", "c", "lp"])

    return run


def _score_texts(head: dict[bytes, int], table: np.ndarray):
    """Of rows (k0, k1, _text, _kept): a row with the sums over frequent words for each text, and one for each other word.

    The word of the first is a space and the key, which no other word is. table: for each frequent word its scores by
    class, its term of the base score and whether it was seen.
    """
    names = ["k0", "k1", "word", "times", "n_tokens", "n_known", "sums", "_kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = head.get
        for batch in small_batches(batches, "_text"):
            k0, k1, kept = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            sizes, sums = np.zeros(len(k0), np.int64), np.zeros((len(k0), table.shape[1]))
            row_of, word_of, times_of = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                words = words_of(text)
                words.append(END)
                counted = Counter(words)
                sizes[i] = len(words)
                at = np.fromiter((get(w, -1) for w in counted), np.int64, len(counted))
                n = np.fromiter(counted.values(), np.int64, len(counted))
                hit = at >= 0
                sums[i] = n[hit] @ table[at[hit]]
                other = np.flatnonzero(~hit)
                if len(other):
                    keys = list(counted)
                    row_of.append(np.full(len(other), i))
                    word_of += [keys[j] for j in other.tolist()]
                    times_of.append(n[other])
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(k0) + 1, dtype=np.int32) * (table.shape[1] - 1)), pa.array(sums[:, :-1].reshape(-1)))
            own = pa.array([b" %d %d" % x for x in zip(k0.tolist(), k1.tolist(), strict=True)], pa.binary())
            known = pa.array(np.rint(sums[:, -1]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own, pa.array(np.ones(len(k0), np.int64)), pa.array(sizes), known, flat, kept], names=names)
            if word_of:
                m, at = len(word_of), np.concatenate(row_of)
                none = pa.array(np.zeros(m, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(k0[at]), pa.array(k1[at]), pa.array(word_of, pa.binary()), pa.array(np.concatenate(times_of)), none, none, pa.nulls(m, pa.list_(pa.float64())), pa.nulls(m, kept.type)], names=names)

    return run


def score_texts(docs: DataFrame, *, learn: Column, vocab_path: str, text: str = "text", classes: str | None = None, keep: dict[str, Column], head: int = 300_000, max_classes: int = 8, learned: bool = True) -> DataFrame:
    """The columns of keep with n_tokens, n_known, train_tokens, base_score and score (both log10) for each row.

    learn: which rows the model learns from. classes: the column with the class of a training text, or None for one
    class. learned: whether seen words have a share of their own, or the vocabulary's lattice alone gives the score.
    base_score is the add-one unigram score of the same tokens.
    """
    cls = F.col(classes).cast("string") if classes else F.lit("")
    frame = docs.select(F.col(text).alias("_text"), cls.alias("_cls"), F.coalesce(learn, F.lit(False)).alias("_learn"))
    named = [r["_cls"] for r in frame.where("_learn").groupBy("_cls").count().orderBy(F.desc("count"), "_cls").limit(max_classes).collect()]
    index, k = {c: i for i, c in enumerate(named)}, max(len(named), 1)  # any further class is taken together with the last of these
    counted = map_arrow(frame, _count(index, k - 1), "word binary, cls int, n bigint")
    per = [F.coalesce(F.sum(F.when(F.col("cls") == j, F.col("n"))), F.lit(0)) for j in range(k)]
    table = written(counted.groupBy("word").agg(F.array(*per).alias("counts")), "lm-words")
    all_ = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sizes = table.agg(*[F.sum(F.col("counts")[j]).alias(f"n{j}") for j in range(k)], *[F.count_if(F.col("counts")[j] > 0).alias(f"v{j}") for j in range(k)], F.count_if(all_ > 0).alias("types")).first()
    n, v, types = [sizes[f"n{j}"] or 0 for j in range(k)], [sizes[f"v{j}"] or 0 for j in range(k)], sizes["types"] or 0
    total = sum(n)
    model = Model(n, v, types, learned)
    scored = written(map_arrow(table, _score_words(model, vocab_path), "word binary, c bigint, lp array<double>"), "lm-scores", drop=(table,))
    least = max(total / head, 1)
    frequent = scored.where(F.col("c") >= least).select("word", F.concat("lp", F.array(F.log10(F.col("c") + 1) - math.log10(total + types + 1), F.lit(1.0))).alias("s")).collect()
    index_of, scores = {bytes(r["word"]): i for i, r in enumerate(frequent)}, np.array([r["s"] for r in frequent], np.float64).reshape(len(frequent), k + 2)
    kept = F.struct(*[c.alias(a) for a, c in keep.items()])
    keyed = docs.select(F.col(text).alias("_text"), kept.alias("_kept"))
    keyed = keyed.select(*[c.alias(a) for a, c in zip(("k0", "k1"), row_key("_text", "_kept"), strict=True)], "_text", "_kept")
    schema = T.StructType.fromDDL("k0 bigint, k1 bigint, word binary, times bigint, n_tokens bigint, n_known bigint, sums array<double>").add("_kept", T.StructType([T.StructField(f.name, f.dataType) for f in keyed.schema["_kept"].dataType]))
    parts = keyed.mapInArrow(_score_texts(index_of, scores), schema)
    rare = scored.where(F.col("c") < least)
    joined = parts.join(rare, "word", "left")
    low = F.lit(-math.log10(total + types + 1))
    base = F.when(F.col("sums").isNotNull(), F.col("sums")[k]).otherwise(F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 1) + low))
    summed = joined.groupBy("k0", "k1").agg(
        F.count("sums").alias("_copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(base).alias("base_score"),
        F.first("_kept", ignorenulls=True).alias("_kept"),
        *[F.sum(F.coalesce(F.col("sums")[j], F.col("times") * F.col("lp")[j])).alias(f"s{j}") for j in range(k)],
    )
    prior = [math.log((x + 1) / (total + k)) for x in n]
    each = F.array(*[F.col(f"s{j}") / F.col("_copies") + F.lit(p) for j, p in enumerate(prior)])
    top = F.array_max(each)
    score = (top + F.log(F.aggregate(each, F.lit(0.0), lambda a, x: a + F.exp(x - top)))) / F.lit(math.log(10))
    whole = [F.expr(f"{c} DIV _copies").alias(c) for c in ("n_tokens", "n_known")]
    once = summed.select("_copies", "_kept", *whole, (F.col("base_score") / F.col("_copies")).alias("base_score"), score.alias("score"))
    # rows that are equal throughout came as one; they go out in blocks, so that no array is long
    out = once.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(_copies - 1) DIV 4096"))))
    out = out.withColumn("_one", F.explode(F.expr("sequence(0, least(4096, _copies - 4096 * _block) - 1)")))
    return out.select(*[F.col("_kept").getField(c).alias(c) for c in keep], "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
