"""Quality scores by Bradley-Terry pairwise ranking.

Every pair of a good and a bad labelled document says that the good one is preferred. The score of a document is linear
in features of its text; the weights minimise the logistic loss on the difference of the features of the two documents
of a pair, plus a small ridge. A document counts as good from a quantile of the scores of the labelled documents on:
the one that tells good from bad most often (of several, that in the widest gap), and the scale is moved so that it
stands at ``cut``.

All labelled documents and all their pairs are learned from. The pairs are never listed: the loss of a pair depends on
two numbers, the scores of its documents, and is smooth in both. So each document is spread over the Chebyshev nodes
of its stretch of scores, the sums over the documents are made where they lie, and the sum over all pairs of documents
is one over pairs of nodes, equal but for rounding (about 1e-12). A step of Newton's method is two passes over a table of
the labelled documents' features; a sum for each node and feature reaches the driver. The threshold is found in ranges
of sorted scores. Texts are read once and not shuffled; their features (some 200 bytes a document) are.

Defined results: a null or empty text has the features of no words and is scored with them; a null label or doc_id is
not learned from; of several labels of one document the least counts; with labels of one kind only, or none, every
score is the share of good labels (or cut); other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import forget, fresh, map_arrow, small_batches, written
from marlspark.llm.host_rules import repeat_words
from marlspark.llm.words import IS_SPACE, split_words, text_bytes

#: Bytes counted by kind. Beyond ASCII only letters occur often, so bytes above 127 count with them.
_KINDS = {
    "upper": bytes(range(65, 91)),
    "digit": b"0123456789",
    "stop": b".!?",
    "bang": b"!",
    "comma": b",;:",
    "bar": b"|",
    "symbol": b"#*$%&<>@_^~=+\\/",
    "bracket": b"()[]{}\"'",
    "line": b"\n",
}


def window_variety(h: np.ndarray, window: int = 50) -> tuple[float, float]:
    """Mean and least share of distinct words over all windows of so many words of one text, or the text if shorter."""
    size = min(window, len(h))
    order = np.argsort(h, kind="stable")
    before = np.full(len(h), -1)
    same = h[order[1:]] == h[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    # the j-th word is the first of its kind in the windows that start after its last occurrence
    at = np.arange(len(h))
    first = np.maximum(before + 1, at - size + 1)
    steps = np.bincount(np.maximum(first, 0), minlength=len(h) + 1) - np.bincount(at + 1, minlength=len(h) + 1)
    distinct = np.cumsum(steps)[: len(h) - size + 1] / size
    return float(distinct.mean()), float(distinct.min())


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text."""
    w = split_words(data, offsets)
    size, n = np.maximum(np.diff(offsets), 1), np.maximum(w.count, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    cols = [np.log1p(w.count)]
    for own in _KINDS.values():
        flag = np.zeros(256, bool)
        flag[list(own)] = True
        found = per_text(flag[data])
        cols += [found / n, np.minimum(found / size, 1), found > 0]
    letters = per_text(~IS_SPACE[data] & ((data & 0xC0) != 0x80))
    cols += [letters / n, np.log1p(letters / n), per_text(data > 127) / size]
    length = w.end - w.start
    for low, high in ((1, 3), (4, 6), (7, 10), (11, 1 << 30)):
        cols.append(np.bincount(w.doc, (length >= low) & (length <= high), len(n)) / n)
    unique, again, short, least, top = (np.zeros(len(n)) for _ in range(5))
    for i, (a, c) in enumerate(zip(w.first.tolist(), w.count.tolist(), strict=True)):
        if c:
            _, k = np.unique(w.hash[a : a + c], return_counts=True)
            unique[i], top[i] = len(k) / c, k.max() / c
            short[i], least[i] = window_variety(w.hash[a : a + c])
            again[i] = repeat_words(w.hash[a : a + c]) / c
    cols += [unique, short, least, top, again, again > 0.1, unique * np.log1p(w.count), w.count < 20]
    return np.nan_to_num(np.column_stack(cols).astype(np.float64))


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = told(scaled(x, self.mean, self.scale), self.weight) - self.threshold
        return 1 / (1 + np.exp(-np.clip(z + np.log(self.cut / (1 - self.cut)), -40, 40)))


def scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.clip((x - mean) / scale, -6, 6))


def told(z: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores on the scale of the loss; equal rows have equal ones, wherever they stand."""
    return (z * weight).sum(1)


#: Sums by (good, stretch of scores), and what gives the total of them over all labelled rows for a function of some rows.
Sums = dict[tuple[bool, int], np.ndarray]
Total = Callable[[Callable[[np.ndarray, np.ndarray], Sums]], Sums]

#: A stretch of scores and its Chebyshev nodes; the logistic function is even at 1e-12 of its polynomials there.
_WIDTH, _NODES = 4.0, 24
_ANGLE = (2 * np.arange(_NODES) + 1) * np.pi / (2 * _NODES)
_AT = (1 + np.cos(_ANGLE)) * _WIDTH / 2
_TO_NODES = np.cos(np.outer(np.arange(_NODES), _ANGLE)) * np.where(np.arange(_NODES) == 0, 1, 2)[:, None] / _NODES


def spread(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretch of each score and its share in each node: a smooth function of it is the sum of the shares' values."""
    stretch = np.floor(score / _WIDTH)
    place = np.clip((score - stretch * _WIDTH) * 2 / _WIDTH - 1, -1, 1)
    return stretch.astype(int), np.polynomial.chebyshev.chebvander(place, _NODES - 1) @ _TO_NODES


def by_stretch(stretch: np.ndarray, good: np.ndarray) -> Iterator[tuple[tuple[bool, int], np.ndarray]]:
    """The rows of each label and stretch that has any."""
    for kind in (False, True):
        for b in np.unique(stretch[good == kind]).tolist():
            yield (kind, b), np.flatnonzero((good == kind) & (stretch == b))


class PairLoss:
    """The mean loss over all pairs of a good and a bad row, and its derivatives, at some weights."""

    def __init__(self, total: Total, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray):
        self.total, self.mean, self.scale, self.weight = total, mean, scale, weight
        k = len(weight)

        def moments(x: np.ndarray, good: np.ndarray) -> Sums:
            z = scaled(x, mean, scale)
            stretch, share = spread(told(z, weight))
            return {key: share[r].T @ np.column_stack([np.ones(len(r)), z[r]]) for key, r in by_stretch(stretch, good)}

        found = {key: m.reshape(_NODES, k + 1) for key, m in total(moments).items()}
        bad = sorted(key for key in found if not key[0])
        at = np.concatenate([b * _WIDTH + _AT for _, b in bad])
        below = np.concatenate([found[key] for key in bad])
        self.pairs = sum(m[:, 0].sum() for key, m in found.items() if key[0]) * below[:, 0].sum()
        self.loss, self.gradient, self.cross, self.curve = 0.0, np.zeros(k), np.zeros((k, k)), {}
        pull, bend = np.zeros(len(at)), np.zeros(len(at))
        for key in sorted(key for key in found if key[0]):
            above = found[key]
            u = at - (key[1] * _WIDTH + _AT)[:, None]
            p = 1 / (1 + np.exp(-np.clip(u, -700, 700)))
            w = p * (1 - p)
            self.loss += above[:, 0] @ np.logaddexp(0, u) @ below[:, 0]
            self.gradient -= above[:, 1:].T @ (p @ below[:, 0])
            self.cross += above[:, 1:].T @ w @ below[:, 1:]
            self.curve[key] = w @ below[:, 0]
            pull += above[:, 0] @ p
            bend += above[:, 0] @ w
        self.gradient += below[:, 1:].T @ pull
        self.curve |= dict(zip(bad, bend.reshape(len(bad), _NODES), strict=True))

    def hessian(self) -> np.ndarray:
        # what is captured goes to the executors
        mean, scale, weight, curve = self.mean, self.scale, self.weight, self.curve

        def squares(x: np.ndarray, good: np.ndarray) -> Sums:
            z = scaled(x, mean, scale)
            stretch, share = spread(told(z, weight))
            own = np.zeros(len(z))
            for key, r in by_stretch(stretch, good):
                own[r] = share[r] @ curve[key]
            return {(False, 0): (z * own[:, None]).T @ z}

        return self.total(squares)[False, 0].reshape(self.cross.shape) - self.cross - self.cross.T


class ListedPairs:
    """As PairLoss, for few rows: every pair by itself."""

    def __init__(self, z: np.ndarray, good: np.ndarray, weight: np.ndarray):
        self.diff = (z[good][:, None] - z[~good][None]).reshape(-1, z.shape[1])
        u = -told(self.diff, weight)
        self.p = 1 / (1 + np.exp(-np.clip(u, -700, 700)))
        self.pairs, self.loss, self.gradient = len(u), np.logaddexp(0, u).sum(), -(self.diff.T @ self.p)

    def hessian(self) -> np.ndarray:
        return (self.diff * (self.p * (1 - self.p))[:, None]).T @ self.diff


def minimise(loss: Callable[[np.ndarray], PairLoss | ListedPairs], k: int, ridge: float, steps: int) -> np.ndarray:
    """Newton's method; a step that makes the loss larger is halved."""
    weight = np.zeros(k)
    here = loss(weight)
    for _ in range(steps):
        step = np.linalg.solve(here.hessian() / here.pairs + (ridge + 1e-9) * np.eye(k), here.gradient / here.pairs + ridge * weight)
        if np.abs(step).max() < 1e-6:
            return weight - step
        least = here.loss / here.pairs + ridge / 2 * weight @ weight
        while True:
            there = loss(weight - step)
            if there.loss / there.pairs + ridge / 2 * (weight - step) @ (weight - step) <= least + 1e-10 or np.abs(step).max() < 1e-6:
                break
            step = step / 2
        weight, here = weight - step, there
    return weight


def gaps(score: np.ndarray, net: np.ndarray) -> tuple[float, ...]:
    """Of ascending scores with the bad less the good rows of each: first, last, sum; the largest sum up to a gap, its ends."""
    sums = np.cumsum(net).astype(float)
    if len(score) == 1:
        return (float(score[0]), float(score[0]), float(sums[-1]), -np.inf, 0.0, 0.0)
    best = np.flatnonzero(sums[:-1] == sums[:-1].max())
    at = best[np.argmax(score[best + 1] - score[best])]
    return tuple(float(v) for v in (score[0], score[-1], sums[-1], sums[at], score[at], score[at + 1]))


def best_cut(ranges: list[tuple[float, ...]]) -> float:
    """Where a cut tells good from bad most often, from the gaps of ranges of scores in order; the widest gap of several."""
    below, last, found = 0.0, None, []
    for first, end, net, inner, low, high in ranges:
        found.append((below, 0.0, first - 2e-6, first) if last is None else (below, first - last, last, first))
        found.append((below + inner, high - low, low, high))
        below, last = below + net, end
    found.append((below, 0.0, last, last + 2e-6))
    _, _, low, high = max(found, key=lambda c: c[:2])
    middle = (low + high) / 2
    return middle if middle > low else high


def standard(total: Total) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Good and bad rows, mean and deviation of the features."""
    sums = total(lambda x, good: {(kind, 0): np.concatenate([[(good == kind).sum()], x[good == kind].sum(0)]) for kind in (False, True)})
    if not sums:
        return 0, 0, np.zeros(1), np.ones(1)
    n = sums[True, 0][0] + sums[False, 0][0]
    mean = (sums[True, 0][1:] + sums[False, 0][1:]) / n
    square = total(lambda x, good: {(False, 0): ((x - mean) ** 2).sum(0)})[False, 0]
    return int(sums[True, 0][0]), int(sums[False, 0][0]), mean, np.maximum(np.sqrt(square / n), 1e-9)


def one_kind(good: int, bad: int, mean: np.ndarray, scale: np.ndarray, cut: float) -> Ranker:
    share = min(max(good / (good + bad) if good + bad else cut, 1e-3), 1 - 1e-3)
    return Ranker(mean, scale, np.zeros(len(mean)), float(np.log(cut / (1 - cut)) - np.log(share / (1 - share))), cut)


def fit(x: np.ndarray, good: np.ndarray, *, cut: float, pairs: int = 60_000, ridge: float = 1e-3, steps: int = 30) -> Ranker:
    """The ranker of rows in memory, by all pairs of a good and a bad one; up to so many are listed, for more nodes are used."""
    total: Total = lambda make: make(x, good) if len(x) else {}
    n_good, n_bad, mean, scale = standard(total)
    if not n_good or not n_bad:
        return one_kind(n_good, n_bad, mean, scale, cut)
    z = scaled(x, mean, scale)
    weight = minimise(lambda w: ListedPairs(z, good, w) if n_good * n_bad <= pairs else PairLoss(total, mean, scale, w), len(mean), ridge, steps)
    score, at = np.unique(told(z, weight), return_inverse=True)
    return Ranker(mean, scale, weight, best_cut([gaps(score, np.bincount(at, np.where(good, -1, 1)))]), cut)


def described(docs: DataFrame, *, text: str = "text", to: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of keep and, as column to, the features of each row's text."""
    name = fresh([*keep, to], "_text")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, name):
            x = features(*text_bytes(batch.column(batch.num_columns - 1))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r.tobytes() for r in x], pa.binary())], names=[*batch.schema.names[:-1], to])

    frame = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).alias(name))
    return map_arrow(frame, run, ", ".join([f"`{n}` {t}" for n, t in frame.dtypes[:-1]] + [f"`{to}` binary"]))


def read_features(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1).astype(np.float64)


def table_total(table: DataFrame) -> Total:
    """Sums over a table of _part, _good and _x. Each part is summed in its own order and the parts in theirs, so that
    which task reads what changes nothing."""

    def total(make: Callable[[np.ndarray, np.ndarray], Sums]) -> Sums:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def told_of(part: int, sums: Sums) -> pa.RecordBatch:
                rows = [(part, kind, b, m.astype(np.float64).tobytes()) for (kind, b), m in sums.items()]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.int32(), pa.binary()), strict=True)], names=["part", "good", "stretch", "sums"])

            now, sums = -1, {}
            for batch in batches:
                part = batch.column(0).to_numpy()
                for at in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
                    if not len(at):
                        continue
                    if part[at[0]] != now and sums:
                        yield told_of(now, sums)
                        sums = {}
                    now = int(part[at[0]])
                    own = batch.slice(int(at[0]), len(at))
                    for key, m in make(read_features(own.column(2)), own.column(1).to_numpy(zero_copy_only=False)).items():
                        sums[key] = sums[key] + m if key in sums else m
            if sums:
                yield told_of(now, sums)

        out: Sums = {}
        # for each part a row for each stretch of scores
        for _, kind, b, m in sorted((r["part"], r["good"], r["stretch"], bytes(r["sums"])) for r in map_arrow(table, run, "part int, good boolean, stretch int, sums binary").collect()):
            own = np.frombuffer(m)
            out[kind, b] = out[kind, b] + own if (kind, b) in out else own
        return out

    return total


def table_cut(table: DataFrame, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray) -> float:
    """best_cut over all rows of the table; equal scores are one row before they are sorted."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                net = np.where(batch.column(1).to_numpy(zero_copy_only=False), -1, 1)
                yield pa.RecordBatch.from_arrays([pa.array(told(scaled(read_features(batch.column(2)), mean, scale), weight)), pa.array(net, pa.int64())], names=["score", "net"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if own:
            score, net = (np.concatenate([b.column(i).to_numpy() for b in own]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in gaps(score, net)], names=list("abcdef"))

    each = map_arrow(table, scores, "score double, net long").groupBy("score").agg(F.sum("net").alias("net"))
    ordered = each.repartitionByRange("score").sortWithinPartitions("score")
    # a row for each range of scores
    return best_cut(sorted(tuple(r) for r in map_arrow(ordered, run, ", ".join(f"{c} double" for c in "abcdef")).collect()))


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", described_as: str | None = None, label: str = "quality", of: Column | None = None, cut: float = 0.3, ridge: float = 1e-3, steps: int = 30) -> Ranker:
    """A ranker from all labels for which the condition ``of`` on labels holds and all their pairs.

    described_as: the column of features where docs has them (by described()); else they are made of the text.
    """
    use = labels if of is None else labels.where(of)
    marked = use.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IS NOT NULL")
    marked = marked.groupBy("_id").agg((F.min("_label") == 1).alias("_good"))
    if described_as is None:
        known = described(docs.where(F.col(doc_id).isNotNull()), text=text, to="_x", keep={"_id": F.col(doc_id)})
    else:
        known = docs.select(F.col(doc_id).alias("_id"), F.col(described_as).alias("_x"))
    parts = max(16, -(-marked.count() // 100_000))
    placed = known.join(marked, "_id").repartition(parts, "_id").sortWithinPartitions("_id", "_x")
    table = written(placed.select(F.spark_partition_id().alias("_part"), "_good", "_x"), "quality-labelled")
    total = table_total(table)
    n_good, n_bad, mean, scale = standard(total)
    if not n_good or not n_bad:
        ranker = one_kind(n_good, n_bad, mean, scale, cut)
    else:
        weight = minimise(lambda w: PairLoss(total, mean, scale, w), len(mean), ridge, steps)
        ranker = Ranker(mean, scale, weight, table_cut(table, mean, scale, weight), cut)
    forget(table)
    return ranker


def score_quality(docs: DataFrame, ranker: Ranker, *, text: str = "text", described_as: str | None = None, keep: dict[str, Column]) -> DataFrame:
    """The columns of keep, score (0 to 1) and predicted (1 from the cut on) of each row; described_as as in learn."""
    name = fresh([*keep, "score", "predicted"], "_x")[0]
    frame = described(docs, text=text, to=name, keep=keep) if described_as is None else docs.select(*[c.alias(n) for n, c in keep.items()], F.col(described_as).alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = read_features(batch.column(batch.num_columns - 1))
                score = ranker.score(x) if len(ranker.weight) == x.shape[1] else np.full(len(x), ranker.cut)
                made = [pa.array(score), pa.array((score >= ranker.cut).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], "score", "predicted"])

    return map_arrow(frame, run, ", ".join([f"`{n}` {t}" for n, t in frame.dtypes[:-1]] + ["score double", "predicted int"]))
