"""Document fingerprints by consistent weighted sampling (Ioffe's gamma-based samples).

The terms of a text are its lower-cased words, the weight of a term its count. For every term and each of 64 samples
r and c are Gamma(2, 1) and b is uniform, all drawn from the hash of the term, so every machine draws the same. With
t = floor(ln w / r + b) and ln y = r (t - b), the term with the least ln c - ln y - r is the sample, together with t.
Two texts have the same sample with the probability of their generalised Jaccard similarity, sum of min(w) over sum of
max(w). A fingerprint holds 16 bits of each sample as hex digits.

Neighbours by doc_id come from one shuffle: the ids are dealt into ranges by their quantiles, each range is sorted, and
the first row of a range is also sent to the range before it. Rows are then streamed in order.

Defined results: a null text is empty; texts without words have equal fingerprints; a null doc_id comes before all
others, and rows with the same doc_id follow each other by text; a single row is its own next; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import map_arrow, small_batches, written
from marlspark.llm.words import BASE, STEP, Words, mix, split_words, text_bytes

SAMPLES = 64
_SALT = mix(np.arange(3 * SAMPLES, dtype=np.uint64) * STEP + BASE).reshape(3, SAMPLES)
_LOWEST = -(1 << 63)


def _draws(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, ln c, b) of each term and sample."""
    shape = (len(terms), SAMPLES)
    out = tuple(np.empty(shape, np.float32) for _ in range(3))
    half = np.float32(2**-32)
    for a in range(0, len(terms), 4096):
        part = slice(a, a + 4096)
        for k in range(3):
            x = mix(terms[part, None] ^ _SALT[k])
            u = (x >> np.uint64(32)).astype(np.float32) * half
            if k == 2:
                out[2][part] = np.minimum(u, np.float32(1 - 2**-24))
                continue
            v = (x & np.uint64(0xFFFFFFFF)).astype(np.float32) * half
            g = -(np.log(u + half) + np.log(v + half))
            g = np.maximum(g, np.float32(1e-6))
            out[k][part] = g if k == 0 else np.log(g)
    return out


def _least(t: np.ndarray, n: np.ndarray, draws: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sample the least value of the terms t of weights n, the place of its term and its level."""
    r, lnc, b = draws
    value = lnc + r * b - r  # at weight 1, where the level is 0
    many = np.flatnonzero(n > 1)
    step = np.zeros((0, SAMPLES))
    if len(many):
        step = np.floor(np.log(n[many]).astype(np.float32)[:, None] / r[many] + b[many])
        value[many] = lnc[many] - r[many] * (step - b[many]) - r[many]
    best, every = value.argmin(0), np.arange(SAMPLES)
    level = np.zeros(SAMPLES, np.int64)
    if len(many):
        back = np.full(len(t), -1)
        back[many] = np.arange(len(many))
        hit = back[best]
        level[hit >= 0] = step[hit[hit >= 0], every[hit >= 0]].astype(np.int64)
    return value[best, every], best, level


def fingerprints(w: Words, block: int = 1 << 15) -> np.ndarray:
    """(texts, SAMPLES) of 16-bit samples. A text of more than block different terms is taken block by block, in bounded memory."""
    docs = len(w.count)
    out = np.zeros((docs, SAMPLES), np.uint16)
    rows = [np.unique(w.hash[a : a + c], return_counts=True) for a, c in zip(w.first.tolist(), w.count.tolist(), strict=True)]
    small = [t for t, _ in rows if 0 < len(t) <= block]
    drawn, at = None, 0
    if small:
        # words that texts of a batch share are drawn for once, unless they are too many
        terms, place = np.unique(np.concatenate(small), return_inverse=True)
        drawn = _draws(terms) if len(terms) <= 4 * block else None
    for i, (t, n) in enumerate(rows):
        if not len(t):
            continue
        best = None
        for a in range(0, len(t), block):
            part, weight = t[a : a + block], n[a : a + block]
            if drawn is not None and len(t) <= block:
                k = place[at : at + len(t)]
                at += len(t)
                draws = tuple(x[k] for x in drawn)
            else:
                draws = _draws(part)
            value, where, level = _least(part, weight, draws)
            code = mix(part[where] + level.astype(np.uint64) * STEP)
            if best is None:
                best, codes = value, code
            else:
                codes = np.where(value < best, code, codes)
                best = np.minimum(value, best)
        out[i] = (codes >> np.uint64(48)).astype(np.uint16)
    return out


def likeness(x: str, y: str) -> float:
    """Share of equal samples of two fingerprints."""
    return sum(x[i : i + 4] == y[i : i + 4] for i in range(0, len(x), 4)) / (len(x) // 4)


def fingerprint_texts(docs: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """The columns of keep and the fingerprint of each text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            found = fingerprints(split_words(*text_bytes(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([x.astype(">u2").tobytes().hex() for x in found])], names=[*batch.schema.names[:-1], "fingerprint"])

    frame = docs.select(*keep, F.col(text).alias("_text"))
    return map_arrow(frame, run, ", ".join([f"`{n}` {t}" for n, t in frame.dtypes if n != "_text"] + ["fingerprint string"]))


def edited(text: str, following: str) -> str:
    """text with its last quarter of code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for batch in small_batches(batches, "_text", 2 << 20):
        held += zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        # only the last range of the table can end in rows sent from another range: the first of them closes it
        rows = [x for x in held if not x[1]]
        closing = [x for x in held if x[1]]
        if closing:
            if rows:
                yield _told(rows, closing[0])
            held = closing[:1]
        elif len(rows) > 1:
            yield _told(rows[:-1], rows[-1])
            held = rows[-1:]


def _told(rows: list[tuple], following: tuple) -> pa.RecordBatch:
    texts = [x[2] or "" for x in [*rows, following]]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    found = fingerprints(split_words(*text_bytes(pa.array(texts + changed))))
    own, new, m = found[:-len(changed)], found[-len(changed) :], len(rows)
    cols = {
        "doc_id": pa.array([x[0] for x in rows], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:m]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        "fingerprint": pa.array([x.astype(">u2").tobytes().hex() for x in own[:m]]),
        "edited_fingerprint": pa.array([x.astype(">u2").tobytes().hex() for x in new]),
        "near_edited": pa.array((own[:m] == new).mean(1)),
        "near_next": pa.array((own[:m] == own[1:]).mean(1)),
    }
    return pa.RecordBatch.from_pydict(cols)


def range_of(k: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are less than k; found in two steps of about the root of their number."""
    wide = max(1, math.isqrt(len(bounds)))
    chunks = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    if not chunks:
        return F.lit(0)
    less = lambda a: F.size(F.filter(a, lambda x: x < k))
    long = lambda x: F.lit(x).cast("bigint")
    full = less(F.array(*[long(c[-1]) for c in chunks]))  # chunks that are less than k as a whole
    parts = F.array(*[F.array(*map(long, c)) for c in [*chunks, []]])
    return (full * wide + F.when(full < len(chunks), less(parts[full])).otherwise(len(bounds) - len(chunks) * wide)).cast("int")


def edit_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its fingerprint, that of its edited text (see edited), and its likeness to that and to the next row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_LOWEST)).alias("_k"), F.col(text).alias("_text"))
    share = [i / parts for i in range(1, parts)] or [0.5]
    cuts = frame.agg(F.percentile_approx("_k", F.array(*map(F.lit, share)), 100 * parts)).first()[0]
    bounds = sorted(set(cuts or []))
    ranged = frame.withColumn("_part", range_of(F.col("_k"), bounds))
    # one row for each range
    firsts = written(ranged.groupBy("_part").agg(F.min("_k").alias("_k")), "ranges")
    order = sorted((r["_part"], r["_k"]) for r in firsts.collect())
    before = {k: order[i - 1][0] for i, (_, k) in enumerate(order)}
    send = spark.createDataFrame([(k, p) for k, p in before.items()] or [(0, 0)], "_k long, _part int")
    heads = frame.join(F.broadcast(send), "_k").select("doc_id", "_k", "_text", "_part", F.lit(True).alias("_head"))
    rows = ranged.withColumn("_head", F.lit(False)).unionByName(heads)
    dealt = rows.repartitionById(len(bounds) + 1, F.col("_part")).sortWithinPartitions("_part", "_head", "_k", F.col("_text").asc_nulls_first())
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_arrow(dealt.select("doc_id", "_head", "_text"), _stream, schema)
