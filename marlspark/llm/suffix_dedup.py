"""Exact substring de-duplication: bytes covered by a string of 200 bytes that starts at least twice go.

The suffixes that matter are the windows of 200 bytes. They are dealt into suffix buckets, sorted a bucket at a time,
and the ties of buckets that are too large for one place are settled by ranks of a difference cover:

* Buckets. Of every window the 40 bytes whose hash is least are its anchor; its place depends on the bytes of the window
  alone, so equal windows have equal anchors. Anchors that occur once are dropped after one count of hashes; the
  others fall into buckets by hash. Windows in a row with one anchor stand together, as the context of that anchor;
  contexts that are equal as a whole are settled by their digest and stand in a bucket once.
* Sort. In a bucket the bytes from the anchor on are sorted and ranked, and so are the reversed bytes before it. A
  window that starts i bytes before its anchor is then the pair (rank of i bytes to the left, rank of 200 - i bytes to
  the right): windows tie if both ranks do.
* Long ties. A bucket of more than ``MOST`` contexts is a passage that very many texts share, each with its own
  surroundings. The places of its windows that are, modulo 73, in a difference cover (9 residues whose differences are
  all of 0 to 72) are its sample. For any two windows there is a shift below 73 at which both have a sample place, and
  the 128 bytes from there on lie in both. These 128 bytes are ranked once (by a hash: only equality counts); ranks that
  occur once drop out, samples that agree in all 200 bytes around are settled by a digest, and the others fall
  into buckets by rank, in which only the at most 72 bytes on either side are still to be sorted.
* A bucket of ranks that is still larger than ``MOST`` is not sorted in one place either: its windows are grouped by the
  hash of their bytes on both sides. So no bucket, whatever its size, has to fit into memory, and all are done in full.

Texts that are equal as a whole count once. Only texts of 200 bytes or more are joined, so null, empty and short texts,
however many, meet nowhere; equal long texts have one key, whose join Spark splits where it is skewed.

A difference cover for all windows was built and measured instead of the anchors: it has 9 samples in 73 places, of
which 5.2 million were candidates on 0.1 GB, where the anchors make 0.2 million different contexts (see README).

Defined results: a null or empty text has 0 bytes, nothing removed and the digest of no bytes; texts under 200 bytes
are left alone; a repeated row of 200 bytes or more is removed in every copy; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import map_arrow, small_batches, written
from marlspark.llm.words import BASE, STEP, mix, text_bytes

LENGTH, GRAM = 200, 40
SPAN = LENGTH - GRAM + 1
# A perfect difference set modulo 73.
MODULUS, COVER = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)
#: Bytes that are ranked at a sample place, and those of a window that can lie on either side of them.
RANKED, SIDE = LENGTH - MODULUS + 1, MODULUS - 1
#: Most members of a bucket that are sorted in one place; rows that are held for sorting at a time.
MOST, BLOCK = 512, 20_000
#: Windows of a run that are hashed at a time.
PART = 1 << 18
_TABLE = mix(np.arange(256, dtype=np.uint64) + BASE)


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the 40 bytes from each place on: 32 and 8 joined, both by doubling."""
    h, at = _TABLE[data], {1: None}
    size = 1
    while size < 32:
        h = h[:-size] * (BASE + np.uint64(2 * size)) + h[size:]
        size *= 2
        at[size] = h
    eight = at[8]
    return mix(at[32][: len(eight) - 32] * STEP + eight[32:])


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of every span values in a row."""
    size, low = 1, values
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(values) - span + 1], low[span - size :])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first, last) of the anchors of one text: first and last are the windows that have it."""
    if len(data) < LENGTH:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    h = _grams(data)
    bits = np.uint64(31)  # of the place; where the bits above tie, the leftmost is the least in every copy alike
    place = np.arange(len(h), dtype=np.uint64)
    at = (_least((h >> bits << bits) | place, SPAN) & np.uint64(0x7FFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    return at[new], h[at[new]], new, last


def parts(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first window, bytes) of the windows of a text, PART at a time, so that a long text takes no more memory than a short one."""
    for first in range(0, max(len(data) - LENGTH + 1, 0), PART):
        yield first, data[first : first + PART + LENGTH - 1]


def sample_places(first: int, last: int, size: int) -> np.ndarray:
    """Cover places of a text of size bytes that the windows from first to last can have within their first SIDE + 1 bytes."""
    start = first // MODULUS * MODULUS
    at = (np.arange(start, last + MODULUS + 1, MODULUS)[:, None] + np.array(COVER)).reshape(-1)
    return at[(at >= first) & (at <= last + SIDE) & (at <= size - RANKED)]


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse."""
    out = []
    for x in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))):
        power = np.full(n, x, np.uint64)
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


def _prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of byte * BASE ** place up to each place, and BASE ** -place: the hash of a substring is the difference of two sums times the latter."""
    power, back = _powers(PART + 1024)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])]), back


def _texts(batch: pa.RecordBatch, name: str = "_text") -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(batch.column(batch.schema.get_field_index(name)))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "_text"):
        data, offsets = _texts(batch)
        key = batch.column(0).to_numpy()
        found, keys, twice = [], [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if b - a < LENGTH:
                continue
            h, n = np.unique(np.concatenate([anchors(x)[1] for _, x in parts(data[a:b])]), return_counts=True)
            found.append(h)
            keys.append(np.full(len(h), key[i]))
            twice.append(n > 1)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ([f.view(np.int64) for f in found], keys, twice)], names=["hash", "t0", "twice"])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, t0, t1, spot, digest) of each anchor; spot holds its place and how far before it its windows start."""
    for batch in small_batches(batches, "_text"):
        data, offsets = _texts(batch)
        k0, k1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if b - a < LENGTH:
                continue
            for start, text in parts(data[a:b]):
                place, h, first, last = anchors(text)
                total, back = _prefix_hashes(text)
                digest = mix(mix((total[last + LENGTH] - total[first]) * back[first] + ((place - first) * 512 + last - first).astype(np.uint64) * STEP))
                packed = ((place + start) << 24) | ((place - first) << 12) | (place - last)
                for x, v in zip(out, (h.view(np.int64), np.full(len(h), k0[i]), np.full(len(h), k1[i]), packed, digest.view(np.int64)), strict=True):
                    x.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["hash", "t0", "t1", "spot", "digest"])


_CONTEXT = ["ranked", "key", "digest", "t0", "t1", "place", "most", "least", "left", "right"]
_CONTEXT_TYPES = [pa.bool_(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary(), pa.binary()]
_CONTEXT_SCHEMA = "ranked boolean, key bigint, digest bigint, t0 bigint, t1 bigint, place bigint, most int, least int, left binary, right binary"


def cover_samples(raw: bytes, runs: list[tuple[int, int]]) -> Iterator[tuple]:
    """(rank, digest, place, most, least, left, right) of the sample places of the windows in runs (first, last)."""
    whole: list[list[int]] = []
    for first, last in sorted(runs):
        if whole and first <= whole[-1][1] + 1:
            whole[-1][1] = max(whole[-1][1], last)
        else:
            whole.append([first, last])
    data = np.frombuffer(raw, np.uint8)
    for start, stop in whole:
        for first in range(start, stop + 1, PART):  # a part of a long run at a time
            last = min(stop, first + PART - 1)
            at = sample_places(first, last, len(raw))
            if not len(at):
                continue
            low = max(0, first - SIDE)
            total, back = _prefix_hashes(data[low : last + SIDE + LENGTH + 1])
            rank = mix((total[at - low + RANKED] - total[at - low]) * back[at - low])
            most, least = np.minimum(at - first, SIDE), np.maximum(at - last, 0)
            a, b = at - most - low, at - least + LENGTH - low
            seen = mix((total[b] - total[a]) * back[a] + (most * 128 + least).astype(np.uint64) * STEP)
            for p, k, d, m, n in zip(at.tolist(), rank.view(np.int64).tolist(), seen.view(np.int64).tolist(), most.tolist(), least.tolist(), strict=True):
                yield k, d, p, m, n, raw[p - m : p], raw[p + RANKED : p - n + LENGTH]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the wanted anchors of a text: the bytes on either side that their windows can have; of those of large buckets the cover samples."""
    for batch in small_batches(batches, "_text"):
        rows = []

        def flush(rows: list = rows) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _CONTEXT_TYPES, strict=True)], names=_CONTEXT)
            rows.clear()
            return out

        for text, t0, t1, wanted in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            raw, runs = text.encode(), []
            for w in wanted:
                place, most, least = w["spot"] >> 24, w["spot"] >> 12 & 4095, w["spot"] & 4095
                if w["large"]:
                    runs.append((place - most, place - least))
                else:
                    rows.append((False, w["hash"], w["digest"], t0, t1, place, most, least, raw[place - most : place], raw[place : place - least + LENGTH]))
            for k, d, p, m, n, left, right in cover_samples(raw, runs):
                rows.append((True, k, d, t0, t1, p, m, n, left, right))
                if len(rows) >= 50_000:
                    yield flush()
        if rows:
            yield flush()


def _window_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, k0, k1, t0, t1, first) for each window of samples of large buckets; k0 and k1 stand for its bytes on both sides."""
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            rows = []
            for rank, t0, t1, place, most, least, left, right in zip(*(c.to_pylist() for c in batch.slice(a, 1000).columns), strict=True):
                for i in range(least, most + 1):
                    told = hashlib.blake2b(left[len(left) - i :] + b"\xff" + right[: SIDE - i], digest_size=16).digest()
                    rows.append((rank, int.from_bytes(told[:8], "little", signed=True), int.from_bytes(told[8:], "little", signed=True), t0, t1, place - i))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["rank", "k0", "k1", "t0", "t1", "first"])


def _classes(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared) of the rows of bytes within their groups: shared[k] bytes are those that the k-th has in common with the one before, -1 for another group."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.lexsort([*words.T[::-1], group])
    diff = rows[order[1:]] != rows[order[:-1]]
    shared = np.where(diff.any(1), diff.argmax(1), rows.shape[1])
    shared[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate([[-1], shared])


def repeated(group: np.ndarray, most: np.ndarray, least: np.ndarray, lefts: list[bytes], rights: list[bytes], span: int) -> np.ndarray:
    """marks[r, i]: whether the window that starts i bytes before place r is found at another place of its group.

    Such a window has i bytes of the left and span - i of the right.
    """
    m = len(lefts)
    size = lambda x: -(-max(map(len, x), default=1) // 8) * 8 or 8
    right, left = np.zeros((m, size(rights)), np.uint8), np.zeros((m, size(lefts)), np.uint8)
    for r, (x, y) in enumerate(zip(lefts, rights, strict=True)):
        left[r, : len(x)] = np.frombuffer(x, np.uint8)[::-1] + np.uint8(1)  # 0 stands for no byte; UTF-8 has no byte 255
        right[r, : len(y)] = np.frombuffer(y, np.uint8) + np.uint8(1)
    order_r, shared_r = _classes(right, group)
    order_l, shared_l = _classes(left, group)
    marks = np.zeros((m, int(most.max()) + 1), bool)
    rank_r, rank_l = np.empty(m, np.int64), np.empty(m, np.int64)
    for i in range(int(least.min()), int(most.max()) + 1):
        active = np.flatnonzero((least <= i) & (i <= most))
        if len(active) < 2:
            continue
        rank_r[order_r] = np.cumsum(shared_r < span - i)
        rank_l[order_l] = np.cumsum(shared_l < i)
        both = rank_l[active] * (m + 1) + rank_r[active]
        _, inverse, count = np.unique(both, return_inverse=True, return_counts=True)
        marks[active, i] = count[inverse] > 1
    return marks


def _sorted_buckets(span: int):
    """Rows come sorted by key. Blocks of whole buckets are settled together."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key = table["key"].to_numpy()
        group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
        rows = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(rows):
            return
        table, group = table.take(pa.array(rows)), group[rows]
        most, least = table["most"].to_numpy().astype(np.int64), table["least"].to_numpy().astype(np.int64)
        r, i = np.nonzero(repeated(group, most, least, table["left"].to_pylist(), table["right"].to_pylist(), span))
        if not len(r):
            return
        run = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (i[1:] != i[:-1] + 1)]))
        end = np.concatenate([run[1:], [len(r)]]) - 1
        place, t0, t1 = (table[c].to_numpy() for c in ("place", "t0", "t1"))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t0[r[run]], t1[r[run]], place[r[run]] - i[end], place[r[run]] - i[run])], names=["t0", "t1", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1], side="left"))
            if cut:
                yield from settle(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from settle(pa.Table.from_batches(held).combine_chunks())

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "_text"):
        named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        rows, kept = [], []
        for text, copies, spans in zip(named["_text"].to_pylist(), named["_copies"].to_pylist(), named["_spans"].to_pylist(), strict=True):
            raw = (text or "").encode()
            if (copies or 1) > 1 and len(raw) >= LENGTH:
                spans = [{"first": 0, "last": len(raw) - LENGTH}]
            gone, runs, end, left = 0, 0, -1, []
            for s in sorted(spans or [], key=lambda s: s["first"]):
                a, b = s["first"], s["last"] + LENGTH
                if a > end or end < 0:
                    left.append(raw[max(end, 0) : a])
                    runs += 1
                    gone += b - a
                elif b > end:
                    gone += b - end
                end = max(end, b)
            left.append(raw[max(end, 0) :])
            rest = b"".join(left)
            rows.append((len(raw), gone, runs, hashlib.sha256(rest).hexdigest()))
            kept.append(rest.decode("utf-8", "ignore") if text is not None else None)
        out = [c for n, c in named.items() if n not in ("_text", "_copies", "_spans")]
        names = [n for n in named if n not in ("_text", "_copies", "_spans")]
        cols = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())]
        yield pa.RecordBatch.from_arrays([*out, *cols, pa.array(kept, pa.string())], names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def _found(rows: DataFrame, span: int) -> DataFrame:
    dealt = rows.select("key", "t0", "t1", "place", "most", "least", "left", "right").repartition("key").sortWithinPartitions("key")
    return map_arrow(dealt, _sorted_buckets(span), "t0 bigint, t1 bigint, first bigint, last bigint")


def _cover_windows(samples: DataFrame) -> list[DataFrame]:
    """Windows that repeat, from the cover samples (key: their rank) of large buckets."""
    spot = F.struct("t0", "t1", "place")
    seen = samples.groupBy("key", "digest").agg(F.min(spot).alias("_one"), F.max(spot).alias("_other"))
    seen = written(seen.select("key", "digest", "_one", (F.col("_one") != F.col("_other")).alias("equal")), "suffix-ranks")
    span = [(F.col("place") - F.col("most")).alias("first"), (F.col("place") - F.col("least")).alias("last")]
    sure = samples.drop("left", "right").join(seen.where("equal").select("key", "digest"), ["key", "digest"], "left_semi").select("t0", "t1", *span)
    open_ = seen.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.bool_or(~F.col("equal")).alias("_open")).where("_open AND _n > 1").select("key", "_n")
    ones = seen.join(open_, "key").select("key", "digest", F.col("_one.t0").alias("t0"), F.col("_one.t1").alias("t1"), F.col("_one.place").alias("place"), "_n")
    rows = written(samples.join(ones, ["key", "digest", "t0", "t1", "place"]).dropDuplicates(["key", "digest"]), "suffix-cover")
    keys = map_arrow(rows.where(F.col("_n") > MOST).select("key", "t0", "t1", "place", "most", "least", "left", "right"), _window_keys, "rank bigint, k0 bigint, k1 bigint, t0 bigint, t1 bigint, first bigint")
    again = keys.groupBy("rank", "k0", "k1").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").drop("_times")
    grouped = keys.join(again, ["rank", "k0", "k1"], "left_semi").select("t0", "t1", "first", F.col("first").alias("last"))
    return [sure.distinct(), _found(rows.where(F.col("_n") <= MOST), SIDE), grouped]


def repeated_windows(docs: DataFrame, text: str) -> DataFrame:
    """(t0, t1, first, last): runs of windows, by place of their first byte, of texts (t0, t1: 128 bits of a text)."""
    keyed = docs.select(F.xxhash64(F.col(text)).alias("t0"), F.xxhash64(F.lit(7), F.col(text)).alias("t1"), F.col(text).alias("_text")).where(F.octet_length("_text") >= LENGTH)
    hashes = map_arrow(keyed.select("t0", "_text"), _hashes, "hash bigint, t0 bigint, twice boolean")
    often = hashes.groupBy("hash").agg(F.min("t0").alias("a"), F.max("t0").alias("b"), F.max("twice").alias("twice")).where("a <> b OR twice").select("hash")
    often = written(often, "suffix-often")
    spots = map_arrow(keyed, _occurrences, "hash bigint, t0 bigint, t1 bigint, spot bigint, digest bigint")
    spots = written(spots.join(often, "hash"), "suffix-spots", drop=(often,))
    one = F.struct("t0", "t1", "spot")
    equal = written(spots.groupBy("hash", "digest").agg(F.min(one).alias("one"), (F.min(one) != F.max(one)).alias("equal")), "suffix-equal")
    # equal contexts: all windows repeat
    sure = spots.join(equal.where("equal").select("hash", "digest"), ["hash", "digest"], "left_semi")
    sure = sure.select("t0", "t1", (F.shiftright("spot", 24) - F.shiftright("spot", 12).bitwiseAND(4095)).alias("first"), (F.shiftright("spot", 24) - F.col("spot").bitwiseAND(4095)).alias("last")).distinct()
    # the others are looked at in their bucket, which is left out if all of it is settled
    open_ = equal.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.bool_or(~F.col("equal")).alias("open")).where("open AND n > 1").select("hash", (F.col("n") > MOST).alias("large"))
    wanted = equal.join(open_, "hash").select(F.col("one.t0").alias("t0"), F.col("one.t1").alias("t1"), F.struct("hash", "digest", F.col("one.spot").alias("spot"), "large").alias("w"))
    wanted = wanted.groupBy("t0", "t1").agg(F.collect_list("w").alias("wanted"))
    texts = keyed.join(wanted, ["t0", "t1"]).select("_text", "t0", "t1", "wanted")
    rows = written(map_arrow(texts, _contexts, _CONTEXT_SCHEMA), "suffix-contexts")
    small = rows.where("NOT ranked").dropDuplicates(["key", "digest", "t0", "t1", "place"])
    out = sure.unionByName(_found(small, LENGTH))
    cover = rows.where("ranked").drop("ranked")
    if not cover.isEmpty():
        for part in _cover_windows(cover):
            out = out.unionByName(part)
    return out


def remove_repeats(docs: DataFrame, *, text: str = "text", keep: dict[str, Column]) -> DataFrame:
    """The columns of keep with n_bytes, n_removed, n_spans, kept_sha256 and kept_text (what is left as text).

    Cuts can fall inside a character; kept_text drops the pieces of such characters, kept_sha256 is of all bytes left.
    """
    windows = repeated_windows(docs, text)
    t0, t1 = F.xxhash64(F.col(text)).alias("_t0"), F.xxhash64(F.lit(7), F.col(text)).alias("_t1")
    named = {f"_x_{n}": c for n, c in keep.items()}
    frame = docs.select(*[c.alias(n) for n, c in named.items()], t0, t1, F.col(text).alias("_text"))
    long = F.octet_length("_text") >= LENGTH
    spans = windows.groupBy(F.col("t0").alias("_t0"), F.col("t1").alias("_t1")).agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    copies = frame.where(long).groupBy("_t0", "_t1").agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    known = written(spans.join(copies, ["_t0", "_t1"], "full"), "suffix-known")
    joined = frame.where(long).join(known, ["_t0", "_t1"], "left").drop("_t0", "_t1")
    short = frame.where(F.coalesce(~long, F.lit(True))).drop("_t0", "_t1").withColumns({"_spans": F.lit(None).cast(joined.schema["_spans"].dataType), "_copies": F.lit(1).cast("bigint")})
    both = joined.unionByName(short)
    schema = ", ".join([f"`{n}` {t}" for n, t in both.dtypes if n in named] + ["n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string", "kept_text string"])
    made = map_arrow(both, _cut, schema)
    return made.select(*[F.col(f"_x_{n}").alias(n) for n in keep], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
