"""Near duplicates by one-permutation MinHash.

One pass hashes every 5-word shingle of a text once, puts the hashes into 128 bins by their first seven bits and
keeps the least of each bin; empty bins borrow from a bin that a second hash names (optimal densification). The
first 125 bins make 25 bands of 5. Texts with equal shingle sets become one class before any bucket is made, so
large groups of copies cost one row for each bucket. In a bucket every class is paired with one centre (a star), so
the pairs are no more than the rows; a second star takes in the classes that are not linked with the first centre.
Pairs are confirmed on the full shingle sets, and the links make components.

A star can miss a link between two classes neither of which is linked to the centre. In buckets that still hold more
than one component, each class is therefore reduced to its difference from the centre, and pairs are found by what
their differences share (see further_links). The bounds used are exact, whatever the texts and the size of a bucket:
of two classes that share a bucket and are alike enough, no link is lost, and no bucket is compared in full.

Defined results: a null, empty or blank text has no shingles and is linked with nothing; a row with a null doc_id is
kept and has no component; rows with the same doc_id are one document with each of their texts; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspark.llm.frames import components, forget, fresh, map_arrow, row_key, small_batches, written
from marlspark.llm.words import BASE, STEP, mix, shingles, split_words, text_bytes

BINS, BANDS, ROWS = 128, 25, 5


def _donors(tries: int) -> np.ndarray:
    """donor[k, i]: the bin that an empty bin i asks at its k-th try."""
    k, i = np.meshgrid(np.arange(tries, dtype=np.uint64), np.arange(BINS, dtype=np.uint64), indexing="ij")
    return (mix(k * np.uint64(BINS) + i + BASE) >> np.uint64(57)).astype(np.int64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BINS values for each set; sets must not be empty."""
    size = np.array([len(s) for s in sets])
    doc, value = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    cell = doc * BINS + (value >> np.uint64(57)).astype(np.int64)
    first = np.concatenate([[True], cell[1:] != cell[:-1]])  # sets are sorted: the first of a bin is its least
    out, full = np.zeros(len(sets) * BINS, np.uint64), np.zeros(len(sets) * BINS, bool)
    out[cell[first]], full[cell[first]] = value[first], True
    empty, k = np.flatnonzero(~full), 0
    while len(empty):
        if k % 256 == 0:
            donors = _donors(k + 256)
        donor = empty - empty % BINS + donors[k][empty % BINS]
        found = full[donor]
        out[empty[found]] = out[donor[found]]
        empty, k = empty[~found], k + 1
    return out.reshape(-1, BINS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * STEP, rows.shape[:2])
    for j in range(ROWS):
        key = mix(key * BASE + rows[:, :, j])
    return key.view(np.int64)


def _node(d0: np.ndarray, d1: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(mix(d0 + STEP * d1) + size.astype(np.uint64))


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """One number for each set, equal for equal sets."""
    size = np.array([len(s) for s in sets], np.int64)
    d0, d1 = (np.array([int(mix(s ^ np.uint64(salt)).sum(dtype=np.uint64)) for s in sets], np.uint64) for salt in (0, 0x5851F42D4C957F2D))
    return _node(d0, d1, size).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "_text"):
        sets = shingles(split_words(*text_bytes(batch.column(batch.schema.get_field_index("_text")))))
        size = np.array([len(s) for s in sets], np.int64)
        some = np.flatnonzero(size)
        keys = band_keys(signatures([sets[i] for i in some])) if len(some) else np.zeros((0, BANDS), np.int64)
        offsets = np.concatenate([[0], np.cumsum((size > 0) * BANDS)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
        rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "_text"]
        yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(size), pa.array(_digests(sets)), bands], names=[n for n, _ in rest] + ["n_shingles", "node", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "_text"):
        sets = shingles(split_words(*text_bytes(batch.column(0))))
        yield pa.RecordBatch.from_arrays([pa.array(_digests(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])


def _common(s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of two sorted sets: for each value of t whether s has it, and its place in s if so."""
    at = np.searchsorted(s, t)
    at[at == len(s)] = 0
    return s[at] == t, at


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = int(_common(s, t)[0].sum())
                good.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], names=["a", "b", "linked"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough; sets of too different a size are not compared."""
    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b")
    near = 100 * F.least(F.length("x"), F.length("y")) >= percent * F.greatest(F.length("x"), F.length("y"))
    return map_arrow(both.where(near).select("a", "b", "x", "y"), _confirm(percent), "a bigint, b bigint, linked boolean").where("linked").select("a", "b")


def _compared(percent: int):
    """Of (hub, node, wide, x, y), sets x of the hub and y of the node: whether they are linked, the sizes m and n, miss (of the hub's shingles), and for wide pairs the symmetric difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "y"):
            linked, n, m, miss, diffs = [], [], [], [], []
            for wide, x, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                hit, at = _common(s, t)
                both = int(hit.sum())
                linked.append(100 * both >= percent * (len(s) + len(t) - both))
                n.append(len(t))
                m.append(len(s))
                miss.append(len(s) - both)
                if wide:
                    rest = np.ones(len(s), bool)
                    rest[at[hit]] = False
                    diffs.append(np.concatenate([s[rest], t[~hit]]).tobytes())
                else:
                    diffs.append(None)
            sizes = [pa.array(v, pa.int64()) for v in (n, m, miss)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), *sizes, pa.array(diffs, pa.binary())], names=["hub", "node", "linked", "n", "m", "miss", "diff"])

    return run


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stars (hub, node, wide) with what _compared gives. The hub's set is joined last, so its copies are not shuffled."""
    held = lambda c, x: sets.select(F.col("node").alias(c), F.col("shingles").alias(x))
    both = pairs.join(held("node", "y"), "node").join(held("hub", "x"), "hub").select("hub", "node", "wide", "x", "y")
    return map_arrow(both, _compared(percent), "hub bigint, node bigint, linked boolean, n bigint, m bigint, miss bigint, diff binary")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, node, element) for each value of the difference; an element is a value of one hub."""
    for batch in small_batches(batches, "diff"):
        hub, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
        size = [len(x) for x in parts]
        if sum(size):
            hubs = np.repeat(hub, size)
            yield pa.RecordBatch.from_arrays([pa.array(hubs), pa.array(np.repeat(node, size)), pa.array(mix(np.concatenate(parts) ^ hubs.view(np.uint64)).view(np.int64))], names=["hub", "node", "element"])


def _tallied(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """(element, times, hub, node: one of its owners) of rows (hub, node, element), summed over about most rows at a time."""
    held, n = [], 0

    def flush() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        value, first, times = np.unique(rows["element"].to_numpy(), return_index=True, return_counts=True)
        at = pa.array(first)
        return pa.RecordBatch.from_arrays([pa.array(value), pa.array(times.astype(np.int64)), rows["hub"].combine_chunks().take(at), rows["node"].combine_chunks().take(at)], names=["element", "times", "hub", "node"])

    for batch in _elements(batches):
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            yield flush()
            held, n = [], 0
    if held:
        yield flush()


def further_links(state: DataFrame, stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links between the rows of state (key, node, hub, root) with different roots, as (a, b); None if there can be none.

    Let a hub have m shingles, of which a class of n lacks r; d is the symmetric difference of the two. Two classes of
    the hub share m - r1 - r2 + |d1 and d2| shingles. With need = percent * n + (100 + percent) * r they are linked if
    (100 + percent) * |d1 and d2| >= need1 + need2 - (100 + percent) * m, which is over 0 if one of them is not linked
    with the hub. A class that has common values of its difference with any others at all can give
    give = (100 + percent) * (m + common) - need; a link asks that the need of each is at most what the other gives.
    Classes that no class of another root in their bucket can serve leave. Of the others the differences are joined
    on their rarest values: two that share c of them share one among all but the c - 1 most frequent of each.
    """
    whole = 100 + percent
    spokes = state.where("node <> hub")
    diffs = written(spokes.select("hub", "node").distinct().join(stars, ["hub", "node"]), "near-differences")
    tally = map_arrow(diffs.select("hub", "node", "diff"), _tallied, "element bigint, times bigint, hub bigint, node bigint")
    own = tally.groupBy("element").agg(F.sum("times").alias("times"), F.min(F.struct("hub", "node")).alias("o")).where("times = 1")
    own = own.groupBy("o.hub", "o.node").agg(F.count(F.lit(1)).alias("own"))
    bound = diffs.select("hub", "node", "n", "m", "miss", (F.length("diff") / 8).cast("bigint").alias("size")).join(own, ["hub", "node"], "left")
    bound = bound.withColumn("need", percent * F.col("n") + whole * F.col("miss")).withColumn("give", whole * (F.col("m") + F.col("size") - F.coalesce("own", F.lit(0))) - F.col("need"))
    full = written(spokes.join(bound.select("hub", "node", "n", "m", "need", "give"), ["hub", "node"]), "near-shares")
    per = full.groupBy("key", "root").agg(F.max("give").alias("give"), F.min("need").alias("need"))
    first = per.groupBy("key").agg(F.max(F.struct("give", "root")).alias("g"), F.min(F.struct("need", "root")).alias("q"))
    second = per.join(first, "key").groupBy("key", "g", "q").agg(F.max(F.when(F.col("root") != F.col("g.root"), F.col("give"))).alias("g2"), F.min(F.when(F.col("root") != F.col("q.root"), F.col("need"))).alias("q2"))
    other = full.join(second, "key").withColumn("_give", F.when(F.col("root") != F.col("g.root"), F.col("g.give")).otherwise(F.col("g2"))).withColumn("_need", F.when(F.col("root") != F.col("q.root"), F.col("q.need")).otherwise(F.col("q2")))
    alive = other.where("need <= _give AND _need <= give").groupBy("hub", "node", "root", "n", "m", "need", "give").agg(F.min("_need").alias("_need"))
    alive = written(alive, "near-alive", drop=(full,))
    if alive.isEmpty():
        forget(alive, diffs)
        return None
    values = map_arrow(diffs.select("hub", "node", "diff").join(alive.select("hub", "node"), ["hub", "node"], "left_semi"), _elements, "hub bigint, node bigint, element bigint")
    values = written(values, "near-values", drop=(diffs,))
    rare = values.join(values.groupBy("element").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "element")
    by = Window.partitionBy("hub", "node")
    rank = F.row_number().over(by.orderBy("times", "element"))
    placed = rare.withColumns({"rank": rank, "total": F.count(F.lit(1)).over(by)}).drop("times")
    least = F.greatest(F.lit(1), F.ceil((F.col("need") + F.col("_need")) / whole) - F.col("m"))
    heads = placed.join(alive, ["hub", "node"]).where(F.col("rank") <= F.col("total") - least + 1).select("element", "node", "root", "n", "need", "give")
    heads = written(heads, "near-heads", drop=(alive, values))
    x, y = (heads.select("element", *[F.col(c).alias(f"{c}{i}") for c in ("node", "root", "n", "need", "give")]) for i in (1, 2))
    near = 100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")
    met = x.join(y, "element").where("node1 < node2 AND root1 <> root2 AND need1 <= give2 AND need2 <= give1").where(near)
    pairs = written(met.select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct(), "near-pairs", drop=(heads,))
    return written(confirmed(pairs, sets, percent), "near-links", drop=(pairs,))


def class_links(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels (node, root) of the classes of member (key, node, size, degree) that are linked with another one."""
    # the centre of a bucket is the class that shares the largest buckets: as a rule the text that others were made from
    top = F.max(F.struct("degree", "node")).alias("_top")
    hubs = member.groupBy("key").agg(top).select("key", F.col("_top.node").alias("hub"))
    placed = written(member.join(hubs, "key"), "near-placed")
    pairs = placed.where("node <> hub").groupBy("hub", "node").agg(F.max(F.col("size") > 2).alias("wide"))
    stars = written(compared(pairs, sets, percent), "near-stars")
    # a second star among the classes of a bucket that are not linked with its hub
    free = placed.where("size > 2").join(stars.where("NOT linked").select("hub", "node"), ["hub", "node"], "left_semi")
    free = written(free.select("key", "node", "degree"), "near-free")
    centres = free.groupBy("key").agg(top, F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key", F.col("_top.node").alias("centre"))
    again = free.join(centres, "key").where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    found = written(stars.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b")).unionByName(confirmed(again, sets, percent)), "near-links", drop=(free,))
    labels = components(found)
    forget(found)
    # buckets that hold more than one component: what is left to compare
    state = placed.where("size > 2").select("key", "node", "hub").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = state.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("key")
    state = written(state.join(open_, "key", "left_semi"), "near-open", drop=(placed,))
    found = None if state.isEmpty() else further_links(state, stars, sets, percent)
    forget(state, stars)
    if found is None or found.isEmpty():
        return labels
    root = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    lifted = found.join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    more = components(lifted)
    moved = labels.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(moved.unionByName(more.join(labels.select("node"), "node", "left_anti")), "near-labels", drop=(found, labels, more))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = 80, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, the columns of keep, n_shingles, component_id and kept.

    percent: two documents are linked if 100 * intersection >= percent * union of their shingle sets. component_id is
    the smallest doc_id reachable by links, kept whether it is the row's own. Any two sets alike to 0.85 share a
    bucket with probability 1 - 4e-7, to 0.80 with 1 - 5e-5.
    """
    extra = keep or {}
    frame = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in extra.items()], F.col(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "_text"] + ["n_shingles bigint", "node bigint", "bands array<bigint>"])
    signed = written(map_arrow(frame, _signed, schema), "near-signed")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # copies meet here: what follows has one row for each distinct set and bucket
    rows = written(named.select("node", F.explode("bands").alias("key")).distinct(), "near-buckets")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    member = written(rows.join(shared, "key"), "near-members", drop=(rows,))
    degree = member.groupBy("node").agg(F.sum("size").alias("degree"))
    member = written(member.join(degree, "node").select("key", "node", "size", "degree"), "near-degrees", drop=(member,))
    classes = written(named.groupBy("node").agg(F.min("doc_id").alias("least")), "near-classes")
    wanted = classes.join(member.select("node").distinct(), "node", "left_semi").select(F.col("least").alias("_id")).distinct()
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(wanted, "_id", "left_semi").select("_text")
    sets = written(map_arrow(texts, _sets, "node bigint, shingles binary").dropDuplicates(["node"]), "near-sets")
    labels = class_links(member, sets, percent)
    forget(member, sets)
    rooted = classes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    tops = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(rooted.join(tops, "root").select("node", "component_id"), "near-ids", drop=(classes, labels))
    linked = named.drop("bands").join(classes, "node")
    alone = signed.drop("bands").where("n_shingles = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    out = linked.unionByName(alone, allowMissingColumns=True)
    return out.select("doc_id", *extra, "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One row of docs for each component, with its own columns; rows that are equal throughout count as one.

    Rows without shingles and rows without a doc_id are all kept (equal ones as one).
    """
    k0, k1 = fresh(docs.columns, "_k0", "_k1")
    marked = docs.withColumns(dict(zip((k0, k1), row_key(*docs.columns), strict=True)))
    found = near_duplicates(marked, doc_id=doc_id, text=text, percent=percent, keep={"_x_k0": F.col(k0), "_x_k1": F.col(k1)})
    # of the rows with the component's own doc_id the one of the least key stays
    solo = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    best = found.where(~solo & F.col("kept")).groupBy("component_id").agg(F.min(F.struct("_x_k0", "_x_k1")).alias("_k")).select(F.col("_k._x_k0").alias(k0), F.col("_k._x_k1").alias(k1))
    stay = best.unionByName(found.where(solo).select(F.col("_x_k0").alias(k0), F.col("_x_k1").alias(k1))).distinct()
    return marked.join(stay, [k0, k1], "left_semi").dropDuplicates([k0, k1]).select(*docs.columns)
