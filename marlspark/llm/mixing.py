"""Sources mixed to target weights by a Pfair schedule.

The texts of a source are dealt in an order by hash and cut into blocks of so many bytes. A source of weight w has
the window of slots from floor(k / w) to ceil((k + 1) / w) for its k-th block; in each slot the earliest deadline of the
released blocks goes first. So in every prefix of the schedule each source is less than one block away from its share.

That holds for the weights as they are: they are whole numbers over their sum without any rounding, and the schedule is
made over all blocks (one row a block; the driver makes it in one pass and holds a block as three numbers). Places
within a source are running sums, made in two steps (sums of hash slices, then within a slice), so that no task holds a
whole source. With a period the weights are rounded to multiples of 1 / period instead, one at least.

Nothing is dropped: when a source ends, no other takes its share; each block of the others stays in its own window, and
slots in which none may go stay empty.

Defined results: a null source is a source; a null or empty text has 0 bytes and shares the block where it falls; rows
that are repeated follow each other; a source without a target weight (or with 0) gets the least weight of the others; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspark.llm.frames import fresh, row_key, written


#: Columns that carry the schedule; columns of the input with these names are replaced.
MIXED = ("mix_slot", "mix_order")


def whole_weights(weights: list[float], period: int) -> list[int]:
    """Slots of each source in a period: in proportion by largest remainders, one at least; they sum to period."""
    if period < len(weights):
        raise ValueError("a period has a slot for each source at least")
    total, spare = sum(weights) or 1.0, period - len(weights)
    ideal = [max(w / total * period - 1, 0) for w in weights]
    scale = spare / (sum(ideal) or 1.0)
    slots = [int(x * scale) for x in ideal]
    order = sorted(range(len(weights)), key=lambda i: (slots[i] - ideal[i] * scale, i))
    for i in order[: spare - sum(slots)]:
        slots[i] += 1
    return [1 + s for s in slots]


def exact_shares(weights: list[float]) -> list[int]:
    """Whole numbers in the exact proportion of the weights; a weight of 0 counts as the least of the others."""
    least = min((w for w in weights if w > 0), default=1.0)
    parts = [Fraction(w if w > 0 else least) for w in weights]
    unit = math.lcm(*[x.denominator for x in parts])
    return [int(x * unit) for x in parts]


def pfair_slots(shares: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of so many blocks of each source, by earliest deadline among released blocks."""
    whole = sum(shares)
    waiting = [(0, i, 0) for i, n in enumerate(blocks) if n]  # release, source, block
    ready: list[tuple[int, int, int]] = []
    heapq.heapify(waiting)
    t = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * whole // shares[i]), i, k))
        _, i, k = heapq.heappop(ready)
        yield i, k, t
        t += 1
        if k + 1 < blocks[i]:
            heapq.heappush(waiting, ((k + 1) * whole // shares[i], i, k + 1))


def pfair(slots: list[int]) -> list[tuple[int, int]]:
    """The (source, block) of each slot of a period."""
    return [(i, k) for i, k, _ in pfair_slots(slots, slots)]


def schedule(docs: DataFrame, *, block_bytes: int, weights: dict[str, float] | None = None, power: float = 0.5, period: int | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: dict[str, Column], max_sources: int = 10_000) -> DataFrame:
    """The columns of keep with source, n_bytes, place (bytes of its source before it), block, slot and order.

    period: slots after which rounded weights repeat; without, the weights are not rounded.
    weights: target weight by source; without, a source weighs its bytes to the power. Rows go by (slot, order). More
    than max_sources sources are an error, as the weights are handled on the driver.
    """
    columns = {f"_x_{n}": c for n, c in keep.items()}
    frame = docs.select(*[c.alias(n) for n, c in columns.items()], F.col(source).cast("string").alias("source"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.xxhash64(F.lit(11), F.col(doc_id), F.col(text)).alias("order"))
    frame = written(frame, "mix-rows")
    sizes = frame.groupBy("source").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
    found = sizes.orderBy(F.asc_nulls_first("source")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    if weights is None:
        target = [max(r["b"], 1) ** power for r in found]
    else:
        target = [weights.get(r["source"], 0.0) for r in found]
    spark = docs.sparkSession
    shares = exact_shares(target) if period is None or not found else whole_weights(target, max(period, 2 * len(found)))
    made = [array("q") for _ in range(3)]
    # a row at the end of its source without bytes may start a block
    for row in pfair_slots(shares, [r["b"] // block_bytes + 1 for r in found]):
        for column, value in zip(made, row, strict=True):
            column.append(value)
    table = spark.createDataFrame(pa.table([pa.array(memoryview(x), pa.int64()) for x in made], ["_i", "block", "slot"]))
    table = written(table, "mix-slots-of-blocks")
    number = spark.createDataFrame([(r["source"], i) for i, r in enumerate(found)], "_s string, _i bigint")
    rows = sum(r["n"] for r in found)
    bits = max(0, (rows // 4000).bit_length())
    sliced = frame.withColumn("_slice", F.shiftrightunsigned("order", 64 - bits) if bits else F.lit(0).cast("long"))
    sums = sliced.groupBy("source", "_slice").agg(F.sum("n_bytes").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.select(F.col("source").alias("_s"), F.col("_slice").alias("_l"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")), "mix-starts")
    inside = Window.partitionBy("source", "_slice").orderBy(F.col("order"), *[F.col(c) for c in columns]).rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("_own", F.coalesce(F.sum("n_bytes").over(inside), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_l"))).withColumn("place", F.col("_start") + F.col("_own")).drop("_s", "_l")
    placed = placed.withColumn("block", F.floor(F.col("place") / block_bytes).cast("long"))
    # number has at most max_sources rows; the table of blocks grows with the data and is broadcast only while small
    placed = placed.join(F.broadcast(number), F.col("source").eqNullSafe(F.col("_s"))).join(table, ["_i", "block"])
    return placed.select(*[F.col(f"_x_{n}").alias(n) for n in keep], "source", "n_bytes", "place", "block", "slot", F.col("place").alias("order"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs with mix_slot and mix_order, by which they go in the order of the schedule.

    The order is in these two columns, whatever becomes of the files; rows are also dealt into files by ranges of slots.
    Rows that are repeated have places of their own.
    """
    names = [c for c in docs.columns if c.lower() not in MIXED]
    k0, k1, row = fresh(names, "_k0", "_k1", "_row")
    keys = row_key(*names)
    rows = written(docs.select(*names, keys[0].alias(k0), keys[1].alias(k1), F.monotonically_increasing_id().alias(row)), "mix-docs")
    found = schedule(rows, keep={c: F.col(c) for c in (k0, k1, row)}, **options)
    found = found.select(row, F.col("slot").alias("mix_slot"), F.col("order").alias("mix_order"))
    joined = rows.join(written(found, "mix-slots"), row)
    order = ["mix_slot", "mix_order", k0]
    return joined.repartitionByRange(*order).sortWithinPartitions(*order).select(*names, *MIXED)
