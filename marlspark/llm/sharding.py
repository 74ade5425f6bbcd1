"""Shards by extendible hashing, with DataFrame operations only.

A document belongs to the bucket of the first bits of its hash. Only a bucket over the byte limit is split, on one more
bit, so the shards are the shallowest buckets that fit. The directory has an entry for each prefix of the global depth
and gives the depth of its shard; documents find their shard by a join on that prefix.

Sizes are summed once at a depth that is enough for even hashes, and the sums of shallower buckets follow from those.
Buckets that are still too large at that depth are taken deeper, eight bits at a time; nothing else is read again. Rows
with one and the same doc_id cannot be told apart by its hash: where they alone exceed the limit, the bucket (all 60
bits) is split by a second hash, over the place of the row.

Defined results: a null doc_id hashes as an empty one; a null text has 0 bytes; a single document over the limit is a
shard of its own, alone or with what shares all its bits; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import written

BITS, STEP = 60, 8


def hash_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of a string."""
    return F.conv(F.substring(F.md5(F.coalesce(value, F.lit(""))), 1, 15), 16, 10).cast("long")


def _prefix(column: str, depth: int) -> Column:
    return F.shiftrightunsigned(column, BITS - depth)


def _directory(open_: DataFrame, low: int, depth: int, limit: int) -> DataFrame:
    """(fine, depth, bytes): for each prefix of so many bits the shallowest bucket that fits, from low bits on; depth is null where none does."""
    fine = written(open_.groupBy(_prefix("_h", depth).alias("fine")).agg(F.sum("_b").alias("b"), F.count(F.lit(1)).alias("n")), "shard-sums")
    # levels above are summed in strides, so that a level is made from few more rows than it has
    sums, level = [fine.select(F.lit(depth).alias("d"), F.col("fine").alias("p"), "b", "n")], depth
    while level > low:
        top = max(low, level - STEP)
        rolled = sums[-1].where(F.col("d") == level).select(F.explode(F.sequence(F.lit(top), F.lit(level - 1))).alias("d"), "p", "b", "n")
        rolled = rolled.groupBy("d", F.expr(f"shiftrightunsigned(p, {level} - d)").alias("p")).agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        sums.append(written(rolled, "shard-levels"))
        level = top
    fits = None
    for part in sums:
        good = part.where((F.col("b") <= limit) | (F.col("n") == 1))
        fits = good if fits is None else fits.unionByName(good)
    # each fine prefix looks up its own prefixes, from the shallowest level on
    own = fine.select("fine", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("d")).withColumn("p", F.expr(f"shiftrightunsigned(fine, {depth} - d)"))
    best = own.join(fits, ["d", "p"]).groupBy("fine").agg(F.min(F.struct("d", "b")).alias("_best"))
    return written(fine.select("fine").join(best, "fine", "left").select("fine", F.col("_best.d").alias("depth"), F.col("_best.b").alias("bytes")), "shard-directory")


def _assign(rows: DataFrame, limit: int) -> tuple[DataFrame | None, DataFrame]:
    """rows (_h, _b, ...) with depth, prefix and bytes; and the rows of buckets too large with all bits."""
    total = rows.agg(F.sum("_b")).first()[0] or 0
    depth, low = min(BITS, max(1, math.ceil(math.log2(max(total / limit, 1))) + 4)), 0
    done: DataFrame | None = None
    while True:
        found = rows.withColumn("fine", _prefix("_h", depth)).join(_directory(rows, low, depth, limit), "fine")
        fit = found.where("depth IS NOT NULL").withColumn("prefix", F.expr(f"shiftrightunsigned(_h, {BITS} - depth)")).drop("fine")
        done = fit if done is None else done.unionByName(fit)
        rows = written(found.where("depth IS NULL").drop("fine", "depth", "bytes"), "shard-open")
        if depth >= BITS or rows.isEmpty():
            return done, rows
        low, depth = depth + 1, min(BITS, depth + STEP)


def assign_shards(docs: DataFrame, *, limit: int, doc_id: str = "doc_id", text: str = "text", keep: list[str]) -> DataFrame:
    """The columns of keep, shard, depth, prefix and shard_bytes of each row: shard names depth and prefix."""
    named = {f"_x_{c}": F.col(c) for c in keep}
    rows = docs.select(*[c.alias(n) for n, c in named.items()], hash_bits(F.col(doc_id).cast("string")).alias("_h"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_b"), F.monotonically_increasing_id().alias("_row"))
    rows = written(rows, "shard-rows")
    done, over = _assign(rows, limit)
    name = F.concat_ws(":", F.col("depth").cast("string"), F.col("prefix").cast("string"))
    out = done.withColumn("shard", name)
    if not over.isEmpty():
        second = over.withColumn("_first", F.col("_h")).withColumn("_h", hash_bits(F.concat_ws("/", F.col("_first").cast("string"), F.col("_row").cast("string"))))
        again, left = _assign(second, limit)
        again = again.unionByName(left.withColumns({"depth": F.lit(BITS), "bytes": F.col("_b"), "prefix": F.col("_h")}))
        again = again.withColumn("shard", F.concat_ws("/", F.concat_ws(":", F.lit(str(BITS)), F.col("_first").cast("string")), name))
        out = out.unionByName(again.drop("_first"))
    return out.select(*[F.col(f"_x_{c}").alias(c) for c in keep], "shard", F.col("depth").cast("int").alias("depth"), "prefix", F.col("bytes").alias("shard_bytes"))
