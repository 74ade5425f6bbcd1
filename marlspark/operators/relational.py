"""Pairing, de-duplication, circuit breakers, quotas, ids, anti-joins and contracts, as DataFrame operators.

All are shuffles on the key named, or none; no operator gathers rows on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspark.sources.store import placed


def pair_status(images: DataFrame, labels: DataFrame, keys: list[str], image: str, label: str) -> DataFrame:
    """Full outer pairing on keys: pair, image_only, json_only, or ambiguous where a side has more than one row.

    Rows with a null key pair with nothing; values of a side are its least.
    """
    left = images.groupBy(*keys).agg(F.count(F.lit(1)).alias("images"), F.min(image).alias(image))
    right = labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("jsons"), F.min(label).alias(label))
    both = left.join(right, keys, "full_outer").withColumns({"images": F.coalesce("images", F.lit(0)), "jsons": F.coalesce("jsons", F.lit(0))})
    status = F.when((F.col("images") > 1) | (F.col("jsons") > 1), "ambiguous").when(F.col("jsons") == 0, "image_only").when(F.col("images") == 0, "json_only").otherwise("pair")
    return both.withColumn("status", status)


def first_wins(df: DataFrame, group: list[Column | str], order: list[Column | str], winner: str, out: str = "winner") -> DataFrame:
    """df with the winner's value (the first of its group in order, nulls first) and whether the row is it.

    The winner is found by a min aggregate, which combines before its shuffle, so a large group is no hot task. Null is
    a group; of rows that tie in the order and in the value one is the winner, whichever.
    """
    names, first, tie = [f"_g{i}" for i in range(len(group))], "_first", "_tie"
    keyed = df.withColumns({n: g if isinstance(g, Column) else F.col(g) for n, g in zip(names, group, strict=True)})
    rank = F.struct(*[(o if isinstance(o, Column) else F.col(o)).alias(f"_o{i}") for i, o in enumerate(order)], F.col(winner).alias("_w"))
    firsts = keyed.groupBy(*names).agg(F.min(rank).alias(first))
    joined = keyed.join(firsts.select(*[F.col(n).alias(f"{n}r") for n in names], first), [F.col(n).eqNullSafe(F.col(f"{n}r")) for n in names]).withColumn(out, F.col(f"{first}._w"))
    hit = F.col(first).eqNullSafe(rank)
    # only rows that could win are numbered: one of each group, as a rule
    top = joined.where(hit).withColumn(tie, F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0)))).withColumn("is_first", F.col(tie) == 1).drop(tie)
    rest = joined.where(~hit).withColumn("is_first", F.lit(False))
    return top.unionByName(rest).drop(first, *names, *[f"{n}r" for n in names])


def error_runs(df: DataFrame, reason: Column, order: str, partition: list[str], neutral: Column | None = None) -> DataFrame:
    """df with consecutive (length so far of the run of one reason) and cumulative (of the reason so far); null reasons reset runs.

    Rows for which neutral holds neither extend nor reset a run; both of their numbers are 0 and their reason is null.
    """
    by = Window.partitionBy(*partition, "_n").orderBy(order)
    marked = df.withColumn("_n", F.coalesce(neutral, F.lit(False)) if neutral is not None else F.lit(False))
    marked = marked.withColumn("_r", F.when(~F.col("_n"), reason))
    fresh = F.col("_r").isNull() | ~F.col("_r").eqNullSafe(F.lag("_r").over(by))
    marked = marked.withColumn("_break", fresh.cast("int"))
    marked = marked.withColumn("_island", F.sum("_break").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*partition, "_n", "_island").orderBy(order)
    total = Window.partitionBy(*partition, "_r").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    none = F.col("_r").isNull()
    out = marked.withColumn("consecutive", F.when(none, 0).otherwise(F.row_number().over(run))).withColumn("cumulative", F.when(none, 0).otherwise(F.count(F.lit(1)).over(total)))
    return out.drop("_break", "_island", "_n").withColumnRenamed("_r", "reason")


def first_n(df: DataFrame, group: list[str], order: list[Column | str], n: Column | int) -> DataFrame:
    """The first n rows of each group; ranks by a window that Spark limits within the map side."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def dense_ids(df: DataFrame, key: list[str], order: str, start: int, id_col: str = "issued_id", most: int | None = None) -> DataFrame:
    """One row for each key: first (its least order) and the id start + number of keys seen before.

    Keys are numbered in sorted ranges. Null is a key; keys without an order come last, by key. ValueError where an id
    would be more than most.
    """
    firsts = df.groupBy(*key).agg(F.min(order).alias("first"))
    late = "_late"
    while late in firsts.columns:
        late += "_"
    numbered, n = placed(firsts.withColumn(late, F.col("first").isNull()), [late, "first", *key], "_place")
    if most is not None and start + n - 1 > most:
        raise ValueError("synthetic battery ID range exhausted")
    return numbered.select(*key, "first", (F.col("_place") + start).alias(id_col))


def cache_join(rows: DataFrame, cache: DataFrame, key: list[str], signature: list[str], value: str, threshold: float, order: str | None = None) -> DataFrame:
    """rows with hit (all of the signature equal) and excluded (the threshold applied anew to the cached value of hits).

    Of a key that the cache has twice the last by order counts (without an order the largest), so rows never multiply.
    A null key matches nothing; a null in the signature matches a null.
    """
    entry = F.struct(*[F.col(s).alias(s) for s in signature], F.col(value).alias("_value"))
    last = F.max_by(entry, order) if order else F.max(entry)
    kept = cache.groupBy(*key).agg(last.alias("_e"))
    cached = kept.select(*[F.col(k).alias(f"_c_{k}") for k in key], "_e")
    joined = rows.join(cached, [F.col(k) == F.col(f"_c_{k}") for k in key], "left")
    same = F.col("_e").isNotNull()
    for s in signature:
        same = same & F.col(s).eqNullSafe(F.col(f"_e.{s}"))
    told = joined.withColumn("hit", F.coalesce(same, F.lit(False)))
    told = told.withColumn("cached", F.when(F.col("hit"), F.col("_e._value")))
    return told.withColumn("excluded", F.coalesce(F.col("hit") & (F.col("cached") >= threshold), F.lit(False))).drop("_e", *[f"_c_{c}" for c in key])


def contract_counts(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Counts for each grouping set in one pass; columns out of a set are null."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"))


def contract_diff(actual: DataFrame, expected: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose counts differ, or which only one side has; empty where the contract holds."""
    both = actual.withColumnRenamed("n", "actual").join(expected.withColumnRenamed("n", "expected"), key, "full_outer")
    return both.where(~F.col("actual").eqNullSafe(F.col("expected")))


def duplicates(df: DataFrame, key: list[Column], order: str) -> DataFrame:
    """Keys that occur more than once, with count and the second occurrence in order (nulls first; of a tie the same value).

    Null is a key. A window that Spark limits to two rows of a key before its shuffle finds the second one.
    """
    names = [f"key{i}" for i in range(len(key))]
    keyed = df.select(*[k.alias(n) for k, n in zip(key, names, strict=True)], F.col(order).alias("second"))
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(F.asc_nulls_first("second")))
    second = keyed.withColumn("_rank", rank).where("_rank = 2").drop("_rank")
    on = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    return second.join(counts.select(*[F.col(n).alias(f"_{n}") for n in names], "n"), on).select(*names, "n", "second")


def ordered_digest(df: DataFrame, line: Column, order: list[str], limit: int = 64 << 20) -> DataFrame:
    """SHA-256 of the lines in order, one row; for listings of at most limit bytes, as they meet in one task.

    Longer ones raise when run; a listing of any length is hashed as it streams by (plans.scan.raw_fingerprint). A null
    line is left out; no line at all gives the digest of nothing.
    """
    told = "_line"
    while told in df.columns:
        told += "_"
    text = F.expr(f"listagg({told}, '') WITHIN GROUP (ORDER BY " + ", ".join(f"`{c}`" for c in order) + ")")
    size = F.coalesce(F.sum(F.octet_length(told)), F.lit(0))
    fault = F.raise_error(F.lit(f"a listing of more than {limit} bytes"))
    made = F.sha2(F.coalesce(text, F.lit("")), 256)
    return df.withColumn(told, line).agg(size.alias("_size"), made.alias("_made")).select(F.when(F.col("_size") > limit, fault.cast("string")).otherwise(F.col("_made")).alias("fingerprint"))
