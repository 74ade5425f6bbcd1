"""Dealing out sources to slots: picks that depend on what earlier slots took, and substitutes for failed ones."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(constrained: list[bool], eligible: list[bool]) -> list[int | None]:
    """For each slot the place of its source: the first eligible one left for a constrained slot, the first left for another."""
    able, others = [i for i, e in enumerate(eligible) if e], [i for i, e in enumerate(eligible) if not e]
    out: list[int | None] = []
    for need in constrained:
        if need or (able and (not others or able[0] < others[0])):
            out.append(heapq.heappop(able) if able else None)
        else:
            out.append(heapq.heappop(others) if others else None)
    return out


def greedy_picks(slots: DataFrame, pool: DataFrame, *, group: str, slot: str, constrained: str, rank: str, eligible: str) -> DataFrame:
    """(group, slot, rank) for each slot in ascending order; rank is null where the pool has nothing left for it.

    Null is a group. What a slot gets depends on all before it, so a group is one task; only four narrow columns go there, and the pool
    is cut to the rows that can be reached: as many eligible and as many other ones as the group has slots.
    """
    size = slots.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(Window.partitionBy(group, eligible).orderBy(rank))
    sized = size.select(F.col(group).alias("_group"), "_n")
    reach = pool.select(group, rank, eligible).join(sized, F.col(group).eqNullSafe(F.col("_group"))).withColumn("_p", place).where("_p <= _n")
    left = slots.select(group, F.col(slot).cast("long").alias("_o"), F.col(constrained).alias("_f"), F.lit(True).alias("_s"))
    right = reach.select(group, F.col(rank).cast("long").alias("_o"), F.col(eligible).alias("_f"), F.lit(False).alias("_s"))
    kind = slots.schema[group].dataType.simpleString()

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("_o", kind="stable")
        wanted, have = df[df["_s"]], df[~df["_s"]]
        places = _pick(wanted["_f"].fillna(False).astype(bool).tolist(), have["_f"].fillna(False).astype(bool).tolist())
        ranks = have["_o"].tolist()
        got = pd.array([None if p is None else ranks[p] for p in places], dtype="Int64")
        return pd.DataFrame({group: wanted[group].to_numpy(), slot: wanted["_o"].to_numpy(), rank: got})

    return left.unionByName(right).groupBy(group).applyInPandas(run, f"`{group}` {kind}, `{slot}` bigint, `{rank}` bigint")


def substitutes(failed: DataFrame, reserve: DataFrame, consumed: DataFrame, *, group: str, slot: str, rank: str, key: list[str]) -> DataFrame:
    """Each failed slot with the next reserve row of its group that is not consumed; reserve columns are null once it is used up.

    Both sides are numbered in order and joined by number, so no state is carried from slot to slot.
    """
    number = lambda df, by: df.withColumn("_i", F.row_number().over(Window.partitionBy(group).orderBy(by)))
    spare = reserve.join(consumed.select(*key).distinct(), key, "left_anti")
    return number(failed.select(group, slot), slot).join(number(spare, rank), [group, "_i"], "left").drop("_i")


def quota_cases(quotas: list[tuple[str, int]]) -> list[str]:
    """The cases of a plan in the order of the quotas, each as often as its quota says."""
    return [case for case, n in quotas for _ in range(n)]


def checked_quotas(quotas: list[tuple[str, int]], known: list[str], target: int, *, test: int = 0) -> None:
    """ValueError for unknown or repeated cases, negative quotas, a sum other than target, or more test slots than slots."""
    names = [case for case, _ in quotas]
    rules: list[tuple[Callable[[], bool], str]] = [
        (lambda: not set(names) - set(known), f"unknown cases: {sorted(set(names) - set(known))}"),
        (lambda: len(set(names)) == len(names), "a case has two quotas"),
        (lambda: all(n >= 0 for _, n in quotas), "a quota is negative"),
        (lambda: sum(n for _, n in quotas) == target, f"quotas sum to {sum(n for _, n in quotas)}, not {target}"),
        (lambda: 0 <= test <= target, "more test slots than slots"),
    ]
    for holds, message in rules:
        if not holds():
            raise ValueError(message)


def exact_join(left: DataFrame, right: DataFrame, group: list[str], left_order: list[str | Column], right_order: list[str | Column]) -> DataFrame:
    """The i-th row of the left with the i-th of the right in each group (null is one); raises when run if a side has more rows."""
    number = lambda df, by: df.withColumn("_i", F.row_number().over(Window.partitionBy(*group).orderBy(*by)))
    a, b = number(left, left_order).withColumn("_l", F.lit(1)), number(right, right_order).withColumn("_r", F.lit(1))
    b = b.withColumnsRenamed({c: f"_b_{c}" for c in [*group, "_i"]})
    both = a.join(b, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in [*group, "_i"]], "full_outer")
    fault = F.raise_error(F.lit("sides of a positional join differ in length")).cast("boolean")
    return both.where(F.when(F.col("_l").isNull() | F.col("_r").isNull(), fault).otherwise(F.lit(True))).drop("_i", "_l", "_r", *[f"_b_{c}" for c in [*group, "_i"]])


def eligible_picks(needs: list[str], flags: dict[str, list[bool]], size: int, faults: dict[str, str]) -> list[int]:
    """For each slot in order the place of its source: the first one left for which the flag that it needs holds ('': any).

    ValueError with the fault of a need that nothing left can fill. The pool is what a plan selects and reserves, so its
    size is bounded by the configuration; each place is looked at once for each kind of need.
    """
    queues = {"": iter(range(size)), **{k: iter([i for i, f in enumerate(v) if f]) for k, v in flags.items()}}
    taken, out = set(), []
    for need in needs:
        kind = need if need in flags else ""
        place = next((i for i in queues[kind] if i not in taken), None)
        if place is None:
            raise ValueError(faults.get(kind, "a slot cannot be filled"))
        taken.add(place)
        out.append(place)
    return out
