"""Stable seeds, PCG64 orders and digests of configurations."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of a configuration that change how a plan is made, not the plan.
PERFORMANCE_KEYS = frozenset(
    {
        "checkpoint_interval",
        "hash_chunk_bytes",
        "jobs",
        "max_logged_error_examples",
        "memory_budget_ratio",
        "memory_probe_fallback_jobs",
        "memory_sample_interval_seconds",
        "parallel_chunk_multiplier",
        "plan_checkpoint_interval",
        "plan_log_interval",
        "worker_peak_rss_bytes",
    }
)


def stable_seed(base: int, *parts: object) -> int:
    """the first 8 bytes of the SHA-256 of the parts joined by bars, as an unsigned number (a fixed formula); None is an empty part."""
    told = "|".join("" if p is None else str(p) for p in (base, *parts))
    return int.from_bytes(hashlib.sha256(told.encode()).digest()[:8], "big")


def stable_seed_column(base: int | Column, *parts: Column) -> Column:
    """stable_seed on columns; a null part is empty. Unsigned 64-bit numbers need DECIMAL(20, 0)."""
    first = base.cast("string") if isinstance(base, Column) else F.lit(str(base))
    told = F.concat_ws("|", first, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha2(told, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def permutation(n: int, seed: int) -> np.ndarray:
    """The order in which PCG64 puts n places (a fixed algorithm); fewer than two stay as they are."""
    return np.random.Generator(np.random.PCG64(seed)).permutation(n) if n > 1 else np.arange(n)


def permutation_table(spark: SparkSession, n: int, seed: int, first: int | None = None) -> DataFrame:
    """(place, rank): the first ranks (all, if None) of the permutation of n places.

    The permutation itself is 8 bytes a place on the driver, as its order is that of one stream; what leaves the driver
    as a table are only the ranks asked for, as columns, not as Python rows.
    """
    import pyarrow as pa

    order = permutation(n, seed)[:first].astype(np.int64)
    return spark.createDataFrame(pa.table({"place": order, "rank": np.arange(len(order), dtype=np.int64)}))


def config_hash(config: dict, performance_only: frozenset[str] = PERFORMANCE_KEYS) -> str:
    """SHA-256 of the sorted compact JSON (a fixed form) of all keys but those that only change performance."""
    kept = {k: v for k, v in config.items() if k not in performance_only}
    return hashlib.sha256(json.dumps(kept, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
