"""Folders, single files and manifests: what lies outside of tables.

Single files go through the file system of their path: the local one, or that of Hadoop. They are written beside their
place and renamed, so a reader sees the old file or the new one.
"""

from __future__ import annotations

import atexit
import csv
import io
import json
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the folder in spark.checkpoint.dir and read it back; a folder of this process only in local mode without one."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    if not root:
        if "dir" not in _OWN:
            _OWN["dir"] = tempfile.mkdtemp(prefix="marlspark-plan-")
            atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
        root = "file://" + _OWN["dir"]
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, order: list[str], to: str = "place") -> tuple[DataFrame, int]:
    """df with the place of each row in the order, from 0 without gaps, and the number of rows.

    Rows are sorted in ranges; only the number of rows of each range reaches the driver. Nulls come first.
    """
    keys = [F.asc_nulls_first(c) for c in order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    dealt = settle(dealt, "placed")
    part = F.shiftright("_at", 33)
    sizes = sorted(tuple(r) for r in dealt.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    table = df.sparkSession.createDataFrame(starts, "_p bigint, _start bigint")
    joined = dealt.withColumn("_p", part).join(F.broadcast(table), "_p")  # a row for each range
    return joined.withColumn(to, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).select(*df.columns, to), total


def is_local(path: str | Path) -> bool:
    return "://" not in str(path) and not str(path).startswith("file:")


def local(path: str | Path) -> Path:
    text = str(path)
    return Path("/" + text[5:].lstrip("/")) if text.startswith("file:") else Path(text)


def atomic_write(path: str | Path, data: bytes, attempts: int = 8) -> None:
    """The file as a whole or not at all; a place that another process holds is tried again, after longer and longer waits."""
    path = local(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.{uuid.uuid4().hex}.tmp")
    with open(temporary, "wb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    for k in range(attempts):
        try:
            os.replace(temporary, path)
            return
        except PermissionError as fault:
            last = fault
            time.sleep(0.1 * 2**k)
    temporary.unlink(missing_ok=True)
    raise RuntimeError(f"atomic replace failed after {attempts} attempts: {path}") from last


def removed(path: str | Path, attempts: int = 5) -> None:
    """A file or folder deleted; what another process holds is tried again."""
    path = local(path)
    for k in range(attempts):
        try:
            if path.is_dir():
                shutil.rmtree(path)
            elif path.exists():
                path.unlink()
            return
        except OSError as fault:
            last = fault
            time.sleep(0.1 * 2**k)
    raise RuntimeError(f"Could not clean output path after {attempts} attempts: {path}") from last


def canonical_json(value: Any) -> bytes:
    """Sorted keys, compact, no escapes but the needed ones, a line feed at the end."""
    return (json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n").encode()


def pretty_json(value: Any) -> bytes:
    """S12."""
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True).encode()


def read_json(data: bytes) -> dict[str, Any]:
    """An object in UTF-8, with or without a byte-order mark."""
    value = json.loads(data.decode("utf-8-sig"))
    if not isinstance(value, dict):
        raise ValueError("JSON top level must be an object")
    return value


def write_csv(path: str | Path, rows: Iterable[dict[str, Any]], fields: list[str]) -> None:
    """UTF-8 with a byte-order mark; keys beyond the fields are left out. Rows can be DataFrame.toLocalIterator()."""
    text = io.StringIO(newline="")
    writer = csv.DictWriter(text, fieldnames=fields, extrasaction="ignore")
    writer.writeheader()
    for row in rows:
        kept = row.asDict() if hasattr(row, "asDict") else row
        writer.writerow({k: "" if v is None else v for k, v in kept.items()})
    atomic_write(path, text.getvalue().encode("utf-8-sig"))


def read_csv(spark: SparkSession, path: str | Path, fields: list[str] | None = None) -> DataFrame:
    """Every column as text, empty cells as empty text. With fields the header must be these, in this order."""
    df = spark.read.csv(str(path), header=True, multiLine=True, escape='"', encoding="UTF-8", inferSchema=False)
    names = [c.lstrip("﻿") for c in df.columns]
    df = df.toDF(*names)
    if fields is not None and names != fields:
        raise ValueError(f"scan cache schema mismatch: {path}\n  expected: {fields}\n  found: {names}")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names])
