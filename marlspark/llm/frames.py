"""What the operators of this subpackage share: scratch tables, graph components, bounded batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_LOCAL = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests on one machine) a folder of this process is used; a cluster without
    the setting gets a folder in the warehouse, which executors share too.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    if "dir" not in _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="marlspark-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return "file://" + _OWN["dir"]


def scratch_run(spark: SparkSession) -> str:
    """The folder of this application below scratch_root; clear_scratch deletes it as a whole."""
    return f"{scratch_root(spark)}/marlspark-{spark.sparkContext.applicationId}"


def _made() -> list[str]:
    """Paths written by this thread that were not deleted yet."""
    if not hasattr(_LOCAL, "made"):
        _LOCAL.made = []
    return _LOCAL.made


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(*frames: DataFrame | None) -> None:
    """Delete the files of frames that written() gave; other frames are left alone. Nothing may read them any more."""
    for df in frames:
        path = None if df is None else getattr(df, "_scratch_path", None)
        if path in _made():
            _made().remove(path)
            _delete(df.sparkSession, [path])


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application wrote on the way; call it once the results are written."""
    _made().clear()
    _delete(spark, [scratch_run(spark)])


def written(df: DataFrame, name: str, drop: tuple[DataFrame | None, ...] = ()) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors.

    drop: frames of written() that only df reads; their files are deleted once df stands.
    """
    spark = df.sparkSession
    path = f"{scratch_run(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    forget(*drop)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    _made().append(path)
    return out


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What make() gives, written; every other table that was written on the way is deleted."""
    before = set(_made())
    out = written(make(), name)
    gone = [p for p in _made() if p not in before and p != out._scratch_path]
    _delete(out.sparkSession, gone)
    _LOCAL.made = [p for p in _made() if p not in gone]
    return out


def fresh(taken: list[str], *names: str) -> list[str]:
    """names, with underscores added where a column of taken (whatever its case) has the name."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, order: list[str], to: str, name: str) -> tuple[DataFrame, int]:
    """df with the place of each row in the order (from 0, without gaps) as column to, and the number of rows.

    Rows are sorted in ranges; only the number of rows of each range reaches the driver.
    """
    keys = [F.asc_nulls_first(c) for c in order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed, name)
    part = F.shiftright("_at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    table = df.sparkSession.createDataFrame(starts, "_p bigint, _start bigint")
    # a row for each range
    joined = placed.withColumn("_p", part).join(F.broadcast(table), "_p")
    return joined.withColumn(to, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).select(*df.columns, to), total


def row_key(*cols: str | Column) -> list[Column]:
    """128 bits that stand for the values of cols; nulls count as values."""
    told = [F.struct(*cols)]
    return [F.xxhash64(F.lit(0), *told, *[F.isnull(c) for c in cols]), F.xxhash64(F.lit(1), *told, *[F.isnull(c) for c in cols])]


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about limit bytes at most; one longer text is a slice of its own."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        total = np.cumsum(size.to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            floor = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, floor + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def map_arrow(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(make, schema)


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, root) for every node of the undirected edges; root is the smallest node that it reaches.

    Each round joins every node with its smallest neighbour and contracts; at least half of the nodes that
    still have edges go, so the rounds are logarithmic. Nothing is gathered in one place.
    """
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    edge = written(both.union(both.select("v", "u")).distinct(), "cc-edges")
    if edge.isEmpty():
        return edge.select(F.col("u").alias("node"), F.col("v").alias("root"))
    steps = []
    while not edge.isEmpty():
        steps.append(written(edge.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "cc-parents"))
        left = edge.join(steps[-1].withColumnRenamed("p", "pu"), "u")
        right = steps[-1].select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edge = written(left.join(right, "v").where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "cc-edges", drop=(edge,))
    labels = steps[0].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for step in steps[1:]:
        labels = labels.join(step.select(F.col("u").alias("root"), "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
    return written(labels, "cc-labels", drop=(edge, *steps))
