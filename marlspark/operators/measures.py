"""Measures, anti-joins and rows of manifests, as columns and DataFrame operators.

Nulls: a measure of a null is null; an anti-join keeps rows with a null key, as they match nothing.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of(part: Column, whole: Column) -> Column:
    """The share of the places where whole holds at which part holds too; whole and part are arrays of booleans."""
    both = F.size(F.filter(F.arrays_zip(part.alias("p"), whole.alias("w")), lambda z: z["p"] & z["w"]))
    return both.cast("double") / F.greatest(F.size(F.filter(whole, lambda w: w)), F.lit(1))


def extent(xs: Column, ys: Column, width: Column, height: Column) -> Column:
    """A4: the share of a frame that the bounds of points cover; 0 without points."""
    spread = lambda v: F.array_max(v) - F.array_min(v)
    return F.coalesce((spread(xs) / width) * (spread(ys) / height), F.lit(0.0))


def pixel_stats(df: DataFrame, group: list[str], value: str, quantile: float = 0.99) -> DataFrame:
    """Mean, std, median, a quantile, range and whether the spread is enough, by group."""
    sd = F.stddev_pop(value)
    return df.groupBy(*group).agg(
        F.avg(value).alias("mean"), sd.alias("std"), F.median(value).alias("median"), F.percentile(value, F.lit(quantile)).alias("quantile"), (F.max(value) - F.min(value)).alias("range"), (sd >= 0.25).alias("passes")
    )


def circular_gap(df: DataFrame, group: list[str], angle: str) -> DataFrame:
    """The widest gap between angles in degrees on the circle, by group; one angle alone has a gap of 0, as it follows itself."""
    w = Window.partitionBy(*group).orderBy("_a")
    turned = df.where(F.col(angle).isNotNull()).select(*group, F.pmod(F.col(angle), F.lit(360.0)).alias("_a"))
    gap = F.pmod(F.coalesce(F.lead("_a").over(w), F.first("_a").over(w)) - F.col("_a") + 360, F.lit(360.0))
    return turned.withColumn("_gap", gap).groupBy(*group).agg(F.max("_gap").alias("max_gap"))


def first_missing(label: Column, fields: list[str]) -> Column:
    """The error of the first field that a label in JSON lacks, '' for none; a text that is no object is an error."""
    keys = F.json_object_keys(label)
    error = F.when(keys.isNull(), "ValueError: JSON top level must be an object")
    for name in fields:
        error = error.when(~F.array_contains(keys, name), f"ValueError: missing top-level field: {name}")
    return error.otherwise("")


def record_types(df: DataFrame, key: list[str], order: str, kind: str, of: list[str]) -> DataFrame:
    """The types of the records of a key in order, joined by bars, and whether one of them is in of."""
    kinds = F.transform(F.array_sort(F.collect_list(F.struct(order, kind))), lambda x: x[kind])
    return df.groupBy(*key).agg(kinds.alias("_k")).select(*key, F.array_join("_k", "|").alias("types"), F.arrays_overlap("_k", F.array(*map(F.lit, of))).alias("special"))


def largest(df: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """Of each group the row with the largest value, of equal ones the first by order; combined before the shuffle."""
    rest = [c for c in df.columns if c not in group]
    best = F.min_by(F.struct(*rest), F.struct(-F.col(value), F.col(order))).alias("_b")
    return df.groupBy(*group).agg(best).select(*group, *[F.col(f"_b.{c}").alias(c) for c in rest])


def pending(tasks: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Tasks that are not done."""
    return tasks.join(done.select(*key), key, "left_anti")


def unreferenced(files: DataFrame, manifest: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Files that none of the path columns of the manifest names."""
    named = manifest.select(F.explode(F.array(*columns)).alias(path)).where(F.col(path).isNotNull())
    return files.join(named, path, "left_anti")


def dropped(manifest: DataFrame, lineage: DataFrame, key: str, case: str, cases: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of other cases, and the lineage of all samples but theirs. A null case is none of cases."""
    gone = manifest.where(F.col(case).isin(*cases)).select(key)
    return manifest.where(~F.coalesce(F.col(case).isin(*cases), F.lit(False))), lineage.join(gone, key, "left_anti")


def output_paths(modality: Column, partition: Column, stem: Column, fails: Column) -> list[Column]:
    """Image, label and history of a sample; '' for the history of one that passes."""
    path = lambda folder, end: F.concat(modality, F.lit("/"), partition, F.lit(f"/{folder}/"), stem, F.lit(end))
    return [path("images", ".jpg").alias("image_path"), path("labels_json", ".json").alias("label_json_path"), F.when(fails, path("augmentation_json", ".augmentation.json")).otherwise("").alias("augmentation_json_path")]


def duration(seconds: Column) -> Column:
    """mm:ss, or hh:mm:ss from an hour on; null or negative durations are not known yet."""
    s = F.bround(seconds).cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    hours, minutes, rest = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    short = F.concat_ws(":", two(minutes), two(rest))
    return F.when(seconds.isNull() | (seconds < 0), "계산 중").when(hours > 0, F.concat_ws(":", F.when(hours < 10, two(hours)).otherwise(hours.cast("string")), short)).otherwise(short)


def eight_decimals(value: Column) -> Column:
    """a ratio as text with 8 decimals, rounded half to even on the binary value, which format_string does not do."""
    @F.pandas_udf("string")
    def told(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None or x != x else f"{x:.8f}")

    return told(value)
