"""Checks of a finished data set: every row by its files, keys across rows, and files that no row names."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.kernels import codec
from marlspark.kernels.shapes import coordinates
from marlspark.operators import relational as R
from marlspark.sources import tree
from marlspark.sources.store import local, read_csv, read_json, removed, settle, write_csv

RECOVERY_FIELDS = ["path", "action", "reason"]
FOLDERS = ("images", "labels_json", "augmentation_json")


def row_fault(row: dict[str, Any]) -> tuple[str, str]:
    """V8: (the first thing that is wrong with a row, the digest of its pixels); '' where nothing is."""
    name = row["synthetic_id"]
    history, stem = row["augmentation_json_path"] or "", PurePosixPath(row["image_path"]).name
    if row["image_now"] is None or row["label"] is None:
        return f"Missing image/label output: {name}", ""
    if row["quality_label"] == "pass":
        if history or row["augmentation_json_sha256"]:
            return f"PASS sample references augmentation JSON: {name}", ""
        if row["stray"]:
            return f"PASS sample has augmentation JSON: {name}", ""
    elif not history or row["history"] is None:
        return f"FAIL sample missing augmentation JSON: {name}", ""
    if row["h"] is None or row["h"] < 1:
        return f"cannot identify image file: {name}", ""
    label = read_json(row["label"])
    image = codec.normalised(row["data"], row["w"], row["h"], row["channels"], row["modality"])
    info = label["image_info"]
    checks = [
        (label.get("quality_class") == row["quality_label"], "quality_class mismatch"),
        (PurePosixPath(info["file_name"]).name == stem, "label file_name mismatch"),
        ((info["width"], info["height"]) == (row["w"], row["h"]), "label size mismatch"),
    ]
    points = [label.get("swelling", {}).get("battery_outline"), *[d.get("points") for d in label.get("defects") or []]]
    checks.append((all(0 <= x <= row["w"] and 0 <= y <= row["h"] for p in points if p not in (None, []) for x, y in coordinates(p)), "polygon outside output frame"))
    if history:
        told = read_json(row["history"])
        checks += [
            (told.get("schema_version") == "1.1", "augmentation schema mismatch"),
            (told.get("failure_case_count") == 1, "FAIL case count mismatch"),
            (told.get("output_image_file") == stem, "history image link mismatch"),
            (told.get("label_json_file") == PurePosixPath(row["label_json_path"]).name, "history label link mismatch"),
            (told.get("quality_label") == "fail", "history quality mismatch"),
        ]
    checks += [(row["image_now"] == row["image_sha256"], "image hash mismatch"), (row["label_now"] == row["label_json_sha256"], "label hash mismatch")]
    if history:
        checks.append((row["history_now"] == row["augmentation_json_sha256"], "history hash mismatch"))
    return next((f"{text}: {name}" for good, text in checks if not good), ""), codec.pixel_digest(image)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            try:
                out.append(row_fault(row))
            except Exception as fault:
                out.append((f"{type(fault).__name__}: {fault}: {row['synthetic_id']} mismatch", ""))
        keys = [batch.column(batch.schema.get_field_index(c)) for c in ("synthetic_id", "modality", "image_path", "image_sha256")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array([o[1] for o in out]), pa.array([o[0] for o in out])], names=["synthetic_id", "modality", "image_path", "image_sha256", "pixel_hash", "fault"])


def verify_rows(spark: SparkSession, output: str, manifest: DataFrame | None = None) -> DataFrame:
    """(place, synthetic_id, fault) of everything that is wrong, by place of the row in the manifest.

    A row's own faults come before those of keys that it shares with an earlier row: id, stem, file and pixels.
    """
    out = str(local(output))
    if manifest is None:
        manifest = read_csv(spark, f"{out}/manifests/dataset_manifest.csv")
    rows = manifest.withColumns({"_image": F.concat(F.lit(out + "/"), "image_path"), "_label": F.concat(F.lit(out + "/"), "label_json_path"), "_history": F.concat(F.lit(out + "/"), F.when(F.col("augmentation_json_path") != "", F.col("augmentation_json_path")))})
    files = tree.contents(spark, out)
    told = rows.join(files.select(F.col("path").alias("_image"), F.col("sha256").alias("image_now")), "_image", "left")
    told = told.join(files.select(F.col("path").alias("_label"), F.col("content").alias("label"), F.col("sha256").alias("label_now")), "_label", "left")
    told = told.join(files.select(F.col("path").alias("_history"), F.col("content").alias("history"), F.col("sha256").alias("history_now")), "_history", "left")
    stray = F.regexp_replace(F.regexp_replace("_image", "/images/([^/]*)$", "/augmentation_json/$1"), r"\.[^./]*$", ".augmentation.json")
    there = tree.listing(spark, out).select(F.col("path").alias("_stray"), F.lit(True).alias("stray"))
    told = told.withColumn("_stray", stray).join(there, "_stray", "left")
    shown = tree.pixels(spark, out).select(F.col("path").alias("_image"), F.col("height").alias("h"), F.col("width").alias("w"), "channels", "data")
    told = told.join(shown, "_image", "left").drop("_image", "_label", "_history", "_stray")
    checked = told.mapInArrow(_checked, "synthetic_id string, modality string, image_path string, image_sha256 string, pixel_hash string, fault string")
    checked = settle(checked, "verified")
    faults = checked.where("fault <> ''").select(F.lit(0).alias("kind"), "synthetic_id", "fault")
    stem = F.regexp_extract("image_path", r"([^/]*)\.[^./]*$", 1)
    shared = [
        ([F.col("synthetic_id")], "Duplicate synthetic ID: "),
        ([F.col("modality"), stem], "Duplicate output stem: "),
        ([F.col("image_sha256")], "duplicate output image SHA-256: "),
        ([F.col("pixel_hash")], "duplicate output pixel hash: "),
    ]
    for k, (key, text) in enumerate(shared, 1):
        again = R.duplicates(checked.where("pixel_hash <> ''"), key, "synthetic_id")
        name = F.col("key1") if k == 2 else F.col("second")
        faults = faults.unionByName(again.select(F.lit(k).alias("kind"), F.col("second").alias("synthetic_id"), F.concat(F.lit(text), name).alias("fault")))
    return faults


def raise_first(faults: DataFrame) -> None:
    """ValueError with the first fault, by id and kind."""
    first = faults.orderBy("synthetic_id", "kind").first()
    if first:
        raise ValueError(first["fault"])


def uncommitted(files: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files (relative) of the output folders that no path of the manifest names."""
    inside = files.where(F.col("relative").rlike(f"^[^/]+/(main|test)/({'|'.join(FOLDERS)})/[^/]+$"))
    if manifest is None:
        return inside
    paths = manifest.select(F.explode(F.array("image_path", "label_json_path", "augmentation_json_path")).alias("relative")).where("relative <> ''").distinct()
    return inside.join(paths, "relative", "left_anti")


def recovered(spark: SparkSession, output: str, manifest: DataFrame | None) -> int:
    """What a broken run left is deleted and listed; the number of files."""
    out = local(output)
    gone = uncommitted(tree.listing(spark, str(out)), manifest).select("relative").orderBy("relative")
    told = []
    for row in gone.toLocalIterator():
        removed(out / row["relative"])
        told.append({"path": row["relative"], "action": "deleted", "reason": "manifest-less partial output"})
    staging = out / ".sample_staging"
    for child in sorted(staging.iterdir()) if staging.exists() else []:
        told.append({"path": child.relative_to(out).as_posix(), "action": "deleted", "reason": "stale staging"})
        removed(child)
    write_csv(out / "manifests" / "recovery_audit.csv", told, RECOVERY_FIELDS)
    return len(told)
