"""Samples of a plan: made in Arrow batches, replaced from the reserve where they fail, written, and told in manifests.

The files of a sample are columns of one row, so a job either has a sample whole or not at all, and a lost executor
costs the samples of its task. Folders of files, as readers outside of Spark want them, are an export of that table.
"""

from __future__ import annotations

import json
import resource
import time
import zipfile
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.functions import names as N
from marlspark.functions.seeds import config_hash
from marlspark.kernels import codec
from marlspark.kernels.sample import make_sample
from marlspark.operators import relational as R
from marlspark.plans import scan as S
from marlspark.plans.verify import raise_first, recovered, verify_rows
from marlspark.sources import tree
from marlspark.sources.store import atomic_write, local, pretty_json, read_csv, settle, write_csv

# The columns of manifest, lineage and errors.
DATASET_FIELDS = [
    "synthetic_id", "modality", "new_battery_id", "new_image_id", "image_path", "label_json_path", "augmentation_json_path", "quality_label", "image_relative_path",
    "label_json_relative_path", "augmentation_json_relative_path", "quality_class", "assignment", "is_augmented", "partition", "failure_case", "augmentations", "width", "height",
    "image_sha256", "label_json_sha256", "augmentation_json_sha256", "replacement_for",
]
LINEAGE_FIELDS = [
    "synthetic_id", "raw_image_path", "raw_json_path", "resolved_raw_root", "source_image_relative_path", "source_json_relative_path", "original_battery_id", "original_image_id",
    "new_battery_id", "new_image_id", "axis", "ct_axis", "original_roi", "ct_roi", "item_seed", "case_seed", "group_key", "group_seed", "failure_case", "affine_matrix",
    "augmentation_parameters", "actual_parameters_json",
]
ERROR_FIELDS = ["synthetic_id", "modality", "raw_image_path", "attempt", "error"]
FILES = ["image", "label", "history"]
#: Columns of the plan that a sample carries on, and those that it is made with.
CARRIED = ["synthetic_id", "modality", "raw_split", "raw_image_path", "raw_json_path", "source_stem", "form", "axis", "original_battery_id", "original_image_id", "new_battery_id", "new_image_id", "assignment", "quality_label", "partition", "failure_case", "item_seed", "case_seed", "group_key", "group_seed", "replacement_for"]
_MADE = [c for c in dict.fromkeys([*DATASET_FIELDS, *LINEAGE_FIELDS]) if c not in CARRIED]
RESULT = ", ".join([*[f"{c} string" for c in CARRIED], *[f"{c} string" for c in [*_MADE, "replacement"]], *[f"{c} binary" for c in FILES], "error string", "rss long"])
_NAMES = [*CARRIED, *_MADE, "replacement", *FILES, "error", "rss"]


def _one(row: dict[str, Any], config: dict[str, Any], root: str) -> dict[str, Any]:
    """A sample, or its error as text; never raises."""
    try:
        if row["source_height"] is None or row["source_height"] < 1:
            raise OSError(f"cannot identify image file {row['raw_image_path']!r}")
        image = codec.normalised(row["data"], row["source_width"], row["source_height"], row["channels"], row["modality"])
        return {**make_sample(row, row["new_stem"], image, row["content"], config, root), "error": ""}
    except Exception as fault:
        return {"error": f"{type(fault).__name__}: {fault}"}


def _batch(rows: list[dict[str, Any]], made: list[dict[str, Any]]) -> pa.RecordBatch:
    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024  # A10
    told = [{**{c: r.get(c) for c in CARRIED}, **m, "replacement": r.get("replacement_for") or "", "rss": peak} for r, m in zip(rows, made, strict=True)]
    types = [pa.binary() if n in FILES else pa.int64() if n == "rss" else pa.string() for n in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array([t.get(n) for t in told], t_) for n, t_ in zip(_NAMES, types, strict=True)], names=_NAMES)


def with_sources(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """rows (P6: below the root) with the content of the label, the pixels of the image, the digests of both, and the stem of the output.

    Paths come from a selection whose size the configuration bounds; nothing else of the tree is read.
    """
    base = str(root).rstrip("/")
    plain = tree.plain_path(F.lit(base))
    outside = rows.where(F.exists(F.split("raw_image_path", "/"), lambda p: p == "..") | F.exists(F.split("raw_json_path", "/"), lambda p: p == "..")).select("raw_image_path").first()
    if outside:
        raise ValueError(f"path_traversal_or_symlink_escape: {outside[0]}")
    images = [f"{base}/{p}" for p in tree._below(rows, "raw_image_path")]
    labels = [f"{base}/{p}" for p in tree._below(rows, "raw_json_path")]
    keyed = rows.withColumns({"_image": F.concat(plain, F.lit("/"), "raw_image_path"), "_label": F.concat(plain, F.lit("/"), "raw_json_path")})
    told = tree.contents(spark, labels).select(F.col("path").alias("_label"), "content", F.col("sha256").alias("label_now"))
    sums = tree.contents(spark, images).select(F.col("path").alias("_image"), F.col("sha256").alias("image_now"))
    shown = tree.pixels(spark, images).select(F.col("path").alias("_image"), F.col("height").alias("source_height"), F.col("width").alias("source_width"), "channels", "data")
    stem = N.new_stem(N.parse_stem(F.col("source_stem")), F.col("new_battery_id"), F.col("new_image_id"))
    return keyed.join(told, "_label", "left").join(sums, "_image", "left").join(shown, "_image", "left").withColumn("new_stem", stem).drop("_image", "_label")


def made(spark: SparkSession, root: str, rows: DataFrame, config: dict[str, Any]) -> DataFrame:
    """A row for each row of the plan, with its files or its error."""
    where = str(local(root))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 16):  # files of so many samples at a time
                part = batch.slice(k, 16).to_pylist()
                yield _batch(part, [_one(r, config, where) for r in part])

    whole = with_sources(spark, root, rows)
    n = max(1, min(4096, rows.count() // 64))
    return whole.repartition(n, "synthetic_id").mapInArrow(run, RESULT)


def replaced(spark: SparkSession, root: str, failed: DataFrame, reserve: DataFrame, config: dict[str, Any]) -> DataFrame:
    """Failed rows in order, each with the first of the rest of the reserve that makes a sample; the error of the last try where none does.

    What a slot gets depends on those before it, so a modality is one task; failed rows and the reserve are both bounded
    by the configuration.
    """
    where = str(local(root))
    spare = reserve.withColumns({c: F.lit("0") for c in ("new_battery_id",)}).withColumn("new_image_id", F.lit("0"))
    shown = with_sources(spark, root, spare).withColumn("_parsed", N.parse_stem(F.col("source_stem"))).select(
        "modality", F.col("reserve_rank").cast("long").alias("reserve_rank"), "raw_split", "raw_image_path", "raw_json_path", "source_stem", "image_sha256", "json_sha256",
        F.col("_parsed.form").alias("form"), F.coalesce("_parsed.axis", F.lit("")).alias("axis"), F.col("_parsed.battery_id").alias("original_battery_id"), F.col("_parsed.image_id").alias("original_image_id"),
        "content", "source_height", "source_width", "channels", "data", "image_now", "label_now",
    )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        queue = iter(right.sort_values("reserve_rank").to_dict("records"))
        rows, results = [], []
        for slot in left.sort_values("synthetic_id").to_dict("records"):
            last = {"error": slot["error"]}
            for r in queue:
                if r["image_now"] != r["image_sha256"] or r["label_now"] != r["json_sha256"]:
                    last = {"error": f"ValueError: reserve source changed: {r['raw_image_path']}"}
                    continue
                if r["form"] is None:
                    last = {"error": f"ValueError: invalid reserve stem: {r['source_stem']}"}
                    continue
                taken = {k: r[k] for k in ("raw_split", "raw_image_path", "raw_json_path", "source_stem", "form", "axis", "original_battery_id", "original_image_id", "content", "source_height", "source_width", "channels", "data")}
                trial = {**slot, **taken, "replacement_for": slot["raw_image_path"]}
                middle = f"{r['form']}_{slot['new_battery_id']}_" + (f"{r['axis']}_" if slot["modality"] == "CT" else "")
                trial["new_stem"] = f"{slot['modality']}_cell_{middle}{slot['new_image_id']}"
                last = _one(trial, config, where)
                if not last["error"]:
                    rows.append(trial)
                    break
            if last["error"]:
                rows.append(slot)
            results.append(last)
        return _batch(rows, results).to_pandas() if rows else pd.DataFrame({n: pd.Series(dtype=object) for n in _NAMES})

    slots = failed.select(*CARRIED, "error")
    return slots.groupBy("modality").cogroup(shown.groupBy("modality")).applyInPandas(run, RESULT)


def checked_plan(spark: SparkSession, root: str, config: dict[str, Any], rows: DataFrame, trust: bool = False) -> None:
    """V5: one configuration, ours; no id twice; sources as they were; and, unless the plan is trusted, the whole tree as it was."""
    first = rows.first()
    if first is None:
        raise ValueError("Plan is empty")
    if rows.select("config_sha256").distinct().count() > 1:
        raise ValueError("Plan contains mixed config hashes")
    if config_hash(config) != first["config_sha256"]:
        raise ValueError("Config SHA-256 differs from approved plan")
    for key in ([F.col("synthetic_id")], [F.col("modality"), F.col("new_image_id")]):
        if not R.duplicates(rows, key, "synthetic_id").isEmpty():
            raise ValueError("Plan contains duplicate synthetic/image IDs")
    base, plain = str(root).rstrip("/"), tree.plain_path(F.lit(str(root).rstrip("/")))
    for path, sha in (("raw_image_path", "image_sha256"), ("raw_json_path", "json_sha256")):
        there = tree.listing(spark, root).select(F.col("relative").alias(path))
        gone = rows.join(there, path, "left_anti").orderBy("modality", "synthetic_id").first()
        if gone:
            raise ValueError(f"Plan source missing: {gone['raw_image_path']}")
        now = tree.contents(spark, [f"{base}/{p}" for p in tree._below(rows, path)]).select("path", F.col("sha256").alias("_now"))
        changed = rows.withColumn("path", F.concat(plain, F.lit("/"), path)).join(now, "path").where(F.col("_now") != F.col(sha)).orderBy("modality", "synthetic_id").first()
        if changed:
            raise ValueError(f"Plan source changed: {changed['raw_image_path']}")
    if trust:
        return
    found = S.scan(spark, root, config)
    if found.ambiguous:
        raise ValueError("Raw dataset now contains blocking_systemic errors")
    if S.raw_fingerprint(found.candidates) != first["raw_fingerprint"]:
        raise ValueError("Raw fingerprint differs from approved plan")


def limited(rows: DataFrame, config: dict[str, Any], limit: int | None) -> DataFrame:
    """So many rows of each modality, fails and passes in the shares of the plan, the first of each."""
    if limit is None:
        return rows
    fails = {m: round(limit * int(config[f"{m.lower()}_augmented_target"]) / int(config[f"{m.lower()}_target"])) for m in ("CT", "RGB")}
    parts = [R.first_n(rows.where((F.col("modality") == m) & (F.col("quality_label") == q)), ["modality"], ["synthetic_id"], n if q == "fail" else limit - n).drop("rank") for m, n in fails.items() for q in ("fail", "pass")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def expected_counts(config: dict[str, Any]) -> list[tuple[str, str | None, str | None, str | None, int]]:
    """(modality, quality, partition, case, count) that a whole data set has, for each of the three contracts."""
    out = []
    for m in ("CT", "RGB"):
        own = lambda name, usual=None, m=m.lower(): int(config[f"{m}_{name}"] if usual is None else config.get(f"{m}_{name}", usual))
        target, fail, test, test_fail = own("target"), own("augmented_target"), own("test_target", 0), own("test_fail_target", 0)
        out += [(m, "pass", None, None, target - fail), (m, "fail", None, None, fail)]
        out += [(m, "fail", "test", None, test_fail), (m, "pass", "test", None, test - test_fail), (m, "fail", "main", None, fail - test_fail), (m, "pass", "main", None, target - fail - (test - test_fail))]
        out += [(m, "fail", None, case, int(n)) for case, n in config[f"{m.lower()}_failure_case_quotas"].items()]
    return out


def checked_counts(spark: SparkSession, manifest: DataFrame, config: dict[str, Any]) -> None:
    """ValueError where counts by quality, part or case are not those of the configuration."""
    key = ["modality", "quality_label", "partition", "failure_case"]
    told = manifest.withColumn("failure_case", F.when(F.col("quality_label") == "fail", F.col("failure_case")))
    sets = [key[:2], key[:3], [key[0], key[1], key[3]]]
    counts = R.contract_counts(told, sets)
    # of the grouping by case only fails count; level tells the grouping, a bit for each column that is not in it
    actual = counts.where("level <> 2 OR failure_case IS NOT NULL").select(*key, "n")
    wanted = spark.createDataFrame([r for r in expected_counts(config) if r[-1]], "modality string, quality_label string, partition string, failure_case string, n bigint")
    faults = sorted(map(str, _differences(actual, wanted, key)))
    if faults:
        raise ValueError(f"Final counts differ: {'; '.join(faults[:10])}")


def _differences(actual: DataFrame, wanted: DataFrame, key: list[str]) -> list[tuple]:
    text = lambda df: df.select(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("*")) for c in key]).alias("key"), "n")
    return [tuple(r) for r in R.contract_diff(text(actual), text(wanted), ["key"]).collect()]


def dropped_cases(manifest: DataFrame, lineage: DataFrame, cases: set[str]) -> tuple[DataFrame, DataFrame]:
    """Manifest and lineage without the samples of the cases."""
    gone = manifest.where(F.col("failure_case").isin(*cases)).select("synthetic_id")
    return manifest.join(gone, "synthetic_id", "left_anti"), lineage.join(gone, "synthetic_id", "left_anti")


def _export(output: str):
    """Files of the samples of a batch; those of a sample are written, checked and moved together, and taken back together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        out = local(output)
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                files = [(row[p], row[f], row[s]) for f, p, s in (("image", "image_path", "image_sha256"), ("label", "label_json_path", "label_json_sha256"), ("history", "augmentation_json_path", "augmentation_json_sha256")) if row[p]]
                moved = []
                try:
                    for path, data, sha in files:
                        place = out / path
                        if place.exists() and hashlib.sha256(place.read_bytes()).hexdigest() != sha:
                            raise ValueError(f"final output path already exists: {place}")
                        atomic_write(place, data)
                        moved.append(place)
                        if hashlib.sha256(place.read_bytes()).hexdigest() != sha:
                            raise ValueError(f"final hash mismatch: {place}")
                except Exception:
                    for place in moved:
                        place.unlink(missing_ok=True)
                    raise
                done.append(row["synthetic_id"])
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["synthetic_id"])

    return run


def export(samples: DataFrame, output: str) -> int:
    """The files of samples below output, a folder that all executors share; the number of samples. A task that runs again writes the same."""
    columns = ["synthetic_id", *FILES, "image_path", "label_json_path", "augmentation_json_path", "image_sha256", "label_json_sha256", "augmentation_json_sha256"]
    return samples.select(*columns).mapInArrow(_export(output), "synthetic_id string").count()


def checkpoint(output: Path, manifest: DataFrame, lineage: DataFrame, errors: DataFrame) -> None:
    """S17, O5."""
    folder = output / "manifests"
    write_csv(folder / "dataset_manifest.csv", manifest.orderBy("synthetic_id").toLocalIterator(), DATASET_FIELDS)
    write_csv(folder / "lineage_private.csv", lineage.orderBy("synthetic_id").toLocalIterator(), LINEAGE_FIELDS)
    write_csv(folder / "generation_errors.csv", errors.orderBy("synthetic_id").toLocalIterator(), ERROR_FIELDS)


def published(plan: Path, output: Path) -> None:
    """The plan's files and its log beside the data set."""
    for file in sorted(plan.parent.glob("*")):
        if file.is_file():
            atomic_write(output / "manifests" / file.name, file.read_bytes())
    log = plan.parent.parent / "logs" / "plan.log"
    if log.is_file():
        atomic_write(output / "logs" / "plan.log", log.read_bytes())


def archive(output: Path) -> Path:
    """The histories of all FAIL samples, by path."""
    place = output / "augmentation_json_4k_v1.7.zip"
    with zipfile.ZipFile(place, "w", compression=zipfile.ZIP_DEFLATED) as z:
        for path in sorted(output.glob("*/*/augmentation_json/*.augmentation.json")):
            z.write(path, path.relative_to(output).as_posix())
    return place


def generate(spark: SparkSession, root: str, config: dict[str, Any], plan: str | Path, output: str | Path, limit: int | None = None, resume: bool = False, trust: bool = False, drop: set[str] | None = None) -> dict[str, Any]:
    """The data set of a plan, or the rest of it; its summary."""
    out, plan = local(output), local(plan)
    if out.exists() and any(out.iterdir()) and not resume:
        raise ValueError(f"Output directory is not empty: {out}")
    if drop and not resume:
        raise ValueError("--drop-cases requires --resume")
    rows = settle(read_csv(spark, plan), "plan")
    checked_plan(spark, root, config, rows, trust)
    published(plan, out)
    spare = plan.parent / "reserve_sources.csv"
    reserve = read_csv(spark, spare) if spare.exists() else None
    chosen = limited(rows, config, limit)
    manifest = lineage = None
    if resume and (out / "manifests" / "dataset_manifest.csv").exists():
        manifest = settle(read_csv(spark, out / "manifests" / "dataset_manifest.csv"), "manifest")
        lineage = settle(read_csv(spark, out / "manifests" / "lineage_private.csv"), "lineage")
        if drop:
            manifest, lineage = (settle(x, "kept") for x in dropped_cases(manifest, lineage, drop))
            checkpoint(out, manifest, lineage, spark.createDataFrame([], ", ".join(f"{c} string" for c in ERROR_FIELDS)))
        raise_first(verify_rows(spark, str(out), manifest))
    if resume:
        recovered(spark, str(out), manifest)
    began = time.monotonic()
    tasks = chosen if manifest is None else chosen.join(manifest.select("synthetic_id"), "synthetic_id", "left_anti")
    tasks = tasks.withColumn("replacement_for", F.lit("")).select(*CARRIED)
    first = settle(made(spark, root, tasks, config), "samples")
    failed = first.where("error <> ''")
    samples = first.where("error = ''")
    if reserve is not None and not failed.isEmpty():
        used = rows.select(F.lower("raw_split").alias("raw_split"), F.lower("source_stem").alias("_stem"))
        free = reserve.withColumns({"_split": F.lower("raw_split"), "_stem": F.lower("source_stem")}).join(used.select(F.col("raw_split").alias("_split"), "_stem"), ["_split", "_stem"], "left_anti").drop("_split", "_stem")
        again = settle(replaced(spark, root, failed, free, config), "replaced")
        samples, failed = samples.unionByName(again.where("error = ''")), again.where("error <> ''")
    n = export(samples, str(out))
    new = samples.withColumn("replacement_for", F.col("replacement"))
    manifest = new.select(*DATASET_FIELDS) if manifest is None else manifest.select(*DATASET_FIELDS).unionByName(new.select(*DATASET_FIELDS))
    lineage = new.select(*LINEAGE_FIELDS) if lineage is None else lineage.select(*LINEAGE_FIELDS).unionByName(new.select(*LINEAGE_FIELDS))
    manifest, lineage = settle(manifest, "manifest"), settle(lineage, "lineage")
    errors = failed.select("synthetic_id", "modality", "raw_image_path", F.lit(str(config.get("max_augmentation_retries", 8))).alias("attempt"), "error")
    checkpoint(out, manifest, lineage, errors)
    took = max(time.monotonic() - began, 1e-9)
    left = failed.count()
    if left:
        raise ValueError(f"{left} samples failed; inspect generation_errors.csv")
    raise_first(verify_rows(spark, str(out), manifest))
    if limit is None:
        checked_counts(spark, manifest, config)
    plan_row = rows.first()
    by = lambda *c: {"_".join(map(str, r[:-1])): r[-1] for r in manifest.groupBy(*c).count().collect()}
    summary = {
        "schema_version": "1.1", "package_version": "1.7", "raw_fingerprint": plan_row["raw_fingerprint"], "config_sha256": plan_row["config_sha256"],
        "counts": by("modality", "quality_label"),
        "failure_case_counts": {k: v for k, v in by("modality", "failure_case").items() if not k.endswith("_")},
        "generation_elapsed_seconds": took, "average_sample_seconds": took / max(n, 1), "generation_samples_per_second": n / took,  # A9
        "worker_peak_rss_bytes_observed": samples.agg(F.max("rss")).first()[0] or 0,
        "serialization": {"json": "UTF-8, sorted keys, compact separators, LF", "jpeg": f"baseline q{int(config['jpeg_quality'])}, no subsampling"},
    }
    atomic_write(out / "generation_summary.json", pretty_json(summary))
    archive(out)
    return summary


def told(summary: dict[str, Any]) -> str:
    return json.dumps(summary, ensure_ascii=False, indent=2)
