"""The plan: which sources fill which slots of the data set, with which ids, seeds, cases and parts.

What the configuration bounds (slots, cases, a selection of target and reserve) is dealt on the driver, as the orders are
those of PCG64 streams; everything of the size of the raw data stays in tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.functions.seeds import config_hash, permutation, stable_seed, stable_seed_column
from marlspark.kernels import codec
from marlspark.kernels import raster as K
from marlspark.operators import relational as R
from marlspark.operators.assign import eligible_picks, quota_cases
from marlspark.plans import scan as S
from marlspark.plans.config import checked_config
from marlspark.sources import tree
from marlspark.sources.store import atomic_write, canonical_json, local, placed, pretty_json, settle, write_csv

# The columns of the plan and of the reserve, needs of cases, and what is said where a need cannot be met.
PLAN_FIELDS = [
    "synthetic_id", "modality", "raw_split", "raw_image_path", "raw_json_path", "source_image_relative_path", "source_json_relative_path", "source_stem", "form", "axis",
    "original_battery_id", "original_image_id", "new_battery_id", "new_image_id", "assignment", "quality_label", "quality_class", "partition", "failure_case", "selected",
    "extraction_rank", "item_seed", "case_seed", "group_key", "group_seed", "image_sha256", "json_sha256", "pixel_hash", "porosity_bbox_max_ratio", "roi", "raw_fingerprint",
    "config_sha256", "ct_bbox_policy_version",
]
RESERVE_FIELDS = [
    "modality", "reserve_rank", "raw_split", "raw_image_path", "raw_json_path", "source_stem", "image_sha256", "json_sha256", "synthetic_id", "new_image_id", "failure_case", "partition",
]
NEEDS = {"ct_cell_alignment_failure": "porosity", "ct_beam_hardening_metal_streak": "dense", "rgb_reflection_glare": "outline"}
UNFILLED = {
    "porosity": "CT alignment quota cannot be filled from porosity sources",
    "dense": "CT metal-streak quota cannot be filled from dense-anchor sources",
    "outline": "RGB glare quota cannot be filled from outline sources",
}


@dataclass
class Slots:
    """Of one modality, by slot from 0: whether it fails, its case ('' for none), its part."""

    fail: list[bool]
    case: list[str]
    partition: list[str]


def slots_of(config: dict[str, Any], modality: str) -> Slots:
    """Slots dealt by the seeds of the modality."""
    own = lambda name, usual=None: int(config.get(f"{modality.lower()}_{name}", usual) if usual is not None else config[f"{modality.lower()}_{name}"])
    seed = lambda name: stable_seed(config["seed"], modality, name)
    target, n = own("target"), own("augmented_target")
    fail = np.sort(permutation(target, seed("assignment"))[:n])
    cases = quota_cases([(k, int(v)) for k, v in config[f"{modality.lower()}_failure_case_quotas"].items()])
    order = permutation(len(cases), seed("failure-cases"))
    if len(order) != len(fail):
        raise ValueError(f"{modality} failure case quotas do not sum to {n}")
    case = [""] * target
    for slot, k in zip(fail.tolist(), order.tolist(), strict=True):
        case[slot] = cases[k]
    passing = np.setdiff1d(np.arange(target), fail)
    test_fail = own("test_fail_target", 0)
    test = [*fail[permutation(len(fail), seed("test-fail"))][:test_fail].tolist(), *passing[permutation(len(passing), seed("test-pass"))][: own("test_target", 0) - test_fail].tolist()]
    chosen = set(test)
    return Slots([bool(c) for c in case], case, ["test" if i in chosen else "main" for i in range(target)])


def dense_anchor(image: np.ndarray, roi: tuple[float, ...] | None) -> bool:
    """Whether the largest part of the brightest hundredth of the region covers a thousandth of it."""
    if roi:
        image = K.crop(image, [round(v) for v in roi])
    light = K.grey(image).astype(np.float32)
    return float(K.largest_component(light >= float(np.quantile(light, 0.99))).mean()) >= 0.001


def _dense(batches):
    import json

    for batch in batches:
        out = []
        for path, roi, h, w, c, data in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            out.append(h is not None and h > 0 and dense_anchor(codec.normalised(data, w, h, c, "CT"), tuple(json.loads(roi)) if roi else None))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.bool_())], names=["raw_image_path", "dense"])


def dense_anchors(spark: SparkSession, root: str, pool: DataFrame) -> DataFrame:
    """raw_image_path and dense of a selection; only its images are read."""
    base = str(root).rstrip("/")
    paths = [f"{base}/{p}" for p in tree._below(pool, "raw_image_path")]
    shown = tree.pixels(spark, paths)
    keyed = pool.select("raw_image_path", "roi", F.concat(tree.plain_path(F.lit(base)), F.lit("/"), "raw_image_path").alias("path"))
    return keyed.join(shown, "path", "left").select("raw_image_path", "roi", "height", "width", "channels", "data").mapInArrow(_dense, "raw_image_path string, dense boolean")


@dataclass
class Plan:
    rows: DataFrame
    reserve: DataFrame
    audit: DataFrame
    metadata: dict[str, Any]
    scan: S.Scan


def selected(spark: SparkSession, root: str, config: dict[str, Any], candidates: DataFrame, modality: str) -> tuple[DataFrame, DataFrame]:
    """(candidates with slot from 1 and what slots_of says, reserve with its rank W7) of a modality."""
    m = modality.lower()
    target, reserve = int(config[f"{m}_target"]), int(config.get("reserve_per_modality", 0))
    pool, n = placed(candidates.where(F.col("modality") == modality), ["raw_split", "raw_image_path"])
    if n < target + reserve:
        raise ValueError(f"{modality}: needs {target + reserve} valid unique sources including reserve, found {n}")
    order = permutation(n, stable_seed(config["seed"], modality, "extract"))[: target + reserve].astype(np.int64)
    drawn = spark.createDataFrame(pa.table({"place": order, "rank": np.arange(len(order), dtype=np.int64)}))
    pool = settle(pool.join(drawn, "place"), "pool")
    slots = slots_of(config, modality)
    needed = {NEEDS[c] for c in slots.case if c in NEEDS}
    flags = pool.select("rank", "raw_image_path", "roi", (F.col("porosity_component_count").try_cast("int") > 0).alias("porosity"), (F.lower("has_battery_outline") == "true").alias("outline"))
    if "dense" in needed:
        flags = flags.join(dense_anchors(spark, root, flags), "raw_image_path")
    told = flags.select("rank", *sorted(needed)).orderBy("rank").collect()  # target + reserve rows
    picks = eligible_picks([NEEDS.get(c, "") for c in slots.case], {k: [bool(r[k]) for r in told] for k in needed}, len(order), UNFILLED)
    left = sorted(set(range(len(order))) - set(picks))
    table = pa.table({"rank": pa.array(picks, pa.int64()), "slot": pa.array(range(1, target + 1), pa.int64()), "fail": slots.fail, "failure_case": slots.case, "partition": slots.partition})
    spare = pa.table({"rank": pa.array(left, pa.int64()), "reserve_rank": pa.array(range(1, len(left) + 1), pa.int64())})
    return pool.join(spark.createDataFrame(table), "rank"), pool.join(spark.createDataFrame(spare), "rank")


def plan_rows(config: dict[str, Any], chosen: DataFrame, modality: str, fingerprint: str) -> DataFrame:
    """The rows of the plan of one modality."""
    m, ct = modality.lower(), modality == "CT"
    try:
        ids = R.dense_ids(chosen, ["form", "battery_id"], "slot", int(config[f"{m}_battery_id_start"]), "new_battery_id", int(config[f"{m}_battery_id_end"]))
    except ValueError as fault:
        raise ValueError(f"{modality} {fault}") from None
    rows = chosen.join(ids.drop("first"), ["form", "battery_id"])
    seed = config["seed"]
    case = F.col("failure_case")
    rows = rows.withColumn("synthetic_id", F.concat(F.lit(f"QF17_{modality}_"), F.lpad(F.col("slot").cast("string"), 8, "0"))).withColumn("item_seed", stable_seed_column(seed, F.col("synthetic_id")))
    quality = F.when(F.col("fail"), "fail").otherwise("pass")
    group = stable_seed_column(seed, F.col("battery_id"), F.col("axis"), case).cast("string")
    made = {
        "raw_image_path": F.col("raw_image_path"), "source_image_relative_path": F.col("raw_image_path"), "source_json_relative_path": F.col("raw_json_path"), "source_stem": F.col("image_stem"),
        "original_battery_id": F.col("battery_id"), "original_image_id": F.col("image_id"), "new_image_id": F.lit(int(config[f"{m}_image_id_start"])) + F.col("slot") - 1,
        "assignment": F.when(F.col("fail"), "augmented").otherwise("original"), "quality_label": quality, "quality_class": quality, "selected": F.lit("true"), "extraction_rank": F.col("slot"),
        "case_seed": F.when(case == "", F.col("item_seed").cast("string")).otherwise(stable_seed_column(F.col("item_seed"), case).cast("string")), "item_seed": F.col("item_seed").cast("string"),
        "group_key": F.concat_ws("|", "battery_id", "axis") if ct else F.lit(""), "group_seed": F.when(case != "", group).otherwise("") if ct else F.lit(""),
        "roi": F.when(F.col("roi") == "", "null").otherwise(F.col("roi")), "raw_fingerprint": F.lit(fingerprint), "config_sha256": F.lit(config_hash(config)), "ct_bbox_policy_version": F.lit(config["ct_bbox_policy_version"]),
    }
    return rows.select(*[made[c].alias(c) if c in made else F.col(c) for c in PLAN_FIELDS])


def planned_audit(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """The audit with what the plan says of its rows."""
    names = ["extraction_rank", "selected", "assignment", "partition", "failure_case"]
    told = rows.select("modality", "raw_image_path", *[F.col(c).cast("string").alias(f"_p_{c}") for c in names])
    joined = audit.join(told, ["modality", "raw_image_path"], "left")
    return joined.select("folded", *[F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) if c in names else F.col(c) for c in S.AUDIT_FIELDS])


def make_plan(spark: SparkSession, root: str, config: dict[str, Any], reuse: str | None = None) -> Plan:
    """V4."""
    checked_config(config)
    found = S.scan(spark, root, config, reuse)
    S.blocked(found)
    fingerprint = S.raw_fingerprint(found.candidates)
    parts, spares = [], []
    for modality in ("CT", "RGB"):
        chosen, reserve = selected(spark, root, config, found.candidates, modality)
        parts.append(plan_rows(config, chosen, modality, fingerprint))
        spares.append(reserve.withColumn("source_stem", F.col("image_stem")).select(*[F.col(c) if c in (*reserve.columns, "source_stem") else F.lit("").alias(c) for c in RESERVE_FIELDS]))
    rows, spare = settle(parts[0].unionByName(parts[1]), "plan"), settle(spares[0].unionByName(spares[1]), "reserve")
    n = rows.count()
    metadata = {
        "schema_version": "1.1", "package_version": "1.7", "raw_fingerprint": fingerprint, "config_sha256": config_hash(config), "plan_rows": n, "selected_rows": n,
        "reserve_rows": spare.count(), "orphan_count": found.orphans, "ambiguous_pair_count": 0, "ct_bbox_policy_version": config["ct_bbox_policy_version"],
    }
    return Plan(rows, spare, planned_audit(found.audit, rows), metadata, found)


def _write_scan(found: S.Scan, audit: DataFrame, folder: Path) -> None:
    key = ["raw_split", "modality", "folded"]
    write_csv(folder / "scan_cache.csv", found.cache.orderBy(*key).toLocalIterator(), S.CACHE_FIELDS)
    write_csv(folder / "extraction_audit.csv", audit.orderBy(*key).toLocalIterator(), S.AUDIT_FIELDS)
    orphan = audit.where(F.col("exclusion_reason").isin("json_only", "image_only", "empty_pair"))
    write_csv(folder / "orphan_sources.csv", orphan.orderBy(*key).toLocalIterator(), S.AUDIT_FIELDS)
    write_csv(folder / "ct_bbox_exclusions.csv", audit.where("ct_bbox_excluded = 'true'").orderBy(*key).toLocalIterator(), S.AUDIT_FIELDS)  # P12


def write_audit(spark: SparkSession, root: str, config: dict[str, Any], output: str | Path, reuse: str | None = None) -> dict[str, Any]:
    """V3 with its files."""
    checked_config(config)
    out = local(output)
    found = S.scan(spark, root, config, reuse)
    _write_scan(found, found.audit, out / "manifests")
    summary = S.audit_summary(found, config)
    atomic_write(out / "raw_schema_summary.json", pretty_json(summary))
    return summary


def write_plan(spark: SparkSession, root: str, config: dict[str, Any], output: str | Path, reuse: str | None = None) -> dict[str, Any]:
    """V4 with its files."""
    out = local(output)
    plan = make_plan(spark, root, config, reuse)
    folder = out / "manifests"
    _write_scan(plan.scan, plan.audit, folder)
    write_csv(folder / "generation_plan.csv", plan.rows.orderBy("modality", "extraction_rank").toLocalIterator(), PLAN_FIELDS)
    write_csv(folder / "reserve_sources.csv", plan.reserve.orderBy("modality", "reserve_rank").toLocalIterator(), RESERVE_FIELDS)
    atomic_write(out / "plan_metadata.json", canonical_json(plan.metadata))
    return plan.metadata
