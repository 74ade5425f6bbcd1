"""Scan, plan, samples and checks on a small raw tree, against plain versions and what the contract says."""

import csv
import json
from collections import Counter

import numpy as np
import pytest

from marlspark import cli
from marlspark.functions.seeds import config_hash, permutation, stable_seed
from marlspark.kernels import codec, sample
from marlspark.plans import generate as G
from marlspark.plans import planning as P
from marlspark.plans import scan as S
from marlspark.plans.config import case_set, checked_config
from marlspark.plans.verify import raise_first, verify_rows
from tests.raw_tree import IMAGES, LABELS, config_of, label_of, picture, write_tree


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return write_tree(tmp_path_factory.mktemp("tree") / "raw")


@pytest.fixture(scope="module")
def plan(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("plan")
    metadata = P.write_plan(spark, str(raw), config_of(), str(out))
    return out, metadata


@pytest.fixture(scope="module")
def made(spark, raw, plan, tmp_path_factory):
    out = tmp_path_factory.mktemp("data") / "set"
    summary = G.generate(spark, str(raw), config_of(), plan[0] / "manifests" / "generation_plan.csv", str(out))
    return out, summary


def table(path):
    with open(path, encoding="utf-8-sig", newline="") as f:
        return list(csv.DictReader(f))


def test_golden_permutations():
    base = 20260723
    assert permutation(10, stable_seed(base, "CT", "extract")).tolist() == [6, 3, 4, 1, 2, 5, 7, 8, 0, 9]
    assert permutation(10, stable_seed(base, "RGB", "extract")).tolist() == [9, 8, 4, 2, 0, 1, 5, 3, 7, 6]
    assert permutation(10, stable_seed(base, "CT", "assignment")).tolist() == [4, 3, 8, 2, 6, 7, 5, 9, 1, 0]
    assert stable_seed(base, "RGB", "extract") == 5647678562623131441


def test_config(raw):
    config = config_of()
    assert checked_config(config) is config
    assert config_hash(config) == config_hash(config | {"jobs": 8, "worker_peak_rss_bytes": 929652736, "hash_chunk_bytes": 1})
    assert config_hash(config) != config_hash(config | {"seed": 1}) != config_hash(config | {"another": 1})
    for change, text in (
        ({"rng_algorithm": "MT"}, "rng_algorithm"), ({"conveyor_axis": "up"}, "conveyor_axis"), ({"forward_direction": "x"}, "forward_direction"), ({"ct_augmented_target": 3}, "sum to 3"),
        ({"rgb_failure_case_quotas": {"rgb_none": 2}}, "unknown"), ({"ct_test_fail_target": 3}, "impossible"), ({"rgb_test_target": 9}, "impossible"),
    ):
        with pytest.raises(ValueError, match=text):
            checked_config(config | change)
    assert case_set("rgb_surface_dust, ct_low_signal_noise,") == {"rgb_surface_dust", "ct_low_signal_noise"}
    with pytest.raises(ValueError, match="Unknown failure case: nope"):
        case_set("nope")


def test_plan(raw, plan):
    out, metadata = plan
    assert metadata["selected_rows"] == 8 and metadata["reserve_rows"] == 2 and metadata["ambiguous_pair_count"] == 0
    rows = table(out / "manifests" / "generation_plan.csv")
    assert list(rows[0]) == P.PLAN_FIELDS and [r["synthetic_id"] for r in rows] == [f"QF17_{m}_{k:08d}" for m in ("CT", "RGB") for k in range(1, 5)]
    assert Counter((r["modality"], r["quality_label"]) for r in rows) == {(m, q): 2 for m in ("CT", "RGB") for q in ("pass", "fail")}
    assert {(r["modality"], r["partition"], r["quality_label"]) for r in rows} == {(m, p, q) for m in ("CT", "RGB") for p in ("main", "test") for q in ("pass", "fail")}
    for m in ("CT", "RGB"):
        mine = [r for r in rows if r["modality"] == m]
        names = sorted((f"CT_cell_pouch_{k}_x_{k}" if m == "CT" else f"RGB_cell_cylindrical_{k}_{k}") for k in range(1, 7))
        drawn = [names[i] for i in permutation(6, stable_seed(20260723, m, "extract"))[:5]]
        assert [r["source_stem"] for r in mine] == drawn[:4]
        fails = sorted(permutation(4, stable_seed(20260723, m, "assignment"))[:2].tolist())
        assert [i for i, r in enumerate(mine) if r["quality_label"] == "fail"] == fails
        cases = list(config_of()[f"{m.lower()}_failure_case_quotas"])
        assert [mine[i]["failure_case"] for i in fails] == [cases[k] for k in permutation(2, stable_seed(20260723, m, "failure-cases"))]
        start = int(config_of()[f"{m.lower()}_battery_id_start"])
        assert [int(r["new_battery_id"]) for r in mine] == list(range(start, start + 4))
        for k, r in enumerate(mine):
            seed = stable_seed(20260723, r["synthetic_id"])
            case = r["failure_case"]
            assert int(r["item_seed"]) == seed and int(r["case_seed"]) == (stable_seed(seed, case) if case else seed)
            assert int(r["new_image_id"]) == int(config_of()[f"{m.lower()}_image_id_start"]) + k and r["extraction_rank"] == str(k + 1)
            assert r["group_seed"] == (str(stable_seed(20260723, r["original_battery_id"], r["axis"], case)) if m == "CT" and case else "")
            assert r["roi"] == ("[0.0, 0.0, 100.0, 100.0]" if m == "CT" else "null") and r["config_sha256"] == config_hash(config_of())
            assert r["porosity_bbox_max_ratio"] == ("0.04000000" if m == "CT" else "0.00000000")
            index = int(r["original_image_id"]) - 1
            assert r["pixel_hash"] == codec.pixel_digest(picture(m, index))
    audit = table(out / "manifests" / "extraction_audit.csv")
    assert list(audit[0]) == S.AUDIT_FIELDS and len(audit) == 12 and sum(r["selected"] == "true" for r in audit) == 8
    assert len(table(out / "manifests" / "reserve_sources.csv")) == 2


def test_samples_and_checks(spark, made):
    out, summary = made
    assert summary["counts"] == {f"{m}_{q}": 2 for m in ("CT", "RGB") for q in ("pass", "fail")}
    assert sum(summary["failure_case_counts"].values()) == 4
    rows = table(out / "manifests" / "dataset_manifest.csv")
    assert list(rows[0]) == G.DATASET_FIELDS and len(list(out.glob("*/*/labels_json/*.json"))) == 8 and len(list(out.glob("*/*/augmentation_json/*.json"))) == 4
    for r in rows:
        label = json.loads((out / r["label_json_path"]).read_text(encoding="utf-8"))
        assert label["quality_class"] == r["quality_label"] == r["quality_class"] and label["image_info"]["width"] == int(r["width"])
        assert max(int(r["width"]), int(r["height"])) == 64 and r["image_relative_path"] == r["image_path"]
        assert (r["augmentation_json_path"] == "") == (r["quality_label"] == "pass") == (r["augmentation_json_sha256"] == "")
        if r["quality_label"] == "fail":
            told = json.loads((out / r["augmentation_json_path"]).read_text(encoding="utf-8"))
            assert told["schema_version"] == "1.1" and told["failure_case"]["id"] == r["failure_case"] and told["automatic_checks"]["passed"]
            assert r["augmentations"] == "|".join(a["type"] for a in told["augmentations"])
    lineage = table(out / "manifests" / "lineage_private.csv")
    assert list(lineage[0]) == G.LINEAGE_FIELDS and len(lineage) == 8
    assert (out / "generation_summary.json").is_file() and (out / "augmentation_json_4k_v1.7.zip").is_file() and (out / "manifests" / "generation_plan.csv").is_file()
    assert verify_rows(spark, str(out)).count() == 0
    with pytest.raises(ValueError, match="not empty"):
        G.generate(spark, "", config_of(), out / "x.csv", str(out))


def test_resume_drops_what_no_row_names_and_makes_dropped_cases_again(spark, raw, plan, made):
    out, _ = made
    before = {p.relative_to(out): p.read_bytes() for p in out.glob("*/*/images/*")}
    stray = out / "CT" / "main" / "images" / "uncommitted.jpg"
    stray.write_bytes(b"partial")
    again = G.generate(spark, str(raw), config_of(), plan[0] / "manifests" / "generation_plan.csv", str(out), resume=True, trust=True, drop={"rgb_surface_dust"})
    assert sum(again["counts"].values()) == 8 and not stray.exists()
    told = table(out / "manifests" / "recovery_audit.csv")
    assert any(r["path"].endswith("uncommitted.jpg") for r in told) and len(told) == 4  # and the three files of the dropped sample
    assert {p.relative_to(out): p.read_bytes() for p in out.glob("*/*/images/*")} == before


def test_a_changed_file_is_found(spark, made):
    out, _ = made
    row = table(out / "manifests" / "dataset_manifest.csv")[0]
    place = out / row["label_json_path"]
    whole = place.read_bytes()
    try:
        place.write_bytes(whole.replace(b'"quality_class":"', b'"quality_class":"x'))
        faults = verify_rows(spark, str(out))
        with pytest.raises(ValueError, match="mismatch"):
            raise_first(faults)
        place.unlink()
        assert [r["fault"] for r in verify_rows(spark, str(out)).collect()] == [f"Missing image/label output: {row['synthetic_id']}"]
    finally:
        place.write_bytes(whole)


def test_failed_samples_are_replaced_from_the_reserve(spark, raw, plan):
    """A label of another quality cannot be made; the next of the reserve takes its slot, ids and seeds."""
    rows = spark.createDataFrame(table(plan[0] / "manifests" / "generation_plan.csv"))
    tasks = rows.where("modality = 'CT'").withColumn("replacement_for", rows["group_key"].substr(1, 0)).select(*G.CARRIED)
    bad = tasks.replace("low", "low").limit(0)
    first = tasks.orderBy("synthetic_id").first()["synthetic_id"]
    failed = tasks.where(tasks.synthetic_id == first).selectExpr("*", "'ValueError: x' AS error")
    reserve = spark.createDataFrame(table(plan[0] / "manifests" / "reserve_sources.csv"))
    got = G.replaced(spark, str(raw), failed, reserve, config_of()).collect()
    assert bad.count() == 0 and len(got) == 1 and got[0]["error"] == "" and got[0]["synthetic_id"] == first
    spare = next(r for r in table(plan[0] / "manifests" / "reserve_sources.csv") if r["modality"] == "CT")
    assert got[0]["raw_image_path"] == spare["raw_image_path"] and got[0]["replacement"] == failed.first()["raw_image_path"]
    none = G.replaced(spark, str(raw), failed, reserve.limit(0), config_of()).collect()
    assert [r["error"] for r in none] == ["ValueError: x"]


def test_scan_states(spark, tmp_path):
    """Orphans, ambiguous keys, faults, copies and porous labels, each with its reason."""
    raw = write_tree(tmp_path / "raw", 5)
    images, labels = raw / "Training" / IMAGES / "CT", raw / "Training" / LABELS / "CT" / "labels"
    (labels / "CT_cell_pouch_999_x_999.json").write_text("{}")
    other = images / "again"
    other.mkdir()
    (other / "CT_cell_pouch_1_x_1.png").write_bytes((images / "images" / "CT_cell_pouch_1_x_1.png").read_bytes())
    (labels / "CT_cell_pouch_2_x_2.json").write_text(json.dumps({"data_info": {}}))
    copied = images / "images" / "CT_cell_coin_12_x_3.png"
    copied.write_bytes((images / "images" / "CT_cell_pouch_3_x_3.png").read_bytes())
    (labels / "CT_cell_coin_12_x_3.json").write_text("﻿" + json.dumps(label_of("ct_CELL_coin_12_x_3.PNG", 9, "CT")), encoding="utf-8")
    porous = label_of("CT_cell_pouch_4_x_4.png", 4, "CT")
    porous["defects"][0]["points"] = [[0, 0], [60, 0], [60, 60], [0, 60]]
    (labels / "CT_cell_pouch_4_x_4.json").write_text(json.dumps(porous))
    (images / "images" / "CT_cell_pouch_5_x_5.png").write_bytes(b"nothing")
    (raw / "notes.txt").write_text("x")
    found = S.scan(spark, str(raw), config_of())
    told = {r["image_stem"]: (r["validation_status"], r["exclusion_reason"]) for r in found.audit.where("modality = 'CT'").collect()}
    assert told["CT_cell_pouch_999_x_999"] == ("excluded_source", "json_only")
    assert told["CT_cell_pouch_1_x_1"] == ("blocking_systemic", "matching_cardinality_ambiguous: images=2, json=1")
    assert told["CT_cell_pouch_2_x_2"] == ("excluded_source", "ValueError: missing top-level field: swelling")
    assert told["CT_cell_coin_12_x_3"] == ("valid", "")
    assert told["CT_cell_pouch_3_x_3"] == ("excluded_source", "duplicate_pixel_hash:CT_cell_coin_12_x_3")
    assert told["CT_cell_pouch_4_x_4"] == ("excluded_source", "ct_porosity_bbox_max_ratio_ge_0.25")
    assert told["CT_cell_pouch_5_x_5"][1].startswith("OSError: cannot identify image file") and found.orphans == 1
    with pytest.raises(ValueError, match="1 blocking_systemic"):
        S.blocked(found)
    loose = S.scan(spark, str(raw), config_of(ct_porosity_threshold=0.9))
    assert loose.audit.where("image_stem = 'CT_cell_pouch_4_x_4'").first()["validation_status"] == "valid"


def test_cache_of_an_earlier_scan(spark, raw, plan, tmp_path):
    folder = plan[0] / "manifests"
    again = P.write_plan(spark, str(raw), config_of(), str(tmp_path / "b"), reuse=str(plan[0]))
    assert again == plan[1]
    for name in ("generation_plan.csv", "extraction_audit.csv", "scan_cache.csv", "reserve_sources.csv"):
        assert (tmp_path / "b" / "manifests" / name).read_bytes() == (folder / name).read_bytes()
    text = (folder / "scan_cache.csv").read_text(encoding="utf-8-sig")
    for k, (wrong, fault) in enumerate(((text.replace("cache_version", "version", 1), "schema mismatch"), (text.replace("\n2,", "\n1,"), "rebuild the cache"))):
        (tmp_path / f"{k}.csv").write_text(wrong, encoding="utf-8-sig", newline="")
        with pytest.raises(ValueError, match=fault):
            S.load_cache(spark, str(tmp_path / f"{k}.csv"))
    with pytest.raises(ValueError, match="not found"):
        S.load_cache(spark, str(tmp_path / "none.csv"))
    # of a key that comes twice the last line counts
    lines = text.splitlines()
    (tmp_path / "twice.csv").write_text("\r\n".join([*lines, lines[1].replace(",valid,", ",error,")]) + "\r\n", encoding="utf-8-sig", newline="")
    cache = S.load_cache(spark, str(tmp_path / "twice.csv"))
    assert cache.count() == len(lines) - 1 and cache.where("status = 'error'").count() == 1


def test_circuit_breakers(spark):
    def rows(reasons):
        return spark.createDataFrame([("training", "CT", f"{k:04d}", r) for k, r in enumerate(reasons)], "raw_split string, modality string, folded string, exclusion_reason string").repartition(3)

    fault = "ValueError: x"
    S.circuit_breaker(rows([fault] * 19 + [""] + [fault] * 19), 20, 100)
    S.circuit_breaker(rows([fault] * 19 + ["duplicate_pixel_hash:a"] + [fault] * 19), 20, 100)
    with pytest.raises(ValueError, match="ValueError; consecutive=20, cumulative=20"):
        S.circuit_breaker(rows([fault] * 20), 20, 100)
    with pytest.raises(ValueError, match="consecutive=1, cumulative=5"):
        S.circuit_breaker(rows([fault, "", "KeyError: k"] * 9), 20, 5)
    S.circuit_breaker(rows([fault, "KeyError: k"] * 10), 20, 100)


def test_preflight(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="0 valid pair candidates: validation/CT"):
        S.scan(spark, str(raw), config_of(preflight_per_stratum=2))
    both = write_tree(write_tree(tmp_path / "raw", 2), 3, "Validation")
    assert S.scan(spark, str(both), config_of(preflight_per_stratum=2)).ambiguous == 0
    for k in (1, 2):
        (both / "Training" / LABELS / "RGB" / "labels" / f"RGB_cell_cylindrical_{k}_{k}.json").write_text("[]")
    with pytest.raises(ValueError, match="training/RGB ValueError repeated 2"):
        S.scan(spark, str(both), config_of(preflight_per_stratum=2, preflight_repeated_error_limit=2))
    with pytest.raises(ValueError, match="0 valid samples: training/RGB"):
        S.scan(spark, str(both), config_of(preflight_per_stratum=2))


def test_plan_faults(spark, raw, plan, tmp_path):
    with pytest.raises(ValueError, match="CT: needs 9 valid unique sources including reserve, found 6"):
        P.make_plan(spark, str(raw), config_of(reserve_per_modality=5))
    with pytest.raises(ValueError, match="CT synthetic battery ID range exhausted"):
        P.make_plan(spark, str(raw), config_of(ct_battery_id_end=1900000002))
    rows = spark.createDataFrame(table(plan[0] / "manifests" / "generation_plan.csv"))
    with pytest.raises(ValueError, match="differs from approved plan"):
        G.checked_plan(spark, str(raw), config_of(seed=2), rows)
    with pytest.raises(ValueError, match="duplicate"):
        G.checked_plan(spark, str(raw), config_of(), rows.unionByName(rows.limit(1)), trust=True)
    copy = write_tree(tmp_path / "raw")
    first = copy / rows.orderBy("modality", "synthetic_id").first()["raw_image_path"]
    whole = first.read_bytes()
    first.write_bytes(whole + b"x")
    with pytest.raises(ValueError, match="Plan source changed"):
        G.checked_plan(spark, str(copy), config_of(), rows, trust=True)
    first.unlink()
    with pytest.raises(ValueError, match="Plan source missing"):
        G.checked_plan(spark, str(copy), config_of(), rows, trust=True)
    assert G.limited(rows, config_of(), 2).groupBy("modality", "quality_label").count().count() == 4


def test_stages():
    image = np.full((10, 20, 3), 255, np.uint8)
    label = {"defects": [{"points": [2, 2, 10, 2, 10, 6, 2, 6]}], "swelling": {"battery_outline": [0, 0, 20, 0, 20, 10, 0, 10]}}
    source = sample.Source(image, label, sample.shift(-3, -4), np.full((10, 20), 255, np.uint8), np.zeros((10, 20), np.uint8), [3, 4, 23, 14])
    same = sample.transformed(source, "CT", "pass", "", 7, 8)
    assert same.records == [] and same.matrix == source.matrix and same.image is image
    source.matrix = sample.IDENTITY
    got = sample.finalized(sample.transformed(source, "RGB", "pass", "", 7, 8), "RGB", "pass", 100, 200, "sample.jpg", 10, False)
    assert got.image.shape[:2] == (5, 10) and got.matrix.point(10, 6) == (5.0, 3.0)
    flat = got.label["defects"][0]["points"]
    assert set(zip(flat[::2], flat[1::2], strict=True)) == {(1.0, 1.0), (5.0, 1.0), (5.0, 3.0), (1.0, 3.0)}
    for quality, case, text in (("pass", "x", "must not"), ("fail", "", "no failure_case"), ("odd", "", "Unknown quality")):
        with pytest.raises(ValueError, match=text):
            sample.transformed(source, "RGB", quality, case, 7, 8)
    with pytest.raises(ValueError, match="porosity polygon"):
        sample.transformed(source, "CT", "fail", "ct_cell_alignment_failure", 7, 8)
    assert sample.porosity_ids({"defects": [{"name": "a"}, {"class": " Porosity "}, {"name": "porosity", "id": 9}]}) == ("1", "9")


def test_command_line(spark, raw, tmp_path, capsys):
    (tmp_path / "c.json").write_text("﻿" + json.dumps(config_of()), encoding="utf-8")
    args = ["--raw-root", str(raw), "--config", str(tmp_path / "c.json")]
    assert cli.main(["audit-raw", *args, "--output", str(tmp_path / "a")], spark)["valid_pairs"] == {"CT": 6, "RGB": 6}
    assert (tmp_path / "a" / "raw_schema_summary.json").is_file() and (tmp_path / "a" / "logs" / "audit.log").is_file()
    with pytest.raises(SystemExit):
        cli.main(["generate", *args, "--output", "x", "--plan", "y", "--drop-cases", "nope"], spark)
    assert "Unknown failure case: nope" in capsys.readouterr().err
    assert [cli.format_duration(s) for s in (None, -1, 59.6, 3600, 61)] == ["계산 중", "계산 중", "01:00", "01:00:00", "01:01"]


def test_stages_of_a_run(spark, raw, tmp_path, caplog):
    from marlspark.plans import run

    for stage in ("plan", "smoke", "generate"):
        result = run.run_stage(spark, stage, str(raw), config_of(), tmp_path / "run", smoke=2)
    assert sum(result["counts"].values()) == 8 and json.loads((tmp_path / "run" / "status.json").read_text())["state"] == "done"
    assert json.loads((tmp_path / "run" / "measured.json").read_text())["worker_peak_rss_bytes"] > 0
    n = run.run_stage(spark, "upload", str(raw), config_of(), tmp_path / "run", tmp_path / "out")["files"]
    assert n == sum(p.is_file() for p in (tmp_path / "run" / "output").rglob("*")) == sum(p.is_file() for p in (tmp_path / "out").rglob("*"))
    first, archives, tree = run.waves(tmp_path / "run" / "output")
    assert [p.suffix for p in archives] == [".zip"] and len(tree) == 20 and any(p.name == "dataset_manifest.csv" for p in first)
    with pytest.raises(ValueError, match="not empty"):
        run.run_stage(spark, "generate", str(raw), config_of(), tmp_path / "run")
    assert json.loads((tmp_path / "run" / "status.json").read_text())["state"] == "failed"
    with pytest.raises(ValueError, match="no worker memory"):
        run.measured_config({}, {})
    bar = run.Progress(cli.logger_of("marlspark.test", tmp_path / "x.log"), "pairs", 100, every=10, seconds=30, began=0.0)
    assert [bar.update(k, now=float(t)) for k, t in ((1, 1), (10, 2), (15, 3), (16, 40), (100, 41))] == [False, True, False, True, True]
    assert len((tmp_path / "x.log").read_text().splitlines()) == 3
