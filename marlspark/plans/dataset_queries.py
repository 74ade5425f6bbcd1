"""Queries of the plan, label, raster and gate operators over the driver's tables, each beside its SQL."""

from __future__ import annotations

import hashlib
import json
import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspark.functions import geometry as G
from marlspark.functions.names import new_stem, parse_stem
from marlspark.functions.seeds import stable_seed_column
from marlspark.kernels import codec
from marlspark.operators import assign as A
from marlspark.operators import images as I
from marlspark.operators import measures as M
from marlspark.operators import relational as R
from marlspark.plans import scan as S
from marlspark.plans.catalogue import SEED, query, t
from marlspark.sources.store import local, placed, read_csv, write_csv


@query("""WITH p AS (SELECT p_partkey, p_size::DOUBLE AS s, p_partkey % 8 AS kind FROM part)
    SELECT p_partkey, CASE WHEN kind IN (0, 1, 4) THEN 0.0::DOUBLE WHEN kind = 5 THEN 1.0 END AS l, CASE WHEN kind IN (0, 1, 4) THEN s WHEN kind = 5 THEN s + 1 END AS r,
    CASE kind WHEN 2 THEN 'conflict' WHEN 3 THEN 'missing' WHEN 6 THEN 'malformed' WHEN 7 THEN 'out of bounds' ELSE '' END AS error FROM p""")
def roi_reconciled(spark, sf):
    """two regions of a label, one or both or none given, in four encodings, some malformed."""
    kind, size = F.col("p_partkey") % 8, F.col("p_size").cast("string")
    flat = F.concat(F.lit("["), size, F.lit(", 30]"))
    keyed = F.concat(F.lit('{"x": 1, "y": 2, "width": '), size, F.lit(', "height": 5}'))
    half = F.concat(F.lit('{"x": 3, "width": '), size, F.lit(', "height": 30}'))
    first = F.when(kind.isin(0, 2), flat).when(kind == 1, F.concat(F.lit("[0, 0, "), size, F.lit(", 30]"))).when(kind == 4, half).when(kind == 6, '["a", 3]').when(kind == 7, "[9999, 3]")
    second = F.when(kind == 1, flat).when(kind == 2, "[3, 3]").when(kind == 5, keyed)
    df = t(spark, sf, "part").select("p_partkey", *[G.roi_bounds(c, F.lit(99), F.lit(99)).alias(n) for c, n in ((first, "a"), (second, "b"))])
    found = df.select("p_partkey", G.reconciled_roi(F.col("a"), F.col("b")).alias("roi"))
    return found.select("p_partkey", "roi.l", "roi.r", "roi.error")


def _rectangle(kind, x0, y0, x1, y1):
    """The corners in one of four encodings; as text, from columns."""
    n = lambda c: c.cast("string")
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    join = lambda parts, sep: F.concat_ws(sep, *parts)
    flat = join([n(c) for p in corners for c in p], ",")
    pairs = join([F.concat(F.lit("["), n(a), F.lit(","), n(b), F.lit("]")) for a, b in corners], ",")
    keyed = join([F.concat(F.lit('{"x":'), n(a), F.lit(',"y":'), n(b), F.lit("}")) for a, b in corners], ",")
    wrap = lambda c: F.concat(F.lit("["), c, F.lit("]"))
    return F.when(kind == 0, wrap(flat)).when(kind == 1, wrap(pairs)).when(kind == 2, wrap(keyed)).otherwise(wrap(F.concat(wrap(pairs), F.lit(",[]"))))


@query("""WITH p AS (SELECT p_partkey, p_partkey % 40 - 10 AS x0, p_size AS w, p_partkey % 6 AS kind FROM part),
    c AS (SELECT *, greatest(least(x0 + w, 20) - greatest(x0, 0), 0) AS dx, least(w, 30) AS dy FROM p)
    SELECT p_partkey, CASE WHEN kind = 5 THEN NULL WHEN kind = 4 THEN 0.0::DOUBLE WHEN dx > 0 THEN round(dx / 20.0::DOUBLE * (dy / 30.0::DOUBLE), 9) ELSE 0.0::DOUBLE END AS share,
    CASE WHEN kind = 5 THEN NULL WHEN kind = 4 OR dx = 0 THEN 0::BIGINT ELSE 1::BIGINT END AS parts,
    CASE WHEN kind = 5 THEN 'ValueError: unsupported_points_schema: flat coordinates need >= 3 x/y pairs' ELSE '' END AS error FROM c""")
def ring_metrics(spark, sf):
    """Rings in four encodings, none, or too few points, clipped to a box of 20 by 30."""
    kind, x0, w = F.col("p_partkey") % 6, F.col("p_partkey") % 40 - 10, F.col("p_size")
    points = F.when(kind == 4, "[]").when(kind == 5, "[1, 2, 3, 4]").otherwise(_rectangle(kind, x0, F.lit(0), x0 + w, w))
    df = t(spark, sf, "part").select("p_partkey", points.alias("points"), F.lit("[0, 0, 20, 30]").alias("box"))
    return I.ring_shares(df, ["p_partkey"], "points", "box").withColumn("share", F.round("share", 9))


@query("""WITH p AS (SELECT p_partkey, p_size AS w, p_partkey % 4 AS kind FROM part), m AS (SELECT *, least(0.5::DOUBLE * w + 1, 20) - 1 AS dx, least(2.0::DOUBLE * w, 40) AS dy FROM p)
    SELECT p_partkey, CASE WHEN dx * dy >= 1 THEN 1::BIGINT ELSE 0::BIGINT END AS rings, CASE WHEN dx * dy >= 1 THEN round((dx * dy)::DOUBLE, 6) ELSE 0.0::DOUBLE END AS area, '' AS error FROM m""")
def moved_label_rings(spark, sf):
    """squares under a matrix, clipped to a frame of 20 by 40; those under a pixel go."""
    kind, w = F.col("p_partkey") % 4, F.col("p_size")
    df = t(spark, sf, "part").select("p_partkey", _rectangle(kind, F.lit(0), F.lit(0), w, w).alias("points"), F.lit("[0.5, 0, 0, 2, 1, 0]").alias("matrix"))
    return I.transformed_rings(df, ["p_partkey"], "points", "matrix", (20, 40))


@query("""WITH p AS (SELECT p_partkey, p_size::DOUBLE AS w, p_partkey % 5 AS kind, CASE WHEN p_partkey % 2 = 0 THEN 'fail' ELSE 'pass' END AS q FROM part)
    SELECT p_partkey, CASE WHEN kind <> 4 OR q = 'fail' THEN '{"data_info":{"battery_ids":' || (p_partkey + 5) || ',"roi":[0,0,100,100]},"defects":[{"name":"d","points":[1.0,2.0,' || (1 + w / 2) || ',2.0,' || (1 + w / 2) || ',7.0,1.0,7.0]}],'
    || '"image_info":{"file_name":"f.jpg","height":100,"id":' || p_partkey || ',"width":100},"quality_class":"' || q || '","swelling":{"battery_outline":[]}}' END AS label,
    CASE WHEN kind = 4 AND q = 'pass' THEN 'ValueError: quality_class conflict: source=''fail'', assigned=''pass''' ELSE '' END AS error FROM p""")
def label_rewrite(spark, sf):
    """Labels rewritten by a matrix, in canonical form; a fifth already has a quality."""
    k, w = F.col("p_partkey"), F.col("p_size")
    points = _rectangle(F.lit(0), F.lit(0), F.lit(0), w, F.lit(10))
    had = F.when(k % 5 == 4, F.lit('"quality_class": "fail", ')).otherwise(F.lit(""))
    text = F.concat(F.lit("{"), had, F.lit('"swelling": {"battery_outline": []}, "image_info": {"roi": [5, 5]}, "defects": [{"name": "d", "points": '), points, F.lit("}]}"))
    df = t(spark, sf, "part").select(k, text.alias("label"), F.lit("[0.5, 0, 0, 0.5, 1, 2]").alias("m"), F.when(k % 2 == 0, "fail").otherwise("pass").alias("q"), (k + 5).alias("b"), k.alias("i"), F.lit("f.jpg").alias("n"))
    return I.rewritten_labels(df, ["p_partkey"], "label", "m", (100, 100), "CT", "q", "b", "i", "n")


@query("SELECT o_orderkey, printf('%.8f', o_orderkey / 512.0::DOUBLE) AS ratio, (o_orderkey % 2 = 0)::VARCHAR AS flag FROM orders")
def ratio_text(spark, sf):
    """ratios with 8 decimals, among them exact ties; booleans as text."""
    return t(spark, sf, "orders").select("o_orderkey", M.eight_decimals(F.col("o_orderkey") / F.lit(512.0)).alias("ratio"), (F.col("o_orderkey") % 2 == 0).cast("string").alias("flag"))


@query("""WITH f AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'RGB' ELSE 'CT' END AS modality, p_size / 50.0 AS ratio, p_partkey % 17 = 0 AS broken, sha256((p_partkey % 700)::VARCHAR) AS hash, lpad(p_partkey::VARCHAR, 9, '0') AS stem FROM part),
    j AS (SELECT *, CASE WHEN broken THEN 'KeyError: ''x''' WHEN modality = 'CT' AND ratio >= 0.5 THEN 'ct_porosity_bbox_max_ratio_ge_0.25' ELSE '' END AS reason FROM f),
    w AS (SELECT *, first_value(stem) OVER v AS winner FROM j WINDOW v AS (PARTITION BY modality, hash, reason = '' ORDER BY stem))
    SELECT modality, CASE WHEN reason = '' AND winner <> stem THEN 'duplicate_pixel_hash' WHEN broken THEN 'KeyError' ELSE reason END AS reason,
    CASE WHEN reason = '' AND winner = stem THEN 'valid' ELSE 'excluded_source' END AS state, count(*) AS n, min(CASE WHEN reason = '' AND winner <> stem THEN 'duplicate_pixel_hash:' || winner ELSE reason END) AS first FROM w GROUP BY 1, 2, 3""")
def audit_states(spark, sf):
    """Facts judged by a threshold, copies out, counted by reason."""
    k = F.col("p_partkey")
    facts = t(spark, sf, "part").select(
        F.lit("training").alias("raw_split"), F.when(k % 3 == 0, "RGB").otherwise("CT").alias("modality"), F.lpad(k.cast("string"), 9, "0").alias("folded"), F.lpad(k.cast("string"), 9, "0").alias("image_stem"),
        F.when(k % 17 == 0, "error").otherwise(S.VALID).alias("status"), (F.col("p_size") / 50.0).alias("ratio"), F.when(k % 17 == 0, "KeyError: 'x'").otherwise("").alias("exclusion_reason"), F.sha2((k % 700).cast("string"), 256).alias("pixel_hash"),
    )
    rows = S.without_copies(S.judged(facts, 0.5))
    reason = F.substring_index("exclusion_reason", ":", 1).alias("reason")
    return rows.groupBy("modality", reason, F.col("validation_status").alias("state")).agg(F.count(F.lit(1)).alias("n"), F.min("exclusion_reason").alias("first"))


def _tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Grey images of 8 by 8 from the vectors."""
    level = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x.cast("double") * 400 + 128))).cast("int"))
    data = F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    return t(spark, sf, "embeddings").select("vec_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"), data.alias("data"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(0, least(255, floor(x::DOUBLE * 400 + 128)))::INTEGER) AS p FROM embeddings),
    b AS (SELECT *, list_concat(p[1:8], p[57:64], [p[i * 8 + 1] for i in range(8)], [p[i * 8 + 8] for i in range(8)]) AS edge FROM v),
    e AS (SELECT *, quantile_cont_list AS cut FROM (SELECT *, list_aggregate(edge, 'quantile_cont', 0.2) AS quantile_cont_list FROM b))
    SELECT vec_id, floor(list_median(edge))::BIGINT AS background, floor(list_median(list_filter(edge, lambda x: x <= cut)))::BIGINT AS air,
    (list_sum([p[i // 6 * 8 + i % 6 + 1] for i in range(42)]) + 7 * (64 - 42))::BIGINT AS moved,
    list_sum([round_even(sqrt(x / 255.0) * 255, 0) for x in p])::BIGINT AS gamma, list_sum([floor(x / 2.0) for x in p])::BIGINT AS dimmed,
    len([x for x in p if CASE WHEN x / 255.0 <= 0.04045 THEN x / 255.0 / 12.92 ELSE ((x / 255.0 + 0.055) / 1.055) ** 2.4 END >= 0.2])::BIGINT AS linear, list_sum([least(x + 30, 255) for x in p])::BIGINT AS added,
    len([x for x in p if x >= 128])::BIGINT AS bright, coalesce(([i % 8 + i // 8 for i in range(64) if p[i + 1] >= 128])[1], 0)::BIGINT AS first,
    list_sum([floor((p[greatest(x - 1, 0) + 1] + p[x + 1] + p[least(x + 1, 7) + 1])::FLOAT / 3::FLOAT) for x in range(8)])::BIGINT AS blurred, '' AS error FROM e""")
def raster_measures(spark, sf):
    """Each operator on a grey tile, in sums."""
    return I.measured(_tiles(spark, sf), ["vec_id"])


@query("""WITH v AS (SELECT vec_id, vec_id % 12 AS kind FROM embeddings)
    SELECT vec_id, CASE WHEN kind IN (0, 4, 6) THEN true END AS passed, CASE kind WHEN 0 THEN '' WHEN 1 THEN 'ValueError: FAIL sample has no augmentation records' WHEN 2 THEN 'ValueError: quality_gate: lens dust shadow count is outside 1..4'
    WHEN 3 THEN 'ValueError: quality_gate: lens dust frame coverage is outside range' WHEN 4 THEN '' WHEN 5 THEN 'ValueError: quality_gate: glare outline overlap is below 90%' WHEN 6 THEN ''
    WHEN 7 THEN 'ValueError: quality_gate: metal streak rays do not cover all four quadrants' WHEN 8 THEN 'ValueError: quality_gate: metal streak maximum angular gap exceeds 35 degrees'
    WHEN 9 THEN 'ValueError: augmentation produced a near-constant image' WHEN 10 THEN 'ValueError: quality_gate: hair length is outside 15%..60% of long side' ELSE 'ValueError: quality_gate: required edge-energy reduction was not reached' END AS error FROM v""")
def gate_texts(spark, sf):
    """The first gate that does not hold, by the records of an image."""
    note = lambda kind, **p: json.dumps([{"order": 1, "type": kind, "severity": 1.0, "parameters": p}])
    glare = {"outline_overlap_ratio": 0.95, "core_object_area_ratio": 0.05}
    rays = {"dense_intersection_pixels": 5, "quadrant_counts": [5, 5, 5, 5], "max_angular_gap_deg": 20}
    told = [
        note("lens_dust_shadow", shadow_count=2, frame_affected_ratio=0.1), "[]", note("lens_dust_shadow", shadow_count=5, frame_affected_ratio=0.1), note("lens_dust_shadow", shadow_count=2, frame_affected_ratio=0.5),
        note("surface_aware_specular_reflection", **glare), note("surface_aware_specular_reflection", **glare | {"outline_overlap_ratio": 0.5}), note("metal_anchored_streaks", **rays), note("metal_anchored_streaks", **rays | {"quadrant_counts": [9, 9, 1, 1]}),
        note("metal_anchored_streaks", **rays | {"max_angular_gap_deg": 40}), note("x"), note("lens_fiber_shadow", curves=[{"thickness_px": 1, "length_px": 8}]), note("defocus_blur"),
    ]
    kind = F.col("vec_id") % 12
    records = F.element_at(F.array(*map(F.lit, told)), (kind + 1).cast("int"))
    flat = F.unhex(F.lit("55" * 64))
    wavy = F.unhex(F.lit("".join(f"{(60 + 37 * i) % 160 + 40:02x}" for i in range(64))))
    df = _tiles(spark, sf).withColumns({"data": F.when(kind == 9, flat).otherwise(wavy), "records": records})
    return I.gated(df, ["vec_id"])


@query()
def failure_cases(spark, sf):
    """Every case on images of 96 by 96 made from vectors, with retries; what was recorded, and the digest of the pixels."""
    from marlspark.kernels.cases import CASES

    def painted(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                image = np.empty((96, 96, 3), np.uint8)
                image[:] = 80 + (np.array(values[:3]) * 60).astype(int).clip(-20, 20)
                image[12:85, 12:16] = image[12:85, 81:85] = image[12:16, 12:85] = image[81:85, 12:85] = 230
                image[40:56, 40:56] = 250
                out.append((key, image.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([d for _, d in out], pa.binary())], names=["vec_id", "data"])

    df = t(spark, sf, "embeddings").select("vec_id", "embedding").mapInArrow(painted, "vec_id long, data binary").withColumns({"height": F.lit(96), "width": F.lit(96), "channels": F.lit(3)})
    made = []
    for modality, names in CASES.items():
        first = 0 if modality == "CT" else 5
        mine = df.where((F.col("vec_id") % 13 >= first) & (F.col("vec_id") % 13 < first + len(names)))
        named = mine.withColumn("case", F.element_at(F.array(*map(F.lit, names)), (F.col("vec_id") % 13 - first + 1).cast("int")))
        made.append(I.synthesised(named, ["vec_id", "case"], modality, "case", SEED))
    return made[0].unionByName(made[1]).select("vec_id", "case", "types", "error", F.sha2("made", 256).alias("pixels"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(32, least(126, floor(x::DOUBLE * 100 + 80)))::INTEGER) AS p FROM embeddings)
    SELECT vec_id, sha256('L|8|8|' || array_to_string([chr(x) for x in p], '')) AS digest FROM v""")
def pixel_digests(spark, sf):
    """the digest of mode, size and pixels."""
    level = F.transform("embedding", lambda x: F.greatest(F.lit(32), F.least(F.lit(126), F.floor(x.cast("double") * 100 + 80))).cast("int"))
    data = F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    df = t(spark, sf, "embeddings").select("vec_id", data.alias("data"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"))
    return I.each(df, ["vec_id"], I.IMAGE, "digest string", lambda h, w, c, d: {"digest": codec.pixel_digest(I.pixels_of(h, w, c, d))}).drop("error")


@query("SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1 AS place FROM orders")
def pool_places(spark, sf):
    """The place of each row in the order of the pool, without a window over everything."""
    return placed(t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus", "o_orderkey"])[0]


@query("""WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'CT' ELSE 'RGB' END AS m, CASE WHEN p_partkey % 3 = 0 THEN 'test' ELSE 'main' END AS part, p_size > 25 AS fail FROM part),
    s AS (SELECT *, CASE WHEN m = 'CT' THEN 'CT_cell_coin_7_w1_' || p_partkey ELSE 'RGB_cell_coin_7_' || p_partkey END AS stem FROM p)
    SELECT p_partkey, m || '/' || part || '/images/' || stem || '.jpg' AS image_path, m || '/' || part || '/labels_json/' || stem || '.json' AS label_json_path,
    CASE WHEN fail THEN m || '/' || part || '/augmentation_json/' || stem || '.augmentation.json' ELSE '' END AS augmentation_json_path FROM s""")
def manifest_paths(spark, sf):
    """Where the files of a sample lie."""
    k = F.col("p_partkey")
    source = F.when(k % 2 == 0, "CT_cell_coin_1_w1_2").otherwise("RGB_cell_coin_1_2")
    df = t(spark, sf, "part").select("p_partkey", "p_size", parse_stem(source).alias("s"))
    paths = M.output_paths(F.col("s.modality"), F.when(k % 3 == 0, "test").otherwise("main"), new_stem(F.col("s"), F.lit(7), k), F.col("p_size") > 25)
    return df.select("p_partkey", *paths)


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_totalprice / 20 - 100) END AS s FROM orders), r AS (SELECT *, round_even(s, 0)::BIGINT AS n FROM s)
    SELECT o_orderkey, CASE WHEN s IS NULL OR s < 0 THEN '계산 중' WHEN n >= 3600 THEN printf('%02d:%02d:%02d', n // 3600, n // 60 % 60, n % 60) ELSE printf('%02d:%02d', n // 60, n % 60) END AS duration FROM r""")
def durations(spark, sf):
    """F21."""
    s = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice") / 20 - 100)
    return t(spark, sf, "orders").select("o_orderkey", M.duration(s).alias("duration"))


@query("""SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name || ',"' || chr(10) || '가' END AS name FROM customer""")
def csv_round_trip(spark, sf):
    """A manifest written with a byte-order mark and read back, with quotes, line breaks and empty cells."""
    name = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat("c_name", F.lit(',"\n가')))
    df = t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), name.alias("name"))
    path = _folder(spark) / "customers.csv"
    write_csv(path, df.toLocalIterator(), ["id", "name"])
    return read_csv(spark, path, ["id", "name"])


@query(f"""WITH i AS (SELECT p_partkey, p_size, 'QF17_CT_' || lpad(p_partkey::VARCHAR, 8, '0') AS id, ['', 'ct_low_signal_noise', 'ct_acquisition_motion'][p_partkey % 3 + 1] AS c FROM part),
    s AS (SELECT *, ('0x' || substr(sha256('{SEED}|' || id), 1, 16))::UBIGINT AS item FROM i)
    SELECT p_partkey, item::VARCHAR AS item_seed, CASE WHEN c = '' THEN item::VARCHAR ELSE (('0x' || substr(sha256(item::VARCHAR || '|' || c), 1, 16))::UBIGINT)::VARCHAR END AS case_seed,
    CASE WHEN c = '' THEN '' ELSE (('0x' || substr(sha256('{SEED}|' || p_size || '|x|' || c), 1, 16))::UBIGINT)::VARCHAR END AS group_seed FROM s""")
def seed_hierarchy(spark, sf):
    """Item, case and group seeds."""
    k = F.col("p_partkey")
    case = F.element_at(F.array(*map(F.lit, ("", "ct_low_signal_noise", "ct_acquisition_motion"))), (k % 3 + 1).cast("int"))
    df = t(spark, sf, "part").select(k, "p_size", case.alias("c"), stable_seed_column(SEED, F.concat(F.lit("QF17_CT_"), F.lpad(k.cast("string"), 8, "0"))).alias("item"))
    own, group = stable_seed_column(F.col("item"), F.col("c")).cast("string"), stable_seed_column(SEED, F.col("p_size"), F.lit("x"), F.col("c")).cast("string")
    none = F.col("c") == ""
    return df.select("p_partkey", F.col("item").cast("string").alias("item_seed"), F.when(none, F.col("item").cast("string")).otherwise(own).alias("case_seed"), F.when(none, "").otherwise(group).alias("group_seed"))


@query("""WITH l AS (SELECT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS g, c_custkey, row_number() OVER (PARTITION BY CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END ORDER BY c_custkey) AS i FROM customer),
    r AS (SELECT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS g, c_name, row_number() OVER (PARTITION BY CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END ORDER BY c_name DESC) AS i FROM customer)
    SELECT l.g, c_custkey, c_name FROM l JOIN r ON l.g IS NOT DISTINCT FROM r.g AND l.i = r.i""")
def positional_join(spark, sf):
    """The i-th of one order with the i-th of another, by group; one group is null."""
    df = t(spark, sf, "customer").select(F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("g"), "c_custkey", "c_name")
    return A.exact_join(df.select("g", "c_custkey"), df.select("g", "c_name"), ["g"], ["c_custkey"], [F.desc("c_name")]).select("g", "c_custkey", "c_name")


def _slot_config(modality: str) -> dict:
    m = modality.lower()
    return {"seed": SEED, f"{m}_target": 40, f"{m}_augmented_target": 12, f"{m}_test_target": 10, f"{m}_test_fail_target": 4, f"{m}_failure_case_quotas": {"a": 5, "b": 4, "c": 3}}


def _slot_sql() -> str:
    """The slots by plain lists, shuffled as the contract says, as rows of SQL."""

    def shuffled(values, *parts):
        seed = int.from_bytes(hashlib.sha256("|".join(map(str, (SEED, *parts))).encode()).digest()[:8], "big")
        return [values[i] for i in np.random.Generator(np.random.PCG64(seed)).permutation(len(values))]

    rows = []
    for m in ("CT", "RGB"):
        fails = sorted(shuffled(list(range(40)), m, "assignment")[:12])
        case = dict(zip(fails, shuffled(["a"] * 5 + ["b"] * 4 + ["c"] * 3, m, "failure-cases"), strict=True))
        test = set(shuffled(list(fails), m, "test-fail")[:4] + shuffled([i for i in range(40) if i not in case], m, "test-pass")[:6])
        rows += [f"('{m}', {i}, {'true' if i in case else 'false'}, '{case.get(i, '')}', '{'test' if i in test else 'main'}')" for i in range(40)]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) s(modality, slot, fail, failure_case, partition)"


@query(_slot_sql())
def slot_deal(spark, sf):
    """Fails, cases and parts of the slots of a plan."""
    from marlspark.plans.planning import slots_of

    rows = []
    for m in ("CT", "RGB"):
        found = slots_of(_slot_config(m), m)
        rows += [(m, i, f, c, p) for i, (f, c, p) in enumerate(zip(found.fail, found.case, found.partition, strict=True))]
    return spark.createDataFrame(rows, "modality string, slot int, fail boolean, failure_case string, partition string")


@query("""WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'CT' ELSE 'RGB' END AS modality, CASE WHEN o_orderkey % 5 = 0 THEN 'fail' ELSE 'pass' END AS q FROM orders)
    SELECT modality, o_orderkey, q FROM m QUALIFY row_number() OVER (PARTITION BY modality, q ORDER BY o_orderkey) <= CASE WHEN q = 'fail' THEN 10 ELSE 90 END""")
def limited_plan(spark, sf):
    """The first rows of a plan, fails and passes in their shares, one after the other."""
    from marlspark.plans.generate import limited

    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select(F.when(k % 2 == 0, "CT").otherwise("RGB").alias("modality"), F.lpad(k.cast("string"), 9, "0").alias("synthetic_id"), F.when(k % 5 == 0, "fail").otherwise("pass").alias("quality_label"), k)
    config = {f"{m}_{n}": v for m in ("ct", "rgb") for n, v in (("augmented_target", 2000), ("target", 20000))}
    return limited(rows, config, 100).select("modality", "o_orderkey", F.col("quality_label").alias("q"))


@query("""SELECT p_mfgr, kind, second FROM (SELECT 'size' AS kind, p_size::VARCHAR AS p_mfgr, (list_sort(list(lpad(p_partkey::VARCHAR, 9, '0'))))[2] AS second FROM part GROUP BY p_size HAVING count(*) > 1
    UNION ALL SELECT 'brand', p_brand, (list_sort(list(lpad(p_partkey::VARCHAR, 9, '0'))))[2] FROM part GROUP BY p_brand HAVING count(*) > 1)""")
def shared_keys(spark, sf):
    """Keys that two rows share, of several kinds."""
    df = t(spark, sf, "part").withColumn("id", F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    parts = [R.duplicates(df, [F.col(c).cast("string")], "id").select(F.col("key0").alias("p_mfgr"), F.lit(kind).alias("kind"), "second") for c, kind in (("p_size", "size"), ("p_brand", "brand"))]
    return parts[0].unionByName(parts[1])


def _folder(spark: SparkSession) -> Path:
    """A new folder for files that a query makes: below spark.checkpoint.dir, or of this process in local mode."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and (root.startswith("file:") or "://" not in root):
        place = local(root) / f"files-{uuid.uuid4().hex}"
        place.mkdir(parents=True)
        return place
    return Path(tempfile.mkdtemp(prefix="marlspark-files-"))


def _write_tree(root: Path, count: int) -> None:
    """A raw tree of so many pairs of each modality."""
    for modality in ("CT", "RGB"):
        folders = [root / "Training" / f / modality for f in ("01.원천데이터", "02.라벨링데이터")]
        for f in folders:
            f.mkdir(parents=True)
        for k in range(count):
            stem = f"CT_cell_pouch_{k + 1}_x_{k + 1}" if modality == "CT" else f"RGB_cell_cylindrical_{k + 1}_{k + 1}"
            image = np.empty((100, 100, 3), np.uint8)
            image[:] = (25 + 5 * k,) * 3 if modality == "CT" else (80 + 8 * k, 130, 180)
            image[10:91, 10 + k : 12 + k] = image[10:91, 89:91] = image[10:12, 10 + k : 91] = image[89:91, 10 + k : 91] = 220
            (folders[0] / f"{stem}.png").write_bytes(codec.png_bytes(image))
            label = {"data_info": {"roi": [100, 100]} if modality == "CT" else {}, "swelling": {"battery_outline": [10, 10, 90, 10, 90, 90, 10, 90]}, "defects": [{"name": "porosity", "points": [30, 30, 50, 30, 50, 50, 30, 50]}], "image_info": {"file_name": f"{stem}.png"}}
            (folders[1] / f"{stem}.json").write_text(json.dumps(label), encoding="utf-8")


def _tree_config() -> dict:
    out = {"reserve_per_modality": 1, "resize_long_side": 64, "jpeg_quality": 90, "seed": SEED, "ct_porosity_threshold": 0.25, "ct_bbox_policy_version": "v1", "preflight_per_stratum": 0}
    for m, cases in (("ct", ("ct_cell_alignment_failure", "ct_low_signal_noise")), ("rgb", ("rgb_surface_dust", "rgb_hair_contamination"))):
        out |= {f"{m}_target": 4, f"{m}_augmented_target": 2, f"{m}_test_target": 2, f"{m}_test_fail_target": 1, f"{m}_failure_case_quotas": dict.fromkeys(cases, 1)}
        out |= {f"{m}_battery_id_start": 1900000001, f"{m}_battery_id_end": 1900100000, f"{m}_image_id_start": 2000000001}
    return out


@query("""SELECT m || '_' || q AS k, 2::BIGINT AS n FROM (VALUES ('CT'), ('RGB')) a(m), (VALUES ('pass'), ('fail')) b(q) UNION ALL SELECT 'faults', 0 UNION ALL SELECT 'plan_rows', 8 UNION ALL SELECT 'reserve_rows', 2 UNION ALL SELECT 'valid', 12""")
def data_set_of_a_tree(spark, sf):
    """A raw tree planned, generated and checked, in counts."""
    from marlspark.plans.generate import generate
    from marlspark.plans.planning import write_plan
    from marlspark.plans.verify import verify_rows

    place, config = _folder(spark), _tree_config()
    _write_tree(place / "raw", 6)
    plan = write_plan(spark, str(place / "raw"), config, str(place / "plan"))
    made = generate(spark, str(place / "raw"), config, place / "plan" / "manifests" / "generation_plan.csv", str(place / "set"), trust=True)
    valid = read_csv(spark, place / "plan" / "manifests" / "extraction_audit.csv", S.AUDIT_FIELDS).where("validation_status = 'valid'").count()
    rows = [*made["counts"].items(), ("faults", verify_rows(spark, str(place / "set")).count()), ("plan_rows", plan["plan_rows"]), ("reserve_rows", plan["reserve_rows"]), ("valid", valid)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())]))
