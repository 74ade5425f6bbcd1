"""Regions, rings and matrices, and the dealing of sources to slots, against plain versions."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marlspark.functions import geometry as G
from marlspark.functions import names as N
from marlspark.kernels import shapes
from marlspark.operators import assign as A
from marlspark.operators import relational as R
from tests.raw_tree import label_of

SQUARE = [10, 10, 50, 10, 50, 50, 10, 50]
PAIRS = [SQUARE[k : k + 2] for k in range(0, 8, 2)]
SMALL = [[0, 0], [4, 0], [4, 4]]


def test_encodings_of_rings():
    pairs = [[10, 10], [50, 10], [50, 50], [10, 50]]
    keyed = [{"x": x, "y": y} for x, y in pairs]
    want = [[(float(x), float(y)) for x, y in pairs]]
    assert G.rings_of(SQUARE) == G.rings_of(pairs) == G.rings_of(keyed) == want
    assert G.rings_of([pairs, keyed]) == G.rings_of([[pairs], [keyed]]) == want * 2
    assert G.rings_of(None) == G.rings_of([]) == []
    assert G.rings_of([[10, 10, 1], [50, 10, 2], [50, 50]]) == [[(10.0, 10.0), (50.0, 10.0), (50.0, 50.0)]]
    for bad in ([1, 2, 3, 4], [1, 2, 3, 4, 5, 6, 7], "x", [[]], [[], []], [{"x": 1}], [SQUARE, keyed], [[1, 2], "a"]):
        with pytest.raises(ValueError):
            G.rings_of(bad)


def test_clipping_keeps_what_is_inside():
    assert [G.ring_area(p) for p in G.clipped(G.rings_of(SQUARE)[0], (0, 0, 30, 100))] == [800]
    assert G.clipped(G.rings_of(SQUARE)[0], (60, 60, 70, 70)) == []
    cup = [0, 0, 10, 0, 10, 10, 8, 10, 8, 2, 2, 2, 2, 10, 0, 10]
    assert G.box_share(cup, (0, 5, 10, 10)) == (0.2, 2)
    assert G.box_share([PAIRS, SMALL], (0, 0, 100, 100)) == (0.4 * 0.4, 2)
    big, small = G.moved_rings([SMALL, PAIRS, [[0, 0], [1, 0], [1, 1]]], (1, 0, 0, 1, 0, 2), (0, 0, 100, 100))
    assert (G.ring_area(big), G.ring_area(small)) == (1600, 8)


def test_clipping_against_a_raster():
    """Stars and combs cut by a box: the area of the parts is that of the pixels, and each part is connected."""
    rng = np.random.default_rng(4)
    for k in range(30):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 12))
        far = rng.uniform(10, 50, 12) if k % 2 else np.where(np.arange(12) % 2, 12, 48)
        ring = [(50 + r * np.cos(t), 50 + r * np.sin(t)) for t, r in zip(turn, far, strict=True)]
        box = tuple(sorted(rng.uniform(0, 60, 2))) + tuple(sorted(rng.uniform(50, 100, 2)))
        box = (box[0], box[1], max(box[2], box[0] + 1), max(box[3], box[1] + 1))
        y, x = np.mgrid[0:800, 0:800] / 8 + 1 / 16
        inside = np.zeros(x.shape, bool)
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            inside ^= ((y0 <= y) != (y1 <= y)) & (x < x0 + (y - y0) * (x1 - x0) / (y1 - y0 if y1 != y0 else 1))
        inside &= (x >= box[0]) & (x <= box[2]) & (y >= box[1]) & (y <= box[3])
        parts = G.clipped(ring, box)
        assert abs(sum(map(G.ring_area, parts)) - inside.sum() / 64) < 8
        for p in parts:
            assert all(box[0] - 1e-9 <= u <= box[2] + 1e-9 and box[1] - 1e-9 <= v <= box[3] + 1e-9 for u, v in p)


def test_crossing_rings_are_repaired():
    one = shapes.repaired([(0, 0), (10, 10), (10, 0), (0, 10)])
    assert len(one) == 1 and shapes.ring_area(one[0]) == 25
    assert shapes.repaired([(0, 0), (5, 5), (9, 9)]) == [] and shapes.repaired([(0, 0), (4, 0), (4, 4), (4, 4), (0, 0)]) == [[(0, 0), (4, 0), (4, 4)]]
    with pytest.raises(ValueError, match="linearring"):
        shapes.repaired([(0, 0), (1, 1)])


def test_labels_are_rewritten_by_the_matrix():
    label = label_of("CT_cell_pouch_1_x_1.png", 1, "CT")
    got = shapes.rewritten(label, shapes.Matrix(0.5, 0, 0, 0.5, 5, 7), (50, 50), "CT", "fail", 1900000001, 2000000001, "out.jpg")
    assert got["quality_class"] == "fail" and got["data_info"] == {"battery_ids": 1900000001, "roi": [0, 0, 50, 50]}
    assert got["image_info"] == {"id": 2000000001, "file_name": "out.jpg", "width": 50, "height": 50} and "quality_class" not in label
    outline = got["swelling"]["battery_outline"]
    assert set(zip(outline[::2], outline[1::2], strict=True)) == {(10.0, 12.0), (50.0, 12.0), (50.0, 50.0), (10.0, 50.0)}
    keyed = {**label, "defects": [{"points": [{"x": 2, "y": 2}, {"x": 30, "y": 2}, {"x": 30, "y": 30}], "name": "a"}, {"points": [[900, 900], [901, 900], [901, 901]]}, {"points": None}]}
    assert shapes.rewritten(keyed, shapes.IDENTITY, (50, 50), "CT", "pass", 1, 2, "x")["defects"] == [{"points": [{"x": 2.0, "y": 2.0}, {"x": 30.0, "y": 2.0}, {"x": 30.0, "y": 30.0}], "name": "a"}]
    with pytest.raises(ValueError, match="quality_class conflict"):
        shapes.rewritten({**label, "quality_class": "pass"}, shapes.IDENTITY, (5, 5), "CT", "fail", 1, 2, "x")
    assert shapes.porosity_metric({"defects": [{"name": " Porosity", "points": SQUARE}, {"name": "x", "points": SQUARE}]}, (0, 0, 100, 100)) == (0.16000000000000003, 1)
    assert shapes.porosity_metric({"defects": None}, (0, 0, 1, 1)) == (0.0, 0) and shapes.coordinates([PAIRS, PAIRS])[4] == (10.0, 10.0)


def test_regions_of_labels():
    assert shapes.label_region({"data_info": {"roi": [5, 6]}}, 9, 9) == (0, 0, 5, 6)
    assert shapes.label_region({"data_info": {}, "image_info": {"roi": {"x": 1, "y": 2, "width": 3, "height": 4}}}, 9, 9) == (1, 2, 4, 6)
    for label, text in (({}, "missing"), ({"data_info": {"roi": [5, 6]}, "image_info": {"roi": [4, 6]}}, "Conflicting"), ({"data_info": {"roi": [5, 66]}}, "out of bounds"), ({"data_info": {"roi": [5]}}, "Unsupported ROI list"), ({"data_info": {"roi": {"x": 1}}}, "Unsupported ROI object")):
        with pytest.raises(ValueError, match=text):
            shapes.label_region(label, 9, 9)


def test_metric_column_keeps_faults_as_rows(spark):
    rows = [(json.dumps(SQUARE), 0), (None, 1), ("[1, 2]", 2), ("[", 3)]
    box = F.struct(*[F.lit(float(v)).alias(k) for k, v in zip("ltrb", (0, 0, 100, 100), strict=True)])
    got = spark.createDataFrame(rows, "p string, i int").select("i", G.box_metric("p", box).alias("m")).select("i", "m.*").orderBy("i").collect()
    assert [(r["share"], r["parts"]) for r in got] == [(0.4 * 0.4, 1), (0.0, 0), (None, None), (None, None)]
    assert [bool(r["error"]) for r in got] == [False, False, True, True]


def test_matrices(spark):
    m = G.composed(G.affine(2, 0, 0, 2, 1, 0), G.affine(0, -1, 1, 0, 0, 5))
    x, y = spark.range(1).select(G.moved(m, F.lit(3.0), F.lit(4.0)).alias("p")).first()["p"]
    assert (x, y) == (-8.0, 12.0)


def test_regions_conflict_or_fill_in(spark):
    rows = [("[5, 6]", None), ("[5, 6]", "[0, 0, 5, 6]"), ("[5, 6]", "[4, 6]"), (None, None), ("[5]", "[5, 6]")]
    both = spark.createDataFrame(rows, "a string, b string").select(*[G.roi_bounds(F.col(c), F.lit(9), F.lit(9)).alias(c) for c in "ab"])
    got = both.select(G.reconciled_roi(F.col("a"), F.col("b")).alias("r")).select("r.*").collect()
    assert [r["error"] for r in got] == ["", "", "conflict", "missing", "malformed"]
    assert got[0]["r"] == got[1]["r"] == 5.0 and got[2]["r"] is None
    odd = [('["a", 3]', "malformed", None), ('{"x":3,"width":5,"height":5}', "", 0.0), ('{"x":3,"y":1,"width":5,"height":5}', "", 3.0), ('["4", 3]', "", 0.0), ("nope", "malformed", None), ('{"x":"q","y":1,"width":5,"height":5}', "malformed", None)]
    got = spark.createDataFrame(odd, "v string, e string, l double").select("e", F.col("l").alias("want"), G.roi_bounds(F.col("v"), F.lit(9), F.lit(9)).alias("r")).collect()
    assert [(r["r"]["error"], r["r"]["l"]) for r in got] == [(r["e"], r["want"]) for r in got]


def test_rotation_and_rows(spark):
    m = shapes.turned(30, (3, 4))
    r = spark.range(1).select(G.rotation(F.lit(30.0), F.lit(3.0), F.lit(4.0)).alias("m")).select(G.matrix_rows(F.col("m")).alias("rows")).first()["rows"]
    assert np.allclose(r, m.rows()) and np.allclose(m.point(3, 4), (3, 4))
    both = shapes.composed(shapes.Matrix(2, 0, 0, 2, 1, 0), shapes.Matrix(0, -1, 1, 0, 0, 5))
    assert both.point(3, 4) == (-8.0, 12.0)


def test_names(spark):
    rows = [("CT_cell_coin_12_x_3",), ("CT_cell_pouch_12_w1_3",), ("RGB_cell_pouch_large_4_5",), ("CT_cell_a_b_1_2_z_٣",), ("RGB_cell__1",), (None,), ("CT_cell_pouch_1",)]
    got = [r["p"] for r in spark.createDataFrame(rows, "s string").select(N.parse_stem(F.col("s")).alias("p")).collect()]
    want = [("CT", "coin", "12", "x", "3"), ("CT", "pouch", "12", "w1", "3"), ("RGB", "pouch_large", "4", None, "5"), ("CT", "a_b_1", "2", "z", "٣"), (None,) * 5, (None,) * 5, (None,) * 5]
    assert [tuple(p) for p in got] == want
    paths = ["/r/Training/01.원천데이터/a.PNG", "/r/VALIDATION/training/02.라벨링데이터/b.json", "/r/x/원천데이터/라벨링데이터/c.tar.gz", "/q/x", "/r/a/../b", "/r/.hidden"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    p = F.col("p")
    got = df.select(N.split_of(p), N.kind_of(p), N.suffix(p), N.is_image(p), N.stem_of(p), N.contained(p, F.lit("/r/"))).collect()
    assert [tuple(r) for r in got] == [
        ("training", "image", "png", True, "a", "Training/01.원천데이터/a.PNG"), ("validation", "json", "json", False, "b", "VALIDATION/training/02.라벨링데이터/b.json"),
        (None, "image", "gz", False, "c.tar", "x/원천데이터/라벨링데이터/c.tar.gz"), (None, None, "", False, "x", None), (None, None, "", False, "b", None), (None, None, "", False, ".hidden", ".hidden"),
    ]


def test_relational_with_nulls_ties_and_repeats(spark):
    pairs = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 3), ("b", 1), ("b", 2), ("c", 1)], "k string, o int")
    got = {(r["key0"], r["n"], r["second"]) for r in R.duplicates(pairs, [F.col("k")], "o").collect()}
    assert got == {("a", 2, 1), (None, 2, 3), ("b", 2, 2)}
    wins = R.first_wins(pairs, ["k"], ["o"], "o").collect()
    assert len(wins) == 7 and sum(r["is_first"] for r in wins) == 4
    ids = {r["k"]: r["issued_id"] for r in R.dense_ids(spark.createDataFrame([("x", 5), ("y", None), (None, 2), ("x", 9), ("z", None)], "k string, o int"), ["k"], "o", 100).collect()}
    assert ids == {None: 100, "x": 101, "y": 102, "z": 103}
    with pytest.raises(ValueError, match="exhausted"):
        R.dense_ids(pairs, ["k"], "o", 100, most=102)
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, s int")
    cache = spark.createDataFrame([("a", 9, 0.9, 1), ("a", 1, 0.5, 2), ("b", 2, 0.1, 2), ("b", 8, 0.2, 3)], "k string, s int, v double, at int")
    got = {(r["k"], r["hit"], r["excluded"]) for r in R.cache_join(rows, cache, ["k"], ["s"], "v", 0.3, "at").collect()}
    assert got == {("a", True, True), ("b", False, False), (None, False, False)}
    runs = spark.createDataFrame([(k, r, n) for k, (r, n) in enumerate([("e", False), ("x", True), ("e", False), (None, False), ("e", False), ("f", False)])], "o int, r string, n boolean").withColumn("g", F.lit(1))
    got = R.error_runs(runs, F.col("r"), "o", ["g"], F.col("n")).orderBy("o").collect()
    assert [(r["consecutive"], r["cumulative"]) for r in got] == [(1, 1), (0, 0), (2, 2), (0, 0), (1, 3), (1, 1)]
    digest = R.ordered_digest(pairs.withColumn("_line", F.lit("q")), F.concat(F.coalesce("k", F.lit("")), F.lit("\n")), ["k", "o"])
    assert digest.first()[0] == hashlib.sha256(b"\n\na\na\nb\nb\nc\n").hexdigest()
    with pytest.raises(PySparkException):
        R.ordered_digest(pairs, F.lit("xxxx"), ["o"], limit=8).collect()


def test_greedy_and_exact_with_null_groups(spark):
    slots = spark.createDataFrame([(None, 1, False), ("a", 1, True)], "g string, s long, c boolean")
    pool = spark.createDataFrame([(None, 7, False), ("a", 8, False), ("a", 9, True)], "g string, r long, e boolean")
    got = A.greedy_picks(slots, pool, group="g", slot="s", constrained="c", rank="r", eligible="e")
    assert {(r["g"], r["r"]) for r in got.collect()} == {(None, 7), ("a", 9)}
    a, b = spark.createDataFrame([(None, 1), ("g", 2)], "g string, x int"), spark.createDataFrame([("g", "q"), (None, "p")], "g string, y string")
    assert {(r["g"], r["x"], r["y"]) for r in A.exact_join(a, b, ["g"], ["x"], ["y"]).collect()} == {(None, 1, "p"), ("g", 2, "q")}
    picks = A.eligible_picks(["", "dense", "", "dense"], {"dense": [False, True, False, True, True]}, 5, {"dense": "none left"})
    assert picks == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="none left"):
        A.eligible_picks(["dense"] * 2, {"dense": [True, False]}, 2, {"dense": "none left"})

def test_greedy_picks_as_slot_by_slot(spark):
    rng = np.random.default_rng(1)
    slots = [(g, i, bool(rng.random() < 0.4)) for g in "ab" for i in range(40)]
    pool = [(g, i, bool(rng.random() < 0.3)) for g in "ab" for i in range(60 if g == "a" else 25)]
    want = {}
    for g in "ab":
        left = [(i, e) for h, i, e in pool if h == g]
        for h, i, need in slots:
            if h == g:
                found = next((p for p in left if p[1] or not need), None)
                want[g, i] = found and found[0]
                if found:
                    left.remove(found)
    got = A.greedy_picks(spark.createDataFrame(slots, "g string, s long, c boolean"), spark.createDataFrame(pool, "g string, r long, e boolean"), group="g", slot="s", constrained="c", rank="r", eligible="e")
    assert {(r["g"], r["s"]): r["r"] for r in got.collect()} == want


def test_positional_join_and_quotas(spark):
    a, b = spark.createDataFrame([(2,), (1,)], "x int"), spark.createDataFrame([("p",), ("q",)], "y string")
    assert sorted(map(tuple, A.exact_join(a, b, [], ["x"], ["y"]).collect())) == [(1, "p"), (2, "q")]
    with pytest.raises(PySparkException):
        A.exact_join(a, b.limit(1), [], ["x"], ["y"]).collect()
    assert A.quota_cases([("m", 2), ("n", 1)]) == ["m", "m", "n"]
    A.checked_quotas([("m", 2), ("n", 1)], ["m", "n"], 3)
    for bad in ([("z", 3)], [("m", 1), ("m", 2)], [("m", 4), ("n", -1)], [("m", 1)]):
        with pytest.raises(ValueError):
            A.checked_quotas(bad, ["m", "n"], 3)
