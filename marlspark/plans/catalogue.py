"""Queries over the driver's tables, one for each family of operators, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.functions import geometry as G
from marlspark.functions import names as N
from marlspark.functions.names import new_stem, parse_stem
from marlspark.functions.seeds import permutation_table, stable_seed, stable_seed_column
from marlspark.operators import assign as A
from marlspark.operators import images as I
from marlspark.operators import measures as M
from marlspark.operators import relational as R
from marlspark.plans import scan as S
from marlspark.sources.store import placed

SEED = 20260723
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("""WITH i AS (SELECT doc_id, count(*) images, min(source) source FROM documents WHERE doc_id % 7 <> 0 GROUP BY 1),
    j AS (SELECT doc_id, count(*) jsons, min(quality) quality FROM labels GROUP BY 1)
    SELECT coalesce(i.doc_id, j.doc_id) AS doc_id, coalesce(images, 0) AS images, source, coalesce(jsons, 0) AS jsons, quality,
    CASE WHEN images > 1 OR jsons > 1 THEN 'ambiguous' WHEN j.doc_id IS NULL THEN 'image_only' WHEN i.doc_id IS NULL THEN 'json_only' ELSE 'pair' END AS status
    FROM i FULL JOIN j ON i.doc_id = j.doc_id""")
def pair_status(spark, sf):
    """Assets (one side lacks ids divisible by 7, which is what makes orphans) and their labels."""
    return R.pair_status(t(spark, sf, "documents").where("doc_id % 7 <> 0"), t(spark, sf, "labels"), ["doc_id"], "source", "quality")


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN lang END AS lang, source, text FROM documents)
    SELECT doc_id, lang, source, first_value(doc_id) OVER w AS winner, row_number() OVER w = 1 AS is_first FROM d
    WINDOW w AS (PARTITION BY lang, sha256(text) ORDER BY source, doc_id)""")
def pixel_dedup(spark, sf):
    """The first of each (lang, content) by source and id wins; some rows have no lang, which is a group."""
    lang = F.when(F.col("doc_id") % 11 != 0, F.col("lang"))
    docs = t(spark, sf, "documents").select("doc_id", lang.alias("lang"), "source", F.sha2("text", 256).alias("sha"))
    return R.first_wins(docs, ["lang", "sha"], ["source", "doc_id"], "doc_id").select("doc_id", "lang", "source", "winner", "is_first")



@query("""WITH e AS (SELECT event_id, user_id, event_id % 7 = 0 AS neutral, CASE WHEN event_id % 7 <> 0 AND event_type NOT IN ('view', 'click') THEN event_type END AS reason FROM events),
    b AS (SELECT *, CASE WHEN reason IS NULL OR reason IS DISTINCT FROM lag(reason) OVER (PARTITION BY user_id % 64, neutral ORDER BY event_id) THEN 1 ELSE 0 END AS brk FROM e),
    s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id % 64, neutral ORDER BY event_id) AS island FROM b)
    SELECT event_id, reason, CASE WHEN reason IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY user_id % 64, neutral, island ORDER BY event_id) END AS consecutive,
    CASE WHEN reason IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY user_id % 64, reason ORDER BY event_id) END AS cumulative FROM s""")
def error_runs(spark, sf):
    """Runs and running counts of reasons, by stratum of users; every seventh row is neutral, as keys without a pair are."""
    events = t(spark, sf, "events").withColumn("stratum", F.col("user_id") % 64)
    reason = F.when(~F.col("event_type").isin("view", "click"), F.col("event_type"))
    return R.error_runs(events, reason, "event_id", ["stratum"], F.col("event_id") % 7 == 0).select("event_id", "reason", "consecutive", "cumulative")



@query("""SELECT lang, source, count(*) AS n, sum(CASE WHEN n_chars < 200 THEN 1 ELSE 0 END)::BIGINT AS short
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 25 GROUP BY ALL""")
def preflight_strata(spark, sf):
    """The first 25 of each stratum, then counts."""
    return R.first_n(t(spark, sf, "documents"), ["lang", "source"], ["doc_id"], 25).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") < 200).alias("short"))


@query("""WITH k AS (SELECT CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS key, CASE WHEN o_custkey % 50 <> 1 THEN o_orderkey END AS seen FROM orders)
    SELECT key, min(seen) AS first, 5000 + row_number() OVER (ORDER BY min(seen) IS NULL, min(seen), key NULLS FIRST) - 1 AS issued_id FROM k GROUP BY key""")
def battery_ids(spark, sf):
    """Dense ids in the order in which keys are first seen; null is a key, and keys without an order come last."""
    orders = t(spark, sf, "orders").select(F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("key"), F.when(F.col("o_custkey") % 50 != 1, F.col("o_orderkey")).alias("seen"))
    return R.dense_ids(orders, ["key"], "seen", 5000)



@query(f"SELECT c_custkey, (('0x' || substr(sha256('{SEED}|' || c_mktsegment || '|' || c_custkey), 1, 16))::UBIGINT)::VARCHAR AS seed FROM customer")
def stable_seeds(spark, sf):
    """F1, R6."""
    return t(spark, sf, "customer").select("c_custkey", stable_seed_column(SEED, F.col("c_mktsegment"), F.col("c_custkey")).cast("string").alias("seed"))


@query("""WITH l AS (SELECT s_name AS name, s_nationkey || '|' || s_name || chr(10) AS line FROM supplier UNION ALL SELECT p_name || p_partkey, p_brand || '|' || p_name || '|' || p_partkey || chr(10) FROM part)
    SELECT sha256(string_agg(line, '' ORDER BY name, line)) AS fingerprint FROM l""")
def raw_fingerprint(spark, sf):
    """Digest of an ordered listing of two tables."""
    text = lambda *c: F.concat_ws("|", *c)
    s = t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.concat(text("s_nationkey", "s_name"), F.lit("\n")).alias("line"))
    p = t(spark, sf, "part").select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"), F.concat(text("p_brand", "p_name", "p_partkey"), F.lit("\n")).alias("line"))
    return R.ordered_digest(s.unionByName(p), F.col("line"), ["name", "line"])



@query("""SELECT o_orderstatus, o_orderpriority, GROUPING(o_orderstatus, o_orderpriority)::BIGINT AS level, count(*) AS n FROM orders
    GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority), (o_orderpriority))""")
def contract_counts(spark, sf):
    """A7."""
    return R.contract_counts(t(spark, sf, "orders"), [["o_orderstatus"], ["o_orderstatus", "o_orderpriority"], ["o_orderpriority"]])


@query("""SELECT coalesce(a.s, e.s) AS o_orderstatus, a.n AS actual, e.n AS expected FROM (SELECT o_orderstatus s, count(*) n FROM orders GROUP BY 1) a
    FULL JOIN (VALUES ('F', 0::BIGINT), ('X', 3::BIGINT)) e(s, n) ON a.s = e.s WHERE a.n IS DISTINCT FROM e.n""")
def contract_diff(spark, sf):
    """Counts against expected ones."""
    actual = t(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return R.contract_diff(actual, spark.createDataFrame([("F", 0), ("X", 3)], "o_orderstatus string, n bigint"), ["o_orderstatus"])


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    p AS (SELECT vec_id, list_transform(range(0, len(e) - 1, 2), lambda i: e[i + 1]) AS xs, list_transform(range(0, len(e) - 1, 2), lambda i: e[i + 2]) AS ys FROM v)
    SELECT vec_id, round((list_max(xs) - list_min(xs)) / 8 * ((list_max(ys) - list_min(ys)) / 4), 6) AS share, len(xs)::INTEGER AS points FROM p""")
def bbox_metric(spark, sf):
    """A4: the share of a frame of 8 by 4 that the bounds of interleaved coordinates cover."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    even = lambda k: F.expr(f"transform(sequence(0, size(e) - 2, 2), i -> e[i + {k}])")
    df = t(spark, sf, "embeddings").select("vec_id", e.alias("e")).select("vec_id", even(0).alias("x"), even(1).alias("y"))
    return df.select("vec_id", F.round(M.extent(F.col("x"), F.col("y"), F.lit(8.0), F.lit(4.0)), 6).alias("share"), F.size("x").alias("points"))



@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity AS u, l_discount * 100 AS v FROM lineitem),
    m AS (SELECT *, 2 * u - 0.5 * v + 3 AS x1, 0.5 * u + 2 * v - 1 AS y1 FROM p)
    SELECT l_orderkey, l_linenumber, round(-(y1 - 4) + 7, 5) AS x, round((x1 - 7) + 4, 5) AS y FROM m""")
def affine_points(spark, sf):
    """A matrix, then a quarter turn about (7, 4), composed and applied to every point."""
    m = G.composed(G.affine(2, -0.5, 0.5, 2, 3, -1), G.rotation(F.lit(90.0), F.lit(7.0), F.lit(4.0)))
    p = G.moved(m, F.col("l_quantity"), F.col("l_discount") * 100)
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(p["x"], 5).alias("x"), F.round(p["y"], 5).alias("y"))



@query("""SELECT vec_id, round(len(list_filter(list_zip(embedding, range(len(embedding))), lambda z: z[1] > 0 AND z[2] % 3 <> 0))::DOUBLE
    / greatest(len(list_filter(range(len(embedding)), lambda i: i % 3 <> 0)), 1), 6) AS ratio FROM embeddings""")
def retention_ratio(spark, sf):
    """Of the places of a region those where a mask is set."""
    part = F.transform("embedding", lambda x: x > 0)
    region = F.transform("embedding", lambda x, i: i % 3 != 0)
    return t(spark, sf, "embeddings").select("vec_id", F.round(M.share_of(part, region), 6).alias("ratio"))



@query("""SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS mean, round(stddev_pop(l_quantity), 6) AS std, median(l_quantity) AS median,
    round(quantile_cont(l_quantity, 0.99), 6) AS quantile, max(l_quantity) - min(l_quantity) AS range, stddev_pop(l_quantity) >= 0.25 AS passes FROM lineitem GROUP BY 1, 2""")
def gate_stats(spark, sf):
    """A13, G3."""
    found = M.pixel_stats(t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return found.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 6), "quantile": F.round("quantile", 6)})



@query("""WITH a AS (SELECT label, unnest(embedding)::DOUBLE * 1000 AS turn FROM embeddings), b AS (SELECT label, (turn % 360 + 360) % 360 AS angle FROM a),
    g AS (SELECT label, (coalesce(lead(angle) OVER w, first_value(angle) OVER w) - angle + 360) % 360 AS gap FROM b WINDOW w AS (PARTITION BY label ORDER BY angle))
    SELECT label, round(max(gap), 5) AS max_gap FROM g GROUP BY label""")
def circular_gap(spark, sf):
    """Over all coordinates of all vectors of a label."""
    angles = t(spark, sf, "embeddings").select("label", F.explode("embedding").alias("e")).select("label", (F.col("e").cast("double") * 1000).alias("angle"))
    return M.circular_gap(angles, ["label"], "angle").withColumn("max_gap", F.round("max_gap", 5))



@query("""WITH f AS (SELECT p_partkey, p_size, ['pouch', 'coin', 'pouch_large', 'a_1'][p_partkey % 4 + 1] AS form, ['x', 'w1', 'z'][p_partkey % 3 + 1] AS axis FROM part)
    SELECT p_partkey, CASE p_partkey % 5 WHEN 4 THEN NULL WHEN 3 THEN NULL WHEN 2 THEN 'RGB' ELSE 'CT' END AS modality, CASE WHEN p_partkey % 5 < 3 THEN form END AS form,
    CASE WHEN p_partkey % 5 < 3 THEN p_size::VARCHAR END AS battery_id, CASE WHEN p_partkey % 5 < 2 THEN axis END AS axis,
    CASE p_partkey % 5 WHEN 4 THEN NULL WHEN 3 THEN NULL WHEN 2 THEN 'RGB_cell_' || form || '_' || (90000 + p_size) || '_' || (p_partkey + 7)
    ELSE 'CT_cell_' || form || '_' || (90000 + p_size) || '_' || axis || '_' || (p_partkey + 7) END AS stem FROM f""")
def stem_parse(spark, sf):
    """Stems of many forms and axes, parsed and issued anew; a fifth is no stem and a fifth is null."""
    k, b, one = F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), F.col("p_partkey")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (one % len(values) + 1).cast("int"))
    form, axis = pick(["pouch", "coin", "pouch_large", "a_1"]), pick(["x", "w1", "z"])
    ct, rgb = F.concat_ws("_", F.lit("CT_cell"), form, b, axis, k), F.concat_ws("_", F.lit("RGB_cell"), form, b, k)
    stem = F.when(one % 5 < 2, ct).when(one % 5 == 2, rgb).when(one % 5 == 3, F.concat(F.lit("CT_cell_"), form))
    df = t(spark, sf, "part").select("p_partkey", "p_size", parse_stem(stem).alias("s"))
    return df.select("p_partkey", "s.modality", "s.form", "s.battery_id", "s.axis", new_stem(F.col("s"), F.lit(90000) + F.col("p_size"), F.col("p_partkey") + 7).alias("stem"))



@query("""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Training/01.원천데이터/' WHEN 1 THEN 'x/VALIDATION/02.라벨링데이터/' WHEN 2 THEN 'training/원천데이터/라벨링데이터/' ELSE '../x/' END
        || page_id || CASE page_id % 3 WHEN 0 THEN '.PNG' WHEN 1 THEN '.json' ELSE '.tar.gz' END AS relative FROM pages)
    SELECT page_id, CASE page_id % 4 WHEN 1 THEN 'validation' WHEN 3 THEN NULL ELSE 'training' END AS split, CASE page_id % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'json' WHEN 2 THEN 'image' END AS kind,
    CASE page_id % 3 WHEN 0 THEN 'png' WHEN 1 THEN 'json' ELSE 'gz' END AS suffix, page_id % 3 = 0 AS is_image, page_id || CASE page_id % 3 WHEN 2 THEN '.tar' ELSE '' END AS stem,
    CASE WHEN page_id % 4 <> 3 THEN relative END AS relative FROM p""")
def path_split(spark, sf):
    """Split, kind, suffix, stem and contained path of files of a tree; a quarter climbs out of it."""
    one = F.col("page_id")
    folder = F.when(one % 4 == 0, "Training/01.원천데이터/").when(one % 4 == 1, "x/VALIDATION/02.라벨링데이터/").when(one % 4 == 2, "training/원천데이터/라벨링데이터/").otherwise("../x/")
    end = F.when(one % 3 == 0, ".PNG").when(one % 3 == 1, ".json").otherwise(".tar.gz")
    path = F.concat(F.lit("/raw/"), folder, one.cast("string"), end)
    df = t(spark, sf, "pages").select("page_id", path.alias("p"))
    p = F.col("p")
    return df.select("page_id", N.split_of(p).alias("split"), N.kind_of(p).alias("kind"), N.suffix(p).alias("suffix"), N.is_image(p).alias("is_image"), N.stem_of(p).alias("stem"), N.contained(p, F.lit("/raw")).alias("relative"))



@query("""WITH c AS (SELECT doc_id, source, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents)
    SELECT d.doc_id, coalesce(c.n_chars = d.n_chars AND d.doc_id % 6 <> 0, false) AS hit, coalesce(c.n_chars = d.n_chars AND d.doc_id % 6 <> 0 AND c.n_chars >= 1000, false) AS excluded
    FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id""")
def cache_hits(spark, sf):
    """A cache in which every fifth signature is stale and every sixth key comes twice, its last line stale; the threshold is applied anew to hits."""
    docs = t(spark, sf, "documents").select("doc_id", "source", "n_chars")
    cache = docs.withColumn("n_chars", F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))).withColumn("line", F.lit(1))
    later = cache.where("doc_id % 6 = 0").withColumns({"n_chars": F.lit(-1).cast("long"), "line": F.lit(2)})
    return R.cache_join(docs, cache.unionByName(later), ["doc_id"], ["source", "n_chars"], "n_chars", 1000, "line").select("doc_id", "hit", "excluded")



@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 3)")
def resume_tasks(spark, sf):
    """Tasks that are not committed."""
    done = t(spark, sf, "lineitem").where("l_linenumber > 3").select(F.col("l_orderkey").alias("o_orderkey"))
    return M.pending(t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), done, ["o_orderkey"])



@query("""SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1) AND p_partkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_linenumber = 1)""")
def orphan_outputs(spark, sf):
    """Files that no path column of the manifest names."""
    return M.unreferenced(t(spark, sf, "part").select("p_partkey"), t(spark, sf, "lineitem").where("l_linenumber = 1"), "p_partkey", ["l_partkey", "l_suppkey"])



@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW'))""")
def drop_cases(spark, sf):
    """Manifest rows of some cases go, and the lineage rows with their ids."""
    manifest = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return M.dropped(manifest, t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "o_orderpriority", ["1-URGENT", "5-LOW"])[1]



@query("""SELECT o_orderstatus, o_orderkey, rank FROM (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rank FROM orders)
    WHERE rank <= CASE WHEN o_orderstatus = 'F' THEN round_even(100 * 0.125, 0) ELSE 100 - round_even(100 * 0.125, 0) END""")
def limit_per_group(spark, sf):
    """O3: a limit dealt to groups with half-even rounding."""
    bound = F.when(F.col("o_orderstatus") == "F", F.bround(F.lit(12.5))).otherwise(F.lit(100) - F.bround(F.lit(12.5)))
    return R.first_n(t(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], ["o_orderkey"], bound)


@query(f"""WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY sha256('{SEED}|' || o_orderkey)) AS rank FROM orders)
    SELECT o_orderkey, o_orderstatus, CASE WHEN rank <= 50 THEN 'test' ELSE 'main' END AS partition FROM r""")
def split_sets(spark, sf):
    """R5, U1, U2 by ranks of hashes; the exact PCG64 order is in pcg_sample."""
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.sha2(F.concat(F.lit(f"{SEED}|"), F.col("o_orderkey").cast("string")), 256).alias("h"))
    test = R.first_n(orders, ["o_orderstatus"], ["h"], 50).select("o_orderkey", "o_orderstatus").withColumn("partition", F.lit("test"))
    main = orders.join(test.select("o_orderkey"), "o_orderkey", "left_anti").select("o_orderkey", "o_orderstatus").withColumn("partition", F.lit("main"))
    return test.unionByName(main)


@query("""WITH d AS (SELECT CASE WHEN doc_id % 13 <> 0 THEN sha256(text) END AS key0, doc_id // 2 AS pos FROM documents)
    SELECT key0, count(*) AS n, (list_sort(list(pos)))[2] AS second FROM d GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    """Null is a key too, and rows tie in the order."""
    docs = t(spark, sf, "documents").select(F.when(F.col("doc_id") % 13 != 0, F.sha2("text", 256)).alias("sha"), F.expr("doc_id DIV 2").alias("at"))
    return R.duplicates(docs, [F.col("sha")], "at")



@query("""SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1""")
def top_components(spark, sf):
    """The largest of each group."""
    return M.largest(t(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], "p_retailprice", "p_partkey")



@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'ValueError: JSON top level must be an object' WHEN event_id % 4 = 2 THEN 'ValueError: missing top-level field: defects'
    WHEN json_extract_string(props, '$.k') IS NULL THEN 'ValueError: missing top-level field: k' ELSE '' END AS error FROM events""")
def label_json(spark, sf):
    """Required fields of labels; the first error is a column, rows are not lost."""
    one = F.col("event_id") % 4
    text = F.when(one == 3, F.lit("[1]")).when(one == 2, F.col("props")).otherwise(F.concat(F.lit('{"defects": [], '), F.substring("props", 2, 1 << 20)))
    return t(spark, sf, "events").select("event_id", M.first_missing(text, ["defects", "k"]).alias("error"))



@query("""SELECT conv_id, string_agg(role, '|' ORDER BY turn) AS types, list_has_any(list(role), ['system', 'tool']) AS special FROM conversations GROUP BY conv_id""")
def record_types(spark, sf):
    """P16, U3."""
    return M.record_types(t(spark, sf, "conversations"), ["conv_id"], "turn", "role", ["system", "tool"])



@query()
def pcg_sample(spark, sf):
    """The pool in order, and the first 1000 ranks (target and reserve) of its PCG64 permutation; SQL has no PCG64, tests have golden values."""
    pool, n = placed(t(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), ["o_orderstatus", "o_orderkey"])
    return pool.join(permutation_table(spark, n, stable_seed(SEED, "CT", "extract"), 1000), "place")



@query("""WITH k AS (SELECT p_partkey, p_size::DOUBLE AS s, p_partkey % 4 AS kind FROM part),
    c AS (SELECT p_partkey, kind, CASE kind WHEN 0 THEN 0.0::DOUBLE ELSE 1.0 END AS l, CASE kind WHEN 0 THEN 0.0::DOUBLE ELSE 2.0 END AS t,
    CASE kind WHEN 2 THEN s + 1 ELSE s END AS r, CASE kind WHEN 0 THEN 30.0::DOUBLE WHEN 1 THEN 40.0 ELSE 7.0 END AS b FROM k),
    e AS (SELECT *, CASE WHEN kind = 3 THEN 'missing' WHEN r > 40 OR l >= r THEN 'out of bounds' ELSE '' END AS error FROM c)
    SELECT p_partkey, CASE WHEN error = '' THEN l END AS l, CASE WHEN error = '' THEN t END AS t, CASE WHEN error = '' THEN r END AS r, CASE WHEN error = '' THEN b END AS b, error FROM e""")
def roi_bounds(spark, sf):
    """regions in three encodings, in a frame of 40 by 40; a fourth of the rows has none."""
    size = F.col("p_size").cast("string")
    value = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("["), size, F.lit(", 30]"))).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("[1, 2, "), size, F.lit(", 40]")))
    value = value.when(F.col("p_partkey") % 4 == 2, F.concat(F.lit('{"x": 1, "y": 2, "width": '), size, F.lit(', "height": 5}')))
    return t(spark, sf, "part").select("p_partkey", G.roi_bounds(value, F.lit(40), F.lit(40)).alias("roi")).select("p_partkey", "roi.*")


@query("""WITH f AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i FROM orders WHERE o_orderstatus = 'F'),
    r AS (SELECT o_orderpriority, o_custkey, o_orderkey AS rank, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i FROM orders
    WHERE o_orderstatus = 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
    SELECT f.o_orderpriority, f.o_orderkey, r.rank, r.o_custkey FROM f LEFT JOIN r ON f.o_orderpriority = r.o_orderpriority AND f.i = r.i""")
def reserve_substitutes(spark, sf):
    """Each failed slot takes the next row of the reserve that is not consumed."""
    orders = t(spark, sf, "orders")
    reserve = orders.where("o_orderstatus = 'P'").select("o_orderpriority", F.col("o_orderkey").alias("rank"), "o_custkey")
    consumed = t(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    failed = orders.where("o_orderstatus = 'F'")
    return A.substitutes(failed, reserve, consumed, group="o_orderpriority", slot="o_orderkey", rank="rank", key=["o_custkey"])


@query()
def greedy_picks(spark, sf):
    """Slots of a status with the eligible pick; every fifth slot is constrained, every third source eligible."""
    orders = t(spark, sf, "orders").select("o_orderstatus", "o_orderkey")
    slots = orders.where("o_orderkey % 2 = 0").withColumn("constrained", F.col("o_orderkey") % 5 == 0)
    pool = orders.where("o_orderkey % 2 = 1").select("o_orderstatus", F.col("o_orderkey").alias("rank"), (F.col("o_orderkey") % 3 == 0).alias("eligible"))
    return A.greedy_picks(slots, pool, group="o_orderstatus", slot="o_orderkey", constrained="constrained", rank="rank", eligible="eligible")
