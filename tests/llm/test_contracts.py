"""Every query against a brute-force version of its contract, on the small tables and on the odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marlspark.llm import fingerprint, host_rules, lm_score, mixing, near_dedup, packing, quality_rank, queries, sharding, suffix_dedup, token_counts

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
VOCAB = queries.tokenizer_file("piece_bpe_32k.model")
BPE = queries.tokenizer_file("byte_bpe_50k.json")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def tables(request):
    return [request.getfixturevalue("docs"), request.getfixturevalue("odd"), request.getfixturevalue("empty")]


@pytest.fixture(params=["docs", "odd", "empty"])
def table(request):
    return request.getfixturevalue(request.param)


def test_op1_base_and_counts(table):
    held = F.coalesce(queries.id_mod(7) == 2, F.lit(False))
    got = lm_score.score_texts(table, learn=~held, vocab_path=VOCAB, classes="lang", keep={"doc_id": F.col("doc_id"), "text": F.col("text")}, head=50).toPandas()
    rows = rows_of(table, "doc_id", "text")
    assert len(got) == len(rows)
    counts = collections.Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*re.findall(WORD, lower(t)), " "])
    n, v = sum(counts.values()), len(counts)
    for r in got.itertuples():
        words = [*re.findall(WORD, lower(r.text if isinstance(r.text, str) else "")), " "]
        assert r.n_tokens == len(words) and r.n_known == sum(counts[w] > 0 for w in words) and r.train_tokens == n
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_op1_forward_is_the_sum_over_segmentations(monkeypatch):
    pieces = [b" ", b" a", b"a", b"b", b"ab", b"ba", b"aba"]
    scores = np.log(np.array([0.1, 0.15, 0.2, 0.1, 0.15, 0.1, 0.05]))
    lattice = lm_score.Lattice(pieces, scores)

    def brute(word):
        if not word:
            return 1.0
        return sum(math.exp(scores[i]) * brute(word[len(p) :]) for i, p in enumerate(pieces) if word.startswith(p))

    words = [b"a", b"ab", b"ababa", b"bbabab", b""]
    for word, got in zip(words, lattice.forward_all(words), strict=True):
        assert math.isclose(got, math.log(brute(b" " + word)), rel_tol=1e-9)
    long = [b"ab" * 90, b"ab" * 3000, b"ab" * 2000]
    short = lattice.forward_all(long)
    monkeypatch.setattr(lm_score.Lattice, "LONG", 10**9)
    assert np.allclose(lattice.forward_all(long[:1]), short[:1]) and np.isfinite(short).all() and short[1] < short[2]


def test_op1_the_vocabularys_scores_weigh_the_lattice():
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=VOCAB)
    pieces, scores, stop = lm_score.lattice_pieces(VOCAB)
    v = lm_score.vocabulary(VOCAB)
    where = {p: i for i, p in enumerate(pieces)}
    for a, b in (("▁t", "in"), ("▁the", "er"), ("ing", "▁a")):
        i, j = v.pieces.index(a), v.pieces.index(b)
        x, y = (scores[where[p.replace("▁", " ").encode()]] for p in (a, b))
        assert math.isclose(x - y, v.logp[i] - v.logp[j], rel_tol=1e-9)
        assert math.isclose(v.logp[i] - v.logp[j], math.log(file.get_score(j) / file.get_score(i)), rel_tol=1e-9)  # ranks
    assert math.isclose(np.exp(scores).sum(), 1, rel_tol=1e-9) and stop < 0


def test_op1_words_sum_to_one():
    import itertools

    pieces = [b" ", b" a", b"a", b"b", b"ab"]
    share = np.array([0.2, 0.1, 0.3, 0.3, 0.1])
    lattice, model = lm_score.Lattice(pieces, np.log(share)), lm_score.Model([10, 0], [3, 0], 3)
    counts = {b"a": [5, 0], b"ab": [2, 0], b"b": [3, 0]}
    words = [bytes(w) for k in range(13) for w in itertools.product(b"ab", repeat=k)]
    spelled = lattice.forward_all(words)
    total = np.exp(model.words(np.array([counts.get(w, [0, 0]) for w in words], float), spelled)).sum(0)
    assert (total > 0.9).all() and (total <= 1 + 1e-9).all()


def brute_scores(rows, learn, classes, learned=True):
    """Scores of whole texts from counts and the lattice, without the operator's tables."""
    pieces, scores, stop = lm_score.lattice_pieces(VOCAB)
    lattice = lm_score.Lattice(pieces, scores)
    named = [c for c, _ in sorted(collections.Counter(c for c, x in zip(classes, learn, strict=True) if x).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))] or [None]
    counts = [collections.Counter() for _ in named]
    split = [[*re.findall(WORD, lower(t)), " "] for t in rows]
    for words, c, x in zip(split, classes, learn, strict=True):
        if x:
            counts[named.index(c)].update(words)
    n, v = [sum(c.values()) for c in counts], [len(c) for c in counts]
    everywhere = sum(counts, collections.Counter())
    total, types, found = sum(n), len(everywhere), {}

    def word(w):
        if w not in found:
            own = math.exp(stop if w == " " else lattice.forward_all([w.encode()])[0])
            if not learned or not total:
                found[w] = [own] * len(n)
            else:
                whole = max(everywhere[w] - 0.7, 0) / total + 0.7 * types / total * own
                found[w] = [max(c[w] - 0.7, 0) / max(a, 1) + (0.7 * b / a if a else 1) * (0.2 * whole + 0.8 * own) for c, a, b in zip(counts, n, v, strict=True)]
        return found[w]

    out = []
    for words in split:
        each = [math.log((a + 1) / (total + len(n))) + sum(math.log(word(w)[j]) for w in words) for j, a in enumerate(n)]
        out.append((max(each) + math.log(sum(math.exp(x - max(each)) for x in each))) / math.log(10))
    return out


@pytest.mark.parametrize("learned", [True, False])
def test_op1_scores_of_whole_texts(spark, docs, learned):
    """Brute force, and the same for inputs whose rows have no fixed place."""
    rows = docs.select("doc_id", "text", "lang").collect()
    rows = [*rows, *rows[:3], *rows[:1]]
    learn = [zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in rows]
    want = collections.defaultdict(list)
    for r, x in zip(rows, brute_scores([r.text for r in rows], learn, [r.lang for r in rows], learned), strict=True):
        want[r.doc_id].append(x)
    frame = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang").schema)
    for table in (frame.repartition(5), frame.join(frame.select("doc_id").distinct(), "doc_id")):
        got = collections.defaultdict(list)
        for r in lm_score.score_texts(table, learn=queries.id_mod(7) != 2, vocab_path=VOCAB, classes="lang", keep={"doc_id": F.col("doc_id")}, head=200, learned=learned).collect():
            got[r.doc_id].append(r.score)
        assert {i: len(x) for i, x in got.items()} == {i: len(x) for i, x in want.items()}
        assert all(np.allclose(sorted(got[i]), sorted(want[i]), rtol=1e-9) for i in want)


def test_op2_edits_and_neighbours(table):
    got = fingerprint.edit_report(table)
    rows = sorted(rows_of(table, "doc_id", "text"), key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or ""))
    want = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()))
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(rows_of(got, "doc_id", "n_chars", "edited_sha256"), key=key) == sorted(want, key=key)
    prints = {}
    for i, a, b, x, y in rows_of(got, "doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next"):
        assert len(a) == len(b) == 256 and 0 <= x <= 1 and 0 <= y <= 1 and x == fingerprint.likeness(a, b)
        prints[i] = a
    for i, t in rows:
        for j, u in rows:
            if lower(t).split() == lower(u).split():
                assert prints[i] == prints[j]


def test_op2_collisions_follow_generalised_jaccard(spark):
    rng = np.random.default_rng(1)
    texts = []
    for k in range(40):
        base = [f"w{k}-{x}" for x in rng.integers(0, 60, 200)]  # own words for each pair: equal words have equal samples
        swap = [f"v{k}-{x}" for x in rng.integers(0, 60, 5 * k)]
        texts += [" ".join(base), " ".join(base[: 200 - len(swap)] + swap)]
    got = [r[0] for r in fingerprint.fingerprint_texts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(1), keep=["doc_id"]).orderBy("doc_id").select("fingerprint").collect()]
    errors = []
    for a, b, x, y in zip(texts[::2], texts[1::2], got[::2], got[1::2], strict=True):
        s, t = collections.Counter(a.split()), collections.Counter(b.split())
        errors.append(fingerprint.likeness(x, y) - sum((s & t).values()) / sum((s | t).values()))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.09


def test_op2_blocks_of_a_long_text_give_the_same():
    texts = pa.array([" ".join(f"w{i % 977}" for i in range(3000)), "a b a", "", " ".join(f"v{i}" for i in range(500))])
    words = fingerprint.split_words(*fingerprint.text_bytes(texts))
    assert (fingerprint.fingerprints(words) == fingerprint.fingerprints(words, block=100)).all()


def test_op2_ranges(spark):
    rng = np.random.default_rng(3)
    k = [-(1 << 63), *rng.integers(-50, 50, 300).tolist(), 1 << 62]
    df = spark.createDataFrame([(x,) for x in k], "k long")
    for bounds in ([], [0], sorted(set(rng.integers(-60, 60, 17).tolist())), list(range(-40, 40, 3))):
        got = df.select("k", fingerprint.range_of(F.col("k"), bounds).alias("r")).collect()
        assert all(r["r"] == np.searchsorted(bounds, r["k"], side="left") for r in got)


def test_op3_measures_and_verdicts(table):
    got = host_rules.rule_report(table)
    texts = collections.defaultdict(list)
    for r in got.select("doc_id", *host_rules.MEASURES, "base_failed", "kept").collect():
        texts[r["doc_id"]].append(r)
    for i, t in rows_of(table, "doc_id", "text"):
        r, t = texts[i][0], t or ""
        w = re.findall(WORD, t)
        seen = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_op3_hosts(spark):
    good, bad = "a plain line of thirty different words " + " ".join(f"w{i}" for i in range(30)), " ".join(f"w{i}#" for i in range(30))
    rows = [(i, good if i % 10 else bad, "fine") for i in range(100)] + [(i, bad if i % 2 else good, "poor") for i in range(100, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.rule_report(df).collect()}
    assert all(kept[i] for i in range(100)) and all(kept[i] == (i % 2 == 0) for i in range(100, 200))
    assert host_rules.apply_rules(df).count() == 150


def test_op3_a_reliable_rule_acts_at_ordinary_hosts(spark):
    """Hosts below max_rate: symbols are enforced but at the clearly better host, repeated lines are not."""
    good, bad = "a plain line of thirty different words " + " ".join(f"w{i}" for i in range(30)), " ".join(f"w{i}#" for i in range(30))
    lines = "\n".join([" ".join(f"v{i}" for i in range(30)), *["x"] * 8])
    rows = [(100 * h + i, bad if i < 3 else lines if i < 5 else good, f"h{h}") for h in range(10) for i in range(50)]
    rows += [(5000 + i, bad if i < 1 else good, "better") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = host_rules.rule_report(df).collect()
    assert not any(r.base_failed for r in got) and sum(list(r.failed) == ["dup_lines"] for r in got) == 20
    assert {r.doc_id for r in got if not r.kept} == {100 * h + i for h in range(10) for i in range(3)}


def test_op3_verdict_acts_on_the_given_tables(spark):
    got = host_rules.rule_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    gone = got.where("NOT kept AND NOT base_failed").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id", "left").toPandas()
    assert len(gone) and (gone.quality.dropna() == 0).all()


def test_op4_shards_fit_and_split_only_when_needed(table):
    limit = 3000
    got = sharding.assign_shards(table, limit=limit, keep=["doc_id", "text"]).collect()
    assert len(got) == table.count()
    held, n = collections.Counter(), collections.Counter()
    for r in got:
        held[r["shard"]] += len((r["text"] or "").encode())
        n[r["shard"]] += 1
    for r in got:
        assert held[r["shard"]] == r["shard_bytes"] and (held[r["shard"]] <= limit or n[r["shard"]] == 1)
        h = int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16)
        assert "/" in r["shard"] or h >> (60 - r["depth"]) == r["prefix"]
        if r["depth"] and "/" not in r["shard"]:
            near = [x for x in got if (int(hashlib.md5(("" if x["doc_id"] is None else str(x["doc_id"])).encode()).hexdigest()[:15], 16) >> (61 - r["depth"])) == r["prefix"] >> 1]
            assert sum(len((x["text"] or "").encode()) for x in near) > limit


def test_op4_one_id_over_the_limit(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 50 + [(2, "y")], "doc_id long, text string").repartition(3)
    got = sharding.assign_shards(df, limit=500, keep=["doc_id"]).collect()
    assert len(got) == 51 and collections.Counter(r["shard"] for r in got).most_common(1)[0][1] <= 5


def test_op5_ranks_held_out_documents(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op5_quality_rank(spark, "/root/testdata/sf0.01")
    told = got.join(labels, "doc_id").where("held_out").toPandas()
    assert got.count() == docs.count() and (told.predicted == told.quality).mean() > 0.95
    assert ((told.score >= 0.3).astype(int) == told.predicted).all()


def test_op5_weights_minimise_the_loss_over_all_pairs():
    """The pair loss itself, over every pair of a good and a bad row, against small steps away from the weights."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 3))
    good = x @ [1.0, -0.5, 0.0] + rng.normal(size=40) > 0
    ranker = quality_rank.fit(x, good, cut=0.3, pairs=10**9)
    z = np.clip((x - ranker.mean) / ranker.scale, -6, 6)

    def loss(w):
        diff = np.array([a - b for a in z[good] for b in z[~good]])
        return np.log1p(np.exp(-(diff @ w))).mean() + 0.5e-3 * (w @ w)

    least = loss(ranker.weight)
    assert all(loss(ranker.weight + d) > least for k in range(3) for d in (np.eye(3)[k] * 0.01, -np.eye(3)[k] * 0.01))
    told = z @ ranker.weight
    cuts = [t for a, b in zip(np.sort(told), np.sort(told)[1:], strict=False) for t in [(a + b) / 2]]
    right = lambda t: int(((told >= t) == good).sum())
    assert right(ranker.threshold) >= max(map(right, cuts)) - 1
    assert ((ranker.score(x) >= 0.3) == (told >= ranker.threshold)).all()


def pair_loss(z, good, w):
    """The mean loss over every pair and its gradient, a good row at a time."""
    told, above, below = z @ w, z[good], z[~good]
    value, slope = 0.0, np.zeros(len(w))
    for row, t in zip(above, told[good], strict=True):
        u = told[~good] - t
        value += np.logaddexp(0, u).sum()
        p = 1 / (1 + np.exp(-u))
        slope += p @ below - p.sum() * row
    n = len(above) * len(below)
    return value / n + 0.5e-3 * (w @ w), slope / n + 1e-3 * w


@pytest.mark.parametrize("apart", [1.0, 40.0])
def test_op5_learns_from_all_pairs(apart):
    """More pairs than may be listed: the gradient over all of them vanishes, and listed pairs give the same weights."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(800, 4))
    good = x @ [1.0, -0.5, 0.2, 0.0] * apart + rng.normal(size=800) > 0
    assert good.sum() * (~good).sum() > 60_000
    got, listed = quality_rank.fit(x, good, cut=0.3), quality_rank.fit(x, good, cut=0.3, pairs=10**9)
    z = np.clip((x - got.mean) / got.scale, -6, 6)
    assert np.abs(pair_loss(z, good, got.weight)[1]).max() < 1e-9
    assert np.allclose(got.weight, listed.weight, rtol=0, atol=1e-8) and abs(got.threshold - listed.threshold) < 1e-6


def test_op5_loss_by_nodes_is_that_of_the_pairs():
    rng = np.random.default_rng(10)
    z = rng.normal(size=(90, 3))
    good = rng.random(90) < 0.4
    for w in (np.zeros(3), np.array([0.3, -2.0, 1.0]), np.array([90.0, -30.0, 5.0])):
        got = quality_rank.PairLoss(lambda make: make(z, good), np.zeros(3), np.ones(3), w)
        listed = quality_rank.ListedPairs(z, good, w)
        assert abs(got.pairs - listed.pairs) < 1e-8 and abs(got.loss - listed.loss) < 1e-9 * (1 + listed.loss)
        assert np.allclose(got.gradient, listed.gradient, atol=1e-8) and np.allclose(got.hessian(), listed.hessian(), atol=1e-8)


def test_op5_cut_is_best_over_all_scores():
    rng = np.random.default_rng(11)
    for n in (1, 2, 9, 60):
        for _ in range(40):
            score, good = rng.integers(0, 12, n) / 4, rng.random(n) < rng.random()
            values, at = np.unique(score, return_inverse=True)
            net = np.bincount(at, np.where(good, -1, 1))
            right = lambda t: int(((score >= t) == good).sum())  # noqa: E731, B023
            most = max(map(right, [-1, *(values + 0.1)]))
            for size in (1, 3, 100):
                ranges = [quality_rank.gaps(values[a : a + size], net[a : a + size]) for a in range(0, len(values), size)]
                assert right(quality_rank.best_cut(ranges)) == most
            assert quality_rank.best_cut([quality_rank.gaps(values, net)]) == quality_rank.best_cut(ranges)


def test_op5_learns_from_all_labels(spark):
    """More labels than 20,000, those of the least hashes of one kind only: the others decide. Parts of the table change nothing."""
    n = 20_600
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h")).toPandas().sort_values("h", ignore_index=True)
    rows["quality"] = (rows.index < 20_000).astype(int)
    rows["text"] = "word " + rows.doc_id.astype(str) + np.where(rows.quality == 1, " more.", " | # !")
    noise = rows.doc_id % 10 == 0
    rows.loc[noise, "text"] = "word " + rows.doc_id.astype(str)
    table = spark.createDataFrame(rows[["doc_id", "text", "quality"]])
    got = quality_rank.learn(table.repartition(7), table)
    raw = [t.encode() for t in rows.text]
    x = quality_rank.features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in raw])])).astype(np.float32).astype(float)
    good = rows.quality.to_numpy() == 1
    whole = quality_rank.fit(x, good, cut=0.3)
    assert np.allclose(got.mean, whole.mean) and np.allclose(got.weight, whole.weight, atol=1e-6) and abs(got.threshold - whole.threshold) < 1e-5
    z = np.clip((x - got.mean) / got.scale, -6, 6)
    assert np.abs(pair_loss(z, good, got.weight)[1]).max() < 1e-8
    told = quality_rank.score_quality(table, got, keep={"doc_id": F.col("doc_id")}).toPandas().set_index("doc_id").predicted
    assert (told[rows.doc_id[~noise]].to_numpy() == good[~noise]).all()
    made = quality_rank.described(table.repartition(3), to="f", keep={"doc_id": F.col("doc_id")})
    again = quality_rank.learn(made, table, described_as="f")
    assert (again.weight == got.weight).all() and again.threshold == got.threshold


def test_op5_odd(table, odd):
    labels = odd.select("doc_id", F.pmod("doc_id", F.lit(2)).cast("int").alias("quality"))
    for of in (None, F.lit(False), F.col("quality") == 1):
        ranker = quality_rank.learn(table, labels, of=of)
        got = quality_rank.score_quality(table, ranker, keep={"doc_id": F.col("doc_id")}).toPandas()
        assert len(got) == table.count() and got.score.between(0, 1).all()


def test_op5_variety_covers_the_whole_text():
    rng = np.random.default_rng(6)
    for n in (1, 7, 50, 51, 300):
        h = rng.integers(0, 40, n)
        brute = [len(set(h[a : a + 50].tolist())) / min(n, 50) for a in range(max(n - 50, 0) + 1)]
        assert np.allclose(quality_rank.window_variety(h), (np.mean(brute), min(brute)))
    good, late = np.arange(400), np.concatenate([np.arange(200), np.zeros(200, int)])
    assert quality_rank.window_variety(good) == (1, 1) and quality_rank.window_variety(late)[1] == 0.02


def test_op6_bytes(table):
    got = suffix_dedup.remove_repeats(table, keep={"doc_id": F.col("doc_id"), "src": F.col("text")}).collect()
    raw = [(r[0] or "").encode() for r in rows_of(table, "text")]
    seen = collections.Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    assert len(got) == len(raw)
    for r in got:
        b = (r["src"] or "").encode()
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                mask[i : i + 200] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~mask])
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), int(mask.sum()), spans, hashlib.sha256(rest).hexdigest())


def test_op6_parts_of_a_long_text_have_all_windows(monkeypatch):
    data = np.random.default_rng(7).integers(0, 4, 1500).astype(np.uint8)
    whole = {(p, h) for p, h, a, b in zip(*suffix_dedup.anchors(data), strict=True) for _ in range(a, b + 1)}
    monkeypatch.setattr(suffix_dedup, "PART", 300)
    seen, found = [], set()
    for start, part in suffix_dedup.parts(data):
        for p, h, a, b in zip(*suffix_dedup.anchors(part), strict=True):
            seen += range(start + a, start + b + 1)
            found.add((p + start, h))
    assert seen == list(range(1301)) and found == whole


def test_op6_the_cover_meets_every_pair_of_windows():
    n, cover = suffix_dedup.MODULUS, set(suffix_dedup.COVER)
    for i in range(n):
        for j in range(n):
            assert any((i + d) % n in cover and (j + d) % n in cover for d in range(n))
    for first, last, size in ((0, 0, 200), (5, 300, 501), (146, 146, 400), (70, 95, 295)):
        brute = [p for p in range(size) if p % n in cover and first <= p <= last + suffix_dedup.SIDE and p + suffix_dedup.RANKED <= size]
        assert suffix_dedup.sample_places(first, last, size).tolist() == brute


@pytest.mark.parametrize("most", [1, 20, 512])
def test_op6_edited_passages(spark, monkeypatch, most):
    import random

    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rng = random.Random(1)
    base, rows = ["".join(rng.choice("abcd é") for _ in range(2000)) for _ in range(3)], []
    for i in range(120):
        t = list(rng.choice(base)[(a := rng.randrange(1200)) : a + rng.randrange(100, 800)])
        for _ in range(rng.choice([0, 1, 2, 5])):
            t[rng.randrange(len(t))] = rng.choice("xyz")
        rows.append((i, "".join(t)))
    test_op6_bytes(spark.createDataFrame([*rows, (200, "a" * 199), (201, "a" * 201), (202, "ab" * 500), (203, "xab" * 300)], "doc_id long, text string"))


def test_op7_counts_are_the_tokenizers(table):
    """Whole texts, and texts made of what is odd for a tokenizer, against the library's own counts."""
    v = token_counts.vocabulary(VOCAB)
    own, counted = token_counts.tokenizer(v), token_counts.counter(VOCAB)
    score = dict(zip(v.pieces, v.logp, strict=True))
    got = token_counts.count_tokens(table, vocab_path=VOCAB, keep=["doc_id", "text"]).collect()
    assert len(got) == table.count()
    for r in got:
        said = own.encode(r["text"] or "", add_special_tokens=False)
        assert r["n_tokens"] == len(said.ids), r["text"]
        if not any(t.startswith("<0x") for t in said.tokens):
            assert math.isclose(r["token_score"], sum(score[t] for t in said.tokens), rel_tol=1e-9, abs_tol=1e-9)
    for t in ("", " ", "  ", " a", "a ", "▁a", "a▁▁b", "日本語 x\x00 \n\n tab\t", "<unk> <0x0A> </s>", "x" * 5000, "é😀 😀😀", "the the  the"):
        assert counted.text(t)[0] == len(own.encode(t, add_special_tokens=False).ids), t


def test_op7_brute_force_paths():
    pieces = [("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("aba", -5.0), ("▁a", -3.0)]
    counted = token_counts.Counted(pieces)

    def paths(s, k=0):
        if k == len(s):
            return [(0.0, ())]
        out = [(x + v, (len(p), *r)) for p, v in pieces if s.startswith(p, k) for x, r in paths(s, k + len(p))]
        if s[k] not in "▁ab":
            out += [(x - 15.0, (1, *r)) for x, r in paths(s, k + 1)]
        return out

    for s in ("▁ab", "▁aba", "▁abaab", "▁axb", "▁abab"):
        best = max(x for x, _ in paths(s))
        assert counted.best(s)[1] == best
        # of equal paths the last piece is the longest, then the one before it, and so on
        tie = max((r for x, r in paths(s) if x == best), key=lambda r: r[::-1])
        assert counted.best(s)[0] == len(tie)


def linked_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, lower(t))
        s = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
        sets.setdefault(i, []).append(s)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sets if i is not None]
    for x in ids:
        for y in ids:
            if x < y and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[x] for t in sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, sets


def test_op8_components(table):
    rows = rows_of(table, "doc_id", "text")
    want, sets = linked_components(rows, 85)
    got = near_dedup.near_duplicates(table, percent=85).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
            assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}


def test_op8_links_that_miss_the_centre(spark):
    """Chains and copies of one text that are alike to it but not to each other."""
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
    rows = [(500, " ".join(words))]
    for i in range(60):
        w = list(words)
        for k in rng.choice(60, 4, replace=False):
            w[5 * k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    chain = [f"c{x}" for x in range(200)]
    for i in range(12):
        rows.append((100 + i, " ".join(chain[2 * i :] + [f"d{j}" for j in range(2 * i)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = linked_components(rows, 85)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, percent=85).collect()}
    assert got == want
    assert near_dedup.drop_near_duplicates(df, percent=85).count() == len(set(want.values()))


@pytest.mark.parametrize("seed", [5, 6])
def test_op8_large_buckets_lose_no_link(spark, seed):
    """Pairs whose shared edits link them to each other and not to the centre."""
    rng = np.random.default_rng(seed)
    words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
    rows = [(900, " ".join(words)), (901, " ".join(words))]
    for i in range(70):
        w = list(words)
        for k in rng.choice(40, int(rng.integers(1, 6)), replace=False):
            w[5 * k] = f"x{i}_{k}" if rng.random() < 0.7 else f"y{k}"
        rows += [(10 * i, " ".join(w))] + [(10 * i + 1, " ".join([*w[:-1], "z"]))] * (i % 3 == 0)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = linked_components(rows, 85)
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, percent=85).collect()} == want


def test_op9_schedule(table):
    got = mixing.schedule(table, block_bytes=700, period=50, keep={"doc_id": F.col("doc_id")}).toPandas()
    assert len(got) == table.count()
    for _, g in got.groupby("source", dropna=False):
        g = g.sort_values(["place", "n_bytes"])
        assert (g.place.to_numpy() == np.cumsum(g.n_bytes) - g.n_bytes).all() and (g.block == g.place // 700).all()
    pairs = got.drop_duplicates(["source", "block"])
    assert not pairs.duplicated("slot").any()


@pytest.mark.parametrize("weights", [[1], [1, 1, 1], [5, 3, 1, 1], [0.9, 0.05, 0.05], [13, 11, 7, 5, 3, 2, 1]])
def test_op9_less_than_one_block_away(weights):
    slots = mixing.whole_weights(weights, 200)
    assert sum(slots) == 200 and min(slots) >= 1
    had = [0] * len(slots)
    for t, (i, k) in enumerate(mixing.pfair(slots), 1):
        assert had[i] == k
        had[i] += 1
        assert all(abs(h - t * q / 200) < 1 for h, q in zip(had, slots, strict=True))
    assert had == slots


def within_a_block(rows, weights):
    """Each block lies in the window of its own weight, so each source is less than one block off in every prefix."""
    whole = sum(weights.values())
    return all(math.floor(k / (weights[i] / whole) + 1e-6) <= t < math.ceil((k + 1) / (weights[i] / whole) - 1e-6) for i, k, t in rows)


def test_op9_long_schedule_follows_the_unrounded_weights(spark):
    weights = dict(enumerate([math.sqrt(1 / 3), *[math.sqrt(2 / 57)] * 19, 1e-5]))
    blocks = [4000, *[1300] * 19, 3]
    rows = list(mixing.pfair_slots(mixing.exact_shares(list(weights.values())), blocks))
    assert collections.Counter(i for i, _, _ in rows) == dict(enumerate(blocks)) and len({t for _, _, t in rows}) == len(rows)
    assert within_a_block(rows, weights)

    df = spark.range(9000).selectExpr("id AS doc_id", "lpad(id, 10, '0') AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 19) END AS source")
    got = mixing.schedule(df, block_bytes=10, keep={"doc_id": F.col("doc_id")}).toPandas()
    size = got.groupby("source").n_bytes.sum()
    assert len(got) == 9000 and not got.duplicated("slot").any() and got.slot.max() > 15000
    assert within_a_block(got[["source", "block", "slot"]].itertuples(index=False), {s: math.sqrt(b) for s, b in size.items()})


def test_op9_weights_of_zero_or_none(spark):
    df = spark.createDataFrame([(i, "x" * 10, s) for i, s in enumerate("aabbcc" * 20)], "doc_id long, text string, source string")
    got = mixing.schedule(df, block_bytes=10, weights={"a": 4.0, "b": 1.0}, keep={"doc_id": F.col("doc_id")}).toPandas()
    assert len(got) == 120 and within_a_block(got[["source", "block", "slot"]].itertuples(index=False), {"a": 4, "b": 1, "c": 1})


def test_op10_pieces_and_sequences(table):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BPE)
    got = packing.pack_texts(table, tokenizer=BPE).toPandas()
    want = collections.Counter()
    for i, t in rows_of(table, "doc_id", "text"):
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > first else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    has = collections.Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples())
    assert has == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 1024 and (g.offset.to_numpy() == np.cumsum(g.length) - g.length).all()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 1024) * 1.03 + 1


def test_op10_genetic_packing_beats_best_fit():
    """Never worse, and better on most lots where best fit misses the bound."""
    rng, won, missed = np.random.default_rng(2), 0, 0
    for n, low, high in [(1, 1, 1024), (5, 1, 1024), (60, 1, 1024), *[(150, 200, 500)] * 6, (400, 250, 512)]:
        size = rng.integers(low, high, n)
        none = np.full(n, -1)
        plain = packing.best_fit(none, size, 1024)
        at = packing.evolve(size, 1024, [], 3)
        assert (at >= 0).all() and packing.filled(at, size).max() <= 1024 and packing.filled(at, size).min() > 0
        bins, best = at.max() + 1, plain.max() + 1
        assert bins <= best
        missed += best > -(-size.sum() // 1024)
        won += bins < best
    assert missed >= 5 and won >= 5


def test_op10_elites_migrate_whole():
    """A guest that no island would find stands after the last epoch; bins and offsets fit."""
    size = np.array([600, 424] * 30 + [512, 300, 212] * 20)
    perfect = np.repeat(np.arange(50), [2] * 30 + [3] * 20)
    own = packing.best_fit(np.full(len(size), -1), size, 1024)
    rows = pd.DataFrame({"_id": np.arange(len(size)), "length": size, "row": np.arange(len(size)), "bin": np.arange(len(size)), "lot": 0, "island": 0})
    both = pd.concat([rows.assign(at=own, guest=False), rows.assign(at=perfect, guest=True)])
    got = packing._last_epoch(1024, 0, True)(both)
    assert got.bin.nunique() == 50 and (got.groupby("bin").length.sum() == 1024).all()
    sent = packing._first_epoch(1024, 0)(rows)
    assert sent.groupby("guest").size().tolist() == [len(size)] * 2 and set(sent[sent.guest].island) == {1}


def test_pipeline_sequences_follow_the_weights(spark, monkeypatch):
    """Stages 4 and 5: every prefix of the packed sequences has the sources at their weights until one ends."""
    monkeypatch.setattr(packing, "LOT", 100)
    monkeypatch.setattr(corpus_pipeline, "BLOCK_BYTES", 2000)
    rng, rows = np.random.default_rng(4), []
    for source, n in (("hot", 3200), ("b", 200), ("c", 200)):  # weights 4, 1 and 1 by the root of the bytes
        rows += [(len(rows) + i, " ".join(f"w{x}" for x in rng.integers(0, 99, int(rng.integers(20, 140)))), source) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed_ = corpus_pipeline.source_mixing(spark, df, "")
    assert sorted(rows_of(mixed_, *df.columns)) == sorted(rows)
    # what is between the stages may come in any order of rows
    got = corpus_pipeline.best_fit_packing(spark, mixed_.repartition(7, F.rand(1)), "").toPandas()
    source = {i: s for i, _, s in rows}
    got = got.assign(source=got.doc_id.map(source)).sort_values(["sequence_id", "offset"])
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    assert got.groupby("sequence_id").length.sum().max() <= 1024 and set(got.doc_id) == set(source)
    size = {s: sum(len(t) for _, t, x in rows if x == s) ** 0.5 for s in ("hot", "b", "c")}
    had = {s: (got.length * (got.source == s)).cumsum().to_numpy() for s in size}
    ends = min(int(np.argmax(h == h[-1])) for h in had.values())
    total, most = sum(had.values()), 150 * 140  # tokens of an island of pieces
    for s, h in had.items():
        assert np.abs(h - total * size[s] / sum(size.values()))[: int(0.9 * ends)].max() < most, s


CLASHES = ["_k0", "_k1", "_row", "_slot", "_text", "_x_k0", "node", "key", "hub", "source_", "mix_slot"]


@pytest.fixture(scope="module")
def small(spark, odd):
    """A few rows of each kind, with columns of names that the stages use themselves."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 500, 80))
    make = lambda i: " ".join(f"w{x}" for x in rng.integers(0, 9000, 60)) + f" {i}"
    rows = [(100 + i, make(i), "en", f"s{i % 3}", 0) for i in range(30)]
    rows += [(200 + i, make(i) + " " + passage + " " + make(-i), "en", "s1", 0) for i in range(4)]
    rows += [(300 + i, rows[0][1], "en", "s2", 0) for i in range(3)] + [(400, rows[1][1] + " more", "en", "s0", 0), rows[2], rows[2]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def stage_rows(name, spark, df):
    return dict(corpus_pipeline.STAGES)[name](spark, df, "")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_pipeline_stages_keep_the_columns(spark, small, name):
    got = stage_rows(name, spark, small)
    more = [c for c in mixing.MIXED if name == "source_mixing"]
    assert [c for c in got.columns if c not in more] == [c for c in small.columns if c not in more]
    for r in got.collect():
        assert all(r[c] == f"own {c}" for c in CLASHES if c not in more)
    assert stage_rows(name, spark, small.limit(0)).count() == 0


def test_pipeline_quality_rules_against_brute_force(spark, small):
    """Rows of a text go together: those of the base rule, and those that fail a rule of their host."""
    got = collections.Counter(rows_of(stage_rows("quality_rules", spark, small), "doc_id", "text"))
    report = collections.Counter((r.doc_id, r.n_words, r.n_symbols) for r in host_rules.rule_report(small).collect() if r.kept)
    assert sum(got.values()) == sum(report.values())
    for (i, t), n in collections.Counter(rows_of(small, "doc_id", "text")).items():
        words = re.findall(WORD, t or "")
        assert got[i, t] in (0, n)
        if len(words) < 20:
            assert not got[i, t]
        elif i is not None and i >= 100:
            assert got[i, t] == n


def test_pipeline_near_dedup_against_brute_force(spark, small):
    rows = rows_of(small, "doc_id", "text")
    want, sets = linked_components(rows, 80)
    got = rows_of(stage_rows("near_dedup", spark, small), "doc_id", "text")
    alone = {r for r in rows if r[0] is None or not re.findall(WORD, r[1] or "")}
    kept = [r for r in got if r not in alone]
    assert len(got) == len(set(got)) and set(got) >= alone
    assert sorted(i for i, _ in kept) == sorted({want[i] for i in want if any(sets[i])})


def test_pipeline_suffix_dedup_against_brute_force(spark, small):
    raw = [(i, (t or "").encode(), t) for i, t in rows_of(small, "doc_id", "text")]
    seen = collections.Counter(b[k : k + 200] for _, b, _ in raw for k in range(len(b) - 199))
    want = collections.Counter()
    for i, b, t in raw:
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                mask[k : k + 200] = True
        left = bytes(np.frombuffer(b, np.uint8)[~mask]).decode("utf-8", "ignore")
        want[i, None if t is None else left, len(left)] += 1
    assert collections.Counter(rows_of(stage_rows("suffix_dedup", spark, small), "doc_id", "text", "n_chars")) == want


def test_pipeline_mixing_and_packing_lose_nothing(spark, small):
    from tokenizers import Tokenizer

    made = stage_rows("source_mixing", spark, small)
    assert collections.Counter(rows_of(made, "doc_id", "text", "source")) == collections.Counter(rows_of(small, "doc_id", "text", "source"))
    own, got = Tokenizer.from_file(BPE), stage_rows("best_fit_packing", spark, made).collect()
    want = collections.Counter()
    for i, t in rows_of(small, "doc_id", "text"):
        want[i, tuple([*own.encode(t or "", add_special_tokens=False).ids, 2])] += 1
    whole = collections.defaultdict(list)
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        whole[r.sequence_id].append(r)
    for rows in whole.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))] and sum(r.length for r in rows) <= 1024
    assert sum(r.length for r in got) == sum(n * len(t) for (_, t), n in want.items())
    single = collections.Counter((r.doc_id, tuple(r.ids)) for r in got if r.length < 1024 and r.start == 0)
    assert all(single[k] == n for k, n in want.items() if len(k[1]) < 1024)


def test_pipeline_run_on_the_small_tables(spark):
    """The stages one after the other, each by its own operator on what the one before kept."""
    got = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_hand = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        by_hand = stage(spark, by_hand, SF)
    ids = {r[0] for r in rows_of(by_hand, "doc_id")}
    assert {r[0] for r in rows_of(got, "doc_id")} == ids and 0 < len(ids) < docs.count()


def test_mixed_repeated_rows_have_their_own_places(spark):
    df = spark.createDataFrame([(1, "x" * 100, "a", None)] * 50 + [(2, None, None, 3)] * 2, "doc_id long, text string, source string, mix_slot int")
    got = mixing.mixed(df, block_bytes=100)
    assert got.columns == ["doc_id", "text", "source", *mixing.MIXED] and got.count() == 52
    assert got.where("source = 'a'").select("mix_slot").distinct().count() == 50
    assert mixing.mixed(df.limit(0), block_bytes=100).count() == 0
