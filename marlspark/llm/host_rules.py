"""Quality rules, judged by host.

Every document is measured once (one Arrow pass, no shuffle). Rule failures are summed by host, the rates are
shrunk towards a beta prior that is fitted to all hosts by moments, and the verdict of a host, which is the list
of rules that it fails, is joined back: a document goes if it fails a base rule, or a rule that is enforced at
its host. A document that fails no rule is kept whatever its host.

Most rules are enforced only at hosts that fail them often. Documents that fail a reliable rule are bad at ordinary
hosts too: it is enforced everywhere but at hosts that are clearly better than the prior, where a failure is an
exception.

Defined results: a null or empty text has no words and fails ``base``; a null host is a host of its own; an empty
table gives an empty result; repeated rows are judged alike; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspark.llm.frames import fresh, map_arrow, row_key, small_batches, written
from marlspark.llm.words import split_words, text_bytes

SYMBOLS = b"#*$%&|<>"
WINDOW = 8

#: Rules besides the base rules, each a condition on the measures; a document fails where it holds.
HOST_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_lines > 0 AND 10 * n_dup_lines > 3 * n_lines",
    "repeats": "10 * n_repeat_words > n_words",
    "word_length": "word_chars > 12 * n_words",
}
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    """A rule is enforced at a host whose shrunk failure rate is at least max_rate.

    A rule of reliable is also enforced at every other host, unless the posterior rate of the host lies more than
    spared standard deviations below the mean of the prior.
    """

    max_rate: float = 0.2
    reliable: tuple[str, ...] = ("symbols",)
    spared: float = 2.0


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ranks of the pairs (a, b): equal pairs, equal ranks. Exact, as the values are below 2**31."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeat_words(h: np.ndarray, window: int = WINDOW) -> int:
    """Words of one text that lie in a window of so many words (8) that occurs at least twice in it."""
    if len(h) <= window:
        return 0
    r = np.unique(h, return_inverse=True)[1]
    for step in (1, 2, 4):
        r = _pairs(r[:-step], r[step:])
    twice = np.flatnonzero(np.bincount(r)[r] > 1)
    if not len(twice):
        return 0
    return window + int(np.minimum(np.diff(twice), window).sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            n += 1
            seen.add(line)
    return n, n - len(seen)


def measures(batches: Iterator[pa.RecordBatch], text: str = "_text") -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for batch in small_batches(batches, text):
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        w = split_words(data, offsets, lower=False)

        def per_text(flags: np.ndarray, offsets: np.ndarray = offsets) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[offsets[1:]] - total[offsets[:-1]]

        chars, space = per_text((data & 0xC0) != 0x80), per_text((data == 32) | ((data >= 9) & (data <= 13)))
        raw = data.tobytes()
        lines = [_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        again = [repeat_words(w.hash[a : a + c]) for a, c in zip(w.first.tolist(), w.count.tolist(), strict=True)]
        made = [w.count, chars - space, per_text(symbol[data]), [x[1] for x in lines], [x[0] for x in lines], again]
        rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text]
        yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(np.asarray(x, np.int64)) for x in made], names=[n for n, _ in rest] + MEASURES)


def measure(docs: DataFrame, text: str, host: str, keep: dict[str, Column]) -> DataFrame:
    """The columns of keep, ``_host`` and the measures of every text."""
    df = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(host).alias("_host"), F.col(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "_text"] + [f"{m} bigint" for m in MEASURES])
    return map_arrow(df, measures, schema)


def beta_prior(n: float, mean: float | None, mean_sq: float | None, inv_n: float | None) -> tuple[float, float]:
    """(alpha, beta) of the beta prior from the moments of host rates: mean, mean square, mean of 1/documents.

    The variance between hosts is what sampling (mean (1 - mean) times the mean of 1/n) does not explain. With
    one host, or none, or no spread, the prior is as strong as 1000 documents.
    """
    if not n or mean is None or mean <= 0 or mean >= 1:
        m = 0.0 if not mean else float(mean)
        return 1000 * m, 1000 * (1 - m)
    between = max(mean_sq - mean * mean - mean * (1 - mean) * inv_n, mean * (1 - mean) / 1001)
    strength = mean * (1 - mean) / between - 1
    return mean * strength, (1 - mean) * strength


def host_verdicts(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """_host, n_docs, for each rule its shrunk rate, and enforced: the rules (as an array) that the host fails.

    The prior is six numbers for each rule, whatever the number of hosts, and is all that reaches the driver.
    """
    hosts = measured.groupBy("_host").agg(F.count(F.lit(1)).alias("n_docs"), *[F.count_if(F.expr(c)).alias(f"f_{r}") for r, c in HOST_RULES.items()])
    hosts = written(hosts, "hosts")
    rate = {r: F.col(f"f_{r}") / F.col("n_docs") for r in HOST_RULES}
    moments = hosts.agg(F.count(F.lit(1)).alias("n"), F.avg(1 / F.col("n_docs")).alias("inv"), *[F.avg(x).alias(f"m_{r}") for r, x in rate.items()], *[F.avg(x * x).alias(f"s_{r}") for r, x in rate.items()]).first()
    fails = {}
    for r in HOST_RULES:
        a, b = beta_prior(moments["n"], moments[f"m_{r}"], moments[f"s_{r}"], moments["inv"])
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)))
        post = F.col(f"rate_{r}")
        fails[r] = post >= limits.max_rate
        if r in limits.reliable:
            deviation = F.sqrt(post * (1 - post) / (F.col("n_docs") + F.lit(a + b + 1)))
            fails[r] = fails[r] | (post + limits.spared * deviation >= F.lit(a / (a + b)))
    bad = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in fails.items()]), lambda x: x.isNotNull())
    return hosts.select("_host", "n_docs", *[f"rate_{r}" for r in HOST_RULES], bad.alias("enforced"))


def judge(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """measured with base_failed, failed (its host rules, as an array) and kept.

    Only documents that a host rule could reject are joined with the verdicts, salted by a hash over as many keys as
    the host has thousands of documents, so that a host with a third of all documents is dealt to many tasks.
    """
    failed = F.filter(F.array(*[F.when(F.expr(c), F.lit(r)) for r, c in HOST_RULES.items()]), lambda x: x.isNotNull())
    rows = measured.withColumns({"base_failed": F.expr(BASE_FAILED), "failed": failed})
    open_ = ~F.col("base_failed") & (F.size("failed") > 0)
    sure = rows.where(~open_).withColumn("kept", ~F.col("base_failed"))
    told = host_verdicts(measured, limits)
    salts = (F.col("n_docs") / 1000).cast("int") + 1
    verdict = told.where(F.size("enforced") > 0).select(F.col("_host").alias("_h"), "enforced", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_s"))
    # the number of salts of a host is a few bytes for each host; Spark broadcasts it only while it is small
    sized = rows.where(open_).join(told.select(F.col("_host").alias("_g"), salts.alias("_salts")), F.col("_host").eqNullSafe(F.col("_g")))
    salt = F.pmod(F.xxhash64(*[c for c in measured.columns if c != "_host"]), F.col("_salts")).cast("int")
    joined = sized.withColumn("_salt", salt).join(verdict, F.col("_host").eqNullSafe(F.col("_h")) & (F.col("_salt") == F.col("_s")), "left")
    kept = ~F.coalesce(F.arrays_overlap("failed", "enforced"), F.lit(False))
    return sure.unionByName(joined.withColumn("kept", kept).select(*sure.columns))


def rule_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row for each document: doc_id, the measures, base_failed, failed and kept."""
    measured = written(measure(docs, text, host, {"doc_id": F.col(doc_id)}), "measures")
    return judge(measured, limits).withColumnRenamed("_host", "host")


def apply_rules(docs: DataFrame, *, text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The rows of docs that the rules keep, with their own columns.

    Rows are told apart by 128 bits over all columns; rows that are equal throughout share their verdict. Only the
    keys of rejected rows are joined, by an anti join.
    """
    k0, k1 = fresh(docs.columns, "_k0", "_k1")
    marked = docs.withColumns(dict(zip((k0, k1), row_key(*docs.columns), strict=True)))
    measured = written(measure(marked, text, host, {"_x_k0": F.col(k0), "_x_k1": F.col(k1)}), "measures")
    gone = judge(measured, limits).where("NOT kept").select(F.col("_x_k0").alias(k0), F.col("_x_k1").alias(k1)).distinct()
    return marked.join(gone, [k0, k1], "left_anti").select(*docs.columns)
