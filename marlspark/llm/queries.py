"""The queries of this subpackage and their SQL, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.llm.fingerprint import edit_report
from marlspark.llm.frames import written
from marlspark.llm.host_rules import rule_report
from marlspark.llm.lm_score import score_texts
from marlspark.llm.mixing import schedule
from marlspark.llm.near_dedup import near_duplicates
from marlspark.llm.packing import pack_texts
from marlspark.llm.quality_rank import described, learn, score_quality
from marlspark.llm.sharding import assign_shards
from marlspark.llm.suffix_dedup import remove_repeats
from marlspark.llm.token_counts import count_tokens

SHARD_BYTES = 1 << 20
BLOCK_BYTES = 1 << 18


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_mod(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(id_mod(7) == 2, F.lit(False))
    keep = {"doc_id": F.col("doc_id"), "held_out": held}
    return score_texts(documents(spark, sf_dir), learn=~held, vocab_path=tokenizer_file("piece_bpe_32k.model"), classes="lang", keep=keep)


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(documents(spark, sf_dir))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rule_report(documents(spark, sf_dir)).select(*names)


def op4_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir), limit=SHARD_BYTES, keep=["doc_id"])


def op5_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = written(described(documents(spark, sf_dir), to="features", keep={"doc_id": F.col("doc_id")}), "quality-features")
    ranker = learn(docs, labels, described_as="features", of=id_mod(5) != 0)
    return score_quality(docs, ranker, described_as="features", keep={"doc_id": F.col("doc_id"), "held_out": F.coalesce(id_mod(5) == 0, F.lit(False))})


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), keep={"doc_id": F.col("doc_id")}).drop("kept_text")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), vocab_path=tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), percent=85)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(documents(spark, sf_dir), block_bytes=BLOCK_BYTES, keep={"doc_id": F.col("doc_id")})


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(documents(spark, sf_dir), tokenizer=tokenizer_file("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_score, op2_fingerprint, op3_host_rules, op4_extendible_shards, op5_quality_rank, op6_suffix_dedup, op7_token_counts, op8_near_dedup, op9_mixing, op10_packing)
}

ORACLE_SQL: dict[str, str] = {
    "op4_extendible_shards": f"""
        WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS b, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
        n AS (SELECT k AS depth, h >> (60 - k) AS prefix, sum(b) AS bytes, count(*) AS n FROM d, range(61) r(k) GROUP BY ALL),
        f AS (SELECT d.doc_id, n.depth, n.prefix, n.bytes, row_number() OVER (PARTITION BY d.doc_id ORDER BY n.depth) AS k
              FROM d JOIN n ON n.prefix = d.h >> (60 - n.depth) WHERE n.bytes <= {SHARD_BYTES} OR n.n = 1)
        SELECT doc_id, depth || ':' || prefix AS shard, depth::INTEGER AS depth, prefix::BIGINT AS prefix, bytes::BIGINT AS shard_bytes FROM f WHERE k = 1""",
}
