"""From raw documents to packed training sequences, stage by stage; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.llm.frames import fresh, settled
from marlspark.llm.host_rules import apply_rules
from marlspark.llm.mixing import MIXED, mixed
from marlspark.llm.near_dedup import drop_near_duplicates
from marlspark.llm.packing import pack_texts
from marlspark.llm.queries import BLOCK_BYTES, tokenizer_file
from marlspark.llm.suffix_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and no rule enforced at their host.

    A null or empty text fails the base rule and goes; a null host is one; repeated rows share a verdict; an empty
    table stays empty; other columns are kept, whatever their names.
    """
    return apply_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at a similarity of 0.8 of five-word shingles: that of the least doc_id.

    Texts without words and rows without a doc_id are kept; rows that are equal throughout count as one; an empty table
    stays empty; other columns are kept, whatever their names.
    """
    return drop_near_duplicates(docs, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes of strings of 200 bytes that occur twice; n_chars follows the text.

    Every row stays, with what is left of its text: a null text is null, a repeated one is empty from 200 bytes on;
    an empty table stays empty; other columns are kept, whatever their names.
    """
    mine = [c for c in docs.columns if c not in ("text", "n_chars")]
    names = fresh([], *[f"_c{k}" for k in range(len(mine))])
    made = remove_repeats(docs, keep={n: F.col(c) for n, c in zip(names, mine, strict=True)})
    told = {n: F.col(n).alias(c) for n, c in zip(names, mine, strict=True)}
    own = dict(zip(mine, told.values(), strict=True)) | {"text": F.col("kept_text").alias("text"), "n_chars": F.coalesce(F.char_length("kept_text"), F.lit(0)).cast("long").alias("n_chars")}
    return made.select(*[own[c] for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their place in the Pfair schedule of their sources, as mix_slot and mix_order.

    No row goes; a null source is one; texts without bytes share the block where they fall; repeated rows have places
    of their own; an empty table stays empty; columns of these two names are replaced, others are kept.
    """
    return mixed(docs, block_bytes=BLOCK_BYTES)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids, their sequence and their place in it; sequences are numbered in mixed order.

    A null or empty text is its end token; repeated rows are packed each; an empty table gives no sequences.
    """
    return pack_texts(docs, tokenizer=tokenizer_file("byte_bpe_50k.json"), order=MIXED, ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("source_mixing", source_mixing), ("best_fit_packing", best_fit_packing)]

#: SQL cannot tokenize; each stage is tested against a brute-force version, and run against the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents. Each but the last is written and read again; what it wrote on the way is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
