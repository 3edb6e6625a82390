"""A corpus from raw documents to packed sequences: five stages, each over all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlog.llm import exact_dedup, minhash, packing, suffix_dedup, toxicity
from stintlog.llm.common import written
from stintlog.session import configure


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the machine learns from labelled rows outside the held-out fold."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, labels))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A to Z, the document with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def keep_unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near-duplicates the document with the smallest id stays."""
    return minhash.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes go from every text; documents stay, with n_chars of what is left."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(dict(cut.dtypes)["n_chars"])) if "n_chars" in cut.columns else cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


STAGES = [
    ("toxicity", keep_harmless),
    ("exact dedup", keep_distinct),
    ("near dedup", keep_unlike),
    ("suffix dedup", cut_repeats),
    ("packing", pack),
]

# Trained scores, sketches and packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
