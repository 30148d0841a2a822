"""Pretraining corpus pipeline over ``documents``.

Quality rules take out what is junk, lines that many documents share are
dropped, one document of each group of near duplicates stays, the sources are
mixed to their target weights, and the mix is encoded. Each stage works on all
that the one before it kept, reads it from Parquet in the shared folder, and
is the same operator that its own registered query runs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, line_dedup, mixing, quality, simhash
from tidepool.llm.scratch import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees fitted on ``labels``."""
    trees = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, trees).where("kept").select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that 10 or more documents have are taken out of every document; ``n_chars`` follows the text."""
    kept = line_dedup.drop_frequent_lines(docs, min_docs=10)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the smallest id."""
    return simhash.keep_one_each(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    mixed = mixing.mix(docs, weights=(3, 1, 2), share=1.5, cap=2.0)
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, with digests of the ids and of what they decode to."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("line dedup", drop_shared_lines), ("SimHash near-dedup", near_dedup),
          ("mixing sources to target weights", mix_sources), ("BPE encoding and decoding", encode)]

#: SQL can't express these stages; tests/llm/test_pipeline.py compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = cut(stage(spark, docs, sf_dir), f"stage-{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
