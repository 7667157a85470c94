"""Corpus pipeline: toxicity -> near-dedup -> decontamination -> secret redaction -> BPE encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run``
writes each result as Parquet below the shared folder and rereads it as the next stage's documents. The first three stages drop rows
(toxic documents; all but the smallest id of a group of near copies, five-word shingles, similarity
0.8; documents with a benchmark window), the fourth masks secrets, the last one encodes, decodes and reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, decontamination, near_dedup, secret_scan, toxicity
from ledgerline.llm.queries import tokenizer_path
from ledgerline.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.reject_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("bpe", encode),
]

#: training a classifier and byte-pair encoding are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
