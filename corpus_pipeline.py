"""The corpus pipeline: each stage takes documents and returns what it keeps of them.

Between stages the documents are written as Parquet to the shared checkpoint folder and
read again. All stages but the last return the columns of documents; the last adds
`copies`, how often the mix takes the document. A null text has no language and goes in
the first stage; an empty table passes through empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagflow.llm import decontaminate, jaccard, langid, mixing, secrets
from tagflow.session import configure, ensure_checkpoint_dir

# A document stays if one language holds at least this share of its bytes' probability.
LEAST_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return langid.confident(docs, langid.train(docs), LEAST_SCORE)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    redacted = secrets.redact(docs, secrets.train(docs), into="__clean")
    length = F.when(F.col("__clean") == F.col("text"), F.col("n_chars")).otherwise(F.length("__clean"))
    return redacted.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).withColumn("text", F.col("__clean")).drop("__clean")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("mixing_sources", mixing_sources),
]

# Trained models, components and keyed rounding are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
