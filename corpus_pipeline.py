"""Corpus preparation in five stages, each a whole pass over what the one before kept.

quality         documents that fail the quality rules go
toxicity        documents that score as toxic go
near_duplicates one document of each group of near copies stays
secrets         secrets are blanked out of the texts (n_chars follows)
packing         the documents become training sequences: a row per piece

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``docs``,
the last one the pieces. Null texts have no words and go at the first stage; an empty table
stays empty. run() writes each stage's result to the shared folder before the next reads it,
and removes it once the stage after that is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import common, jaccard_join, packing, quality, secrets, toxicity


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    history = secrets.versions(docs)
    ledger, _ = common.stored(spark, secrets.scan(history), "ledger")
    clean = secrets.redact(docs, secrets.findings(history, ledger))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the tokenizer nor the learned verdicts; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs, path = common.stored(spark, docs, name)
            if before:
                common.remove(spark, before)
            before = path
    return docs
