"""From documents to a training mix: five stages, each written and read again before the next.

    quality        documents that the classifier rejects go
    exact dedup    of equal texts the smallest id stays
    near dedup     of each near-duplicate group the smallest id stays
    benchmark      documents with a benchmark passage go
    mix            the words each document gives to the mix; documents without any go

Null texts count as empty ones: they are scored, are copies of each other, link with nothing, hold no benchmark passage, and
give no words to the mix, so none is in the result.  A null source is a source of its own.  Columns beside those of documents
are carried through every stage; one that has the name of a stage's result column (such as score, kept or taken) holds that
result from there on.  An empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.llm import exact, leaks, mixing, near, quality
from ledgerlight.session import scratch_root


#: Words of a shingle of the near-duplicate stage; the contract of op1_near_dedup has four.
NEAR_SHINGLE = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).where("predicted = 1").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(docs).where("kept").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.near_duplicates(docs, shingle=NEAR_SHINGLE).where("kept").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.benchmark_hits(docs, _table(spark, sf_dir, "benchmark")).where("not contaminated").select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("minhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing", mix_stage),
]

#: The first stage is a trained classifier, which SQL cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{scratch_root(spark)}/stage-{k}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
