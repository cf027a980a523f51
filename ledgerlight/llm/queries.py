"""The queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import context_tree, exact, language, leaks, mixing, near, personal, quality, ranked, secrets, simhash, toxic, whitening
from ledgerlight.llm.texts import remainder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"), carry=["doc_id"]).drop("redacted")


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.tree_scores(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.drop("cleaned")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_spans(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, model, carry=["doc_id"])
    held = remainder("doc_id", quality.FOLDS) == quality.HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxic.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxic.toxicity_scores(docs, machine, carry=["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", toxic.FOLDS) == toxic.HELD_OUT).alias("held_out"), "score", "predicted")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.language_predictions(docs, language.fit_language(docs), carry=["doc_id"])
    held = remainder("doc_id", language.FOLDS) == language.HELD_OUT
    return told.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), carry=["vec_id"])


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"), carry=["doc_id"])


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_near_dedup, op2_secrets, op3_lm_scores, op4_decontamination, op5_personal_data, op6_quality, op7_exact_dedup, op8_mixing, op9_toxicity, op10_language, op11_whitening,
                                 op12_ranked_search, op13_simhash)
}
ORACLES = {"op1_near_dedup": near.SQL, "op4_decontamination": leaks.SQL, "op7_exact_dedup": exact.SQL, "op8_mixing": mixing.SQL, "op12_ranked_search": ranked.SQL}
