"""Scoring side: bare transactions, batches, uploaded files, score queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.functions import scalars as S
from ledgerlight.operators import clean, quality
from ledgerlight.operators.boosting import BoostedTrees
from ledgerlight.operators.model import add_probability, apply_encoder, model_features

SCORE = "fraud_proba"
ERROR = "ERREUR"
REASON_LENGTH = 80
MAX_SCORE_ROWS = 100_000
# Names under which the true label may arrive, in order of preference.
TRUTH_NAMES = (
    "fraud_flag_reel", "fraud_actual", "actual_label", "fraud_label", "label", "target", "is_fraud", "fraud",
)
TRUTH = "actual_label"


def bare_features(rows: DataFrame) -> DataFrame:
    """The model features of a transaction without history: neutral values."""
    amount = F.col("montant").cast("double")
    return rows.withColumns(
        {
            "frais_transaction": S.fee_estimate("type_transaction", "montant"),
            "ecart_relatif_montant": F.lit(0.0),
            "ratio_montant_revenu": F.lit(0.0),
            "taux_utilisation_30j": F.lit(1.0),
            "montant_moyen_client_30j": amount,
            "ecart_type_client_30j": F.lit(0.0),
            "nb_transactions_client_30j": F.lit(5),
            "montant_cumule_client": amount,
            "sens_operation": S.direction_by_type("type_transaction"),
            "tranche_horaire": D.day_band("heure"),
            "is_night": D.is_night("heure"),
        }
    )


def model_scorer(model: BoostedTrees, encoder: DataFrame, encoded: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Function that adds ``fraud_proba``; the encoder is only applied, never fitted."""
    quality.require_encoder_match(list(encoded), model_features(model))

    def score(rows: DataFrame) -> DataFrame:
        clean.require_columns(rows, model_features(model))
        kept = {f"_raw_{c}": F.col(c) for c in encoded}
        coded = apply_encoder(rows.withColumns(kept), encoder, encoded)
        scored = add_probability(coded, model, SCORE)
        return scored.withColumns({c: F.col(f"_raw_{c}") for c in encoded}).drop(*kept)

    # For code that scores many variants of a row (permutation importance).
    score.trees, score.coded = model, lambda rows: apply_encoder(rows, encoder, encoded)
    return score


def verdict(rows: DataFrame, score: str = SCORE) -> DataFrame:
    """Percent, decision, risk level and fraud flag of a score."""
    return rows.withColumns(
        {
            "pourcentage": S.percent(score),
            "decision": S.decision(score),
            "niveau_risque": S.score_level(score),
            "est_fraude": F.col(score) >= 0.5,
        }
    )


def score_batch(
    rows: DataFrame, scorer: Callable[[DataFrame], DataFrame], version: int, at: datetime,
    truth: str | None = None, threshold: float = 0.5,
) -> DataFrame:
    """Score table: key, customer, amount, score, decision, truth, model version, time."""
    real = F.col(truth) if truth else F.lit(None).cast("int")
    return scorer(rows).select(
        "transaction_id", "client_id", "montant", F.col(SCORE),
        F.when(F.col(SCORE) >= threshold, 1).otherwise(0).alias("fraud_predicted"),
        real.alias("fraud_flag_reel"),
        F.lit(version).alias("model_version"), F.lit(at).alias("date_scoring"),
    )


def with_truth(rows: DataFrame) -> DataFrame:
    """Expose the true label under one name when any known name is present."""
    found = next((c for c in TRUTH_NAMES if c in rows.columns), None)
    return rows if found in (None, TRUTH) else rows.withColumn(TRUTH, F.col(found))


def scores_above(scores: DataFrame, threshold: float = 0.5, limit: int = 500, key: str = "transaction_id") -> DataFrame:
    """Highest scores at or above a threshold; ties by key."""
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be in [0, 1]")
    if not 1 <= limit <= MAX_SCORE_ROWS:
        raise ValueError(f"limit must be in [1, {MAX_SCORE_ROWS}]")
    return with_truth(scores.filter(F.col(SCORE) >= threshold)).orderBy(F.desc(SCORE), key).limit(limit)


def score_upload(raw: DataFrame, scorer: Callable[[DataFrame], DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """Result rows of an uploaded file: scored rows, and bad rows as ``ERREUR`` with the reason, whole in ``erreurs``."""
    clean.require_columns(raw, clean.REQUIRED_UPLOAD)
    good, bad = clean.quarantine(clean.validate_rows(raw))
    scored = verdict(scorer(bare_features(good))).select(
        *keep, F.col("montant_texte").alias("montant"), "type_transaction",
        F.round(SCORE, 4).alias("score"), "decision", "niveau_risque",
        F.lit(None).cast("string").alias("erreurs"),
    )
    rejected = bad.select(
        *keep, F.col("montant_texte").alias("montant"), "type_transaction",
        F.lit(None).cast("double").alias("score"), F.lit(ERROR).alias("decision"),
        F.substring(F.array_join("errors", " ; "), 1, REASON_LENGTH).alias("niveau_risque"),
        F.array_join("errors", " ; ").alias("erreurs"),
    )
    return scored.unionByName(rejected)
