"""The daily run as a list of stages: files to raw, cleaned, star, features, scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators import model as M
from ledgerlight.operators import registry
from ledgerlight.operators.boosting import BoostedTrees
from ledgerlight.operators.clean import assert_no_nulls, require_columns
from ledgerlight.operators.ranks import curve_summary, score_curve
from ledgerlight.operators.scoring import model_scorer, score_batch
from ledgerlight.plans import features as feat
from ledgerlight.plans import silver, star
from ledgerlight.sources import tables as T
from ledgerlight.sources.schemas import COLUMNS

#: A file with a larger share of rows that do not fit its schema stops the run.
MOST_BAD = 0.1
MODEL = "fraud_detection_model"


@dataclass
class Run:
    """Where one run reads and writes, and the day it counts ages from."""

    spark: SparkSession
    files: str
    base: str
    as_of: Column
    at: datetime
    max_iter: int = M.MAX_ITER
    exported: bool = False      # the files come from ``export_csv``
    minimum_lift: float = registry.MINIMUM_LIFT

    def path(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return T.read_table(self.spark, self.path(layer, table))

    def write(self, df: DataFrame, layer: str, table: str) -> None:
        T.write_table(df, self.path(layer, table))

    def history(self, table: str, schema: str) -> DataFrame:
        return T.read_history_or_empty(self.spark, self.path("ml", table), schema)


def to_raw(run: Run) -> None:
    for entity in COLUMNS:
        df, bad = T.split_bad_rows(T.read_csv(run.spark, f"{run.files}/{entity}.csv", entity, keep_bad_rows=True, exported=run.exported))
        run.write(bad, "quarantine", entity)
        good, refused = df.count(), run.read("quarantine", entity).count()
        if refused > MOST_BAD * (good + refused):
            raise ValueError(f"{entity}: {refused} of {good + refused} rows do not fit the schema")
        if entity == "transactions":
            T.write_monthly(df, run.path("raw", entity), "date_transaction")
        else:
            run.write(df, "raw", entity)


def to_silver(run: Run) -> None:
    run.write(silver.branches(run.read("raw", "agences")), "silver", "agences")
    run.write(silver.clients(run.read("raw", "clients"), run.as_of), "silver", "clients")
    run.write(silver.accounts(run.read("raw", "comptes"), run.as_of), "silver", "comptes")
    rows = silver.transactions(
        run.read("raw", "transactions"), run.read("silver", "clients"), run.read("silver", "comptes")
    )
    T.write_monthly(rows, run.path("silver", "transactions"), "date_transaction")
    run.write(silver.loans(run.read("raw", "credits")), "silver", "credits")
    run.write(silver.classifications(run.read("raw", "classification_creances")), "silver", "classification_creances")
    run.write(silver.liquidity(run.read("raw", "ratios_liquidite")), "silver", "ratios_liquidite")


def to_star(run: Run) -> None:
    run.write(star.dim_client(run.read("silver", "clients")), "gold", "dim_client")
    run.write(star.dim_agence(run.read("silver", "agences")), "gold", "dim_agence")
    run.write(star.dim_temps(star.standard_bounds(run.spark)), "gold", "dim_temps")
    run.write(star.fact_transactions(run.read("silver", "transactions")), "gold", "fact_transactions")
    facts = star.fact_credits(run.read("silver", "credits"), run.read("silver", "classification_creances"))
    run.write(facts, "gold", "fact_credits")
    run.write(star.fact_liquidite(run.read("silver", "ratios_liquidite")), "gold", "fact_liquidite")


def to_features(run: Run) -> None:
    rows = feat.feature_table(run.read("silver", "transactions"), run.read("silver", "clients"))
    run.write(rows, "gold", "features")
    # Medians come from the training rows; the split depends on keys and labels alone, so training finds the same one.
    features = run.read("gold", "features")
    fit_on = M.stratified_split(features, feat.KEY, feat.LABEL).filter("partie = 'train'")
    run.write(feat.clean_features(features, fit_on), "ml", "features_clean")
    assert_no_nulls(run.read("ml", "features_clean"), [*feat.FEATURES, "age", "score_credit", feat.LABEL])


def train(run: Run) -> tuple[BoostedTrees, DataFrame]:
    """Split, encode, fit, evaluate; appends the metrics, the version and its alias event.

    Each version has its own folders, so a run below the gate leaves the champion as it is.  The
    event comes last: a run that dies before leaves a version without an alias.
    """
    parts = M.stratified_split(run.read("ml", "features_clean"), feat.KEY, feat.LABEL)
    run.write(parts, "ml", "split")
    parts = run.read("ml", "split")
    train_rows, test_rows = (parts.filter(parts["partie"] == p) for p in ("train", "test"))
    version = registry.next_version(run.history("versions", registry.VERSION_SCHEMA), MODEL)
    run.write(M.fit_encoder(train_rows, feat.CATEGORICAL), "ml", f"encoder/{version}")
    encoder = run.read("ml", f"encoder/{version}")
    fitted = M.fit_model(
        M.apply_encoder(train_rows, encoder, feat.CATEGORICAL), feat.FEATURES, feat.LABEL, max_iter=run.max_iter
    )
    fitted.save(run.spark, run.path("ml", f"model/{version}"))
    scored = model_scorer(fitted, encoder, feat.CATEGORICAL)(test_rows)
    summary = curve_summary(score_curve(scored, feat.LABEL, "fraud_proba"))
    run_id = f"{run.at:%Y%m%d%H%M%S}-{version}"
    metrics = registry.metrics_row(
        summary, run_id, MODEL, train_rows.count(), test_rows.count(), len(feat.FEATURES), run.at
    )
    T.append_history(metrics, run.path("ml", "metrics"))
    made = T.read_history(run.spark, run.path("ml", "metrics")).filter(F.col("run_id") == run_id)
    row = registry.version_row(run.spark, MODEL, version, run_id, run.at)
    T.append_history(row, run.path("ml", "versions"))
    T.append_history(registry.gate_events(row, made, run.minimum_lift), run.path("ml", "events"))
    return fitted, encoder


def to_scores(run: Run) -> None:
    """Score every transaction with the model and encoder of the champion."""
    versions, events = run.history("versions", registry.VERSION_SCHEMA), run.history("events", registry.EVENT_SCHEMA)
    version = registry.resolve_champion(versions, events, MODEL)
    fitted = BoostedTrees.load(run.spark, run.path("ml", f"model/{version}"))
    rows = require_columns(run.read("ml", "features_clean"), feat.FEATURES)
    scorer = model_scorer(fitted, run.read("ml", f"encoder/{version}"), feat.CATEGORICAL)
    run.write(score_batch(rows, scorer, version, run.at, feat.LABEL), "ml", "scores")


STAGES: tuple[Callable[[Run], object], ...] = (to_raw, to_silver, to_star, to_features, train, to_scores)


def run_all(run: Run) -> None:
    for stage in STAGES:
        stage(run)
