"""Model registry as append-only tables: metrics per run, alias events, folds over them.

versions: model string, version int, run_id string, run_name string, user string, date timestamp
events:   model string, alias string, version int, at timestamp, event_id long
metrics:  run_id string, pr_auc double, roc_auc double, lift double, ...
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.ordered import latest_per_key

CHAMPION, CHALLENGER = "champion", "challenger"
MINIMUM_LIFT = 2.0
NO_ALIAS = "—"
VERSION_SCHEMA = "model string, version int, run_id string, run_name string, user string, date timestamp"
EVENT_SCHEMA = "model string, alias string, version int, at timestamp, event_id long"


def metrics_row(
    summary: DataFrame, run_id: str, model: str, n_train: int, n_test: int, n_features: int, at: datetime
) -> DataFrame:
    """One row of figures per training run, from the curve summary."""
    return summary.select(
        F.lit(run_id).alias("run_id"), F.lit(model).alias("model_name"),
        "pr_auc", "roc_auc", "baseline_pr_auc", "lift",
        F.col("recall_at_precision").alias("recall_at_precision_80"),
        "best_threshold_f1", "best_f1", "best_threshold_cost",
        F.col("min_cost").alias("min_cost_mad"),
        F.lit(n_train).cast("long").alias("n_train"), F.lit(n_test).cast("long").alias("n_test"),
        F.lit(n_features).alias("n_features"), F.lit(at).alias("date_entrainement"),
    )


def next_version(versions: DataFrame, model: str) -> int:
    return (versions.filter(F.col("model") == model).agg(F.max("version")).first()[0] or 0) + 1


def version_row(spark, model: str, version: int, run_id: str, at: datetime, run_name: str | None = None, user: str | None = None) -> DataFrame:
    return spark.createDataFrame([(model, version, run_id, run_name, user, at)], VERSION_SCHEMA)


def gate_alias(lift: str = "lift", minimum: float = MINIMUM_LIFT):
    return F.when(F.col(lift) >= minimum, CHAMPION).otherwise(CHALLENGER)


def gate_events(versions: DataFrame, metrics: DataFrame, minimum: float = MINIMUM_LIFT) -> DataFrame:
    """Alias event of every new version: champion when its lift passes the gate."""
    return versions.join(metrics.select("run_id", "lift"), "run_id").select(
        "model", gate_alias("lift", minimum).alias("alias"), "version", F.col("date").alias("at"),
        F.col("version").cast("long").alias("event_id"),
    )


def promotion_event(spark, model: str, version: int, at: datetime, event_id: int, alias: str = CHAMPION) -> DataFrame:
    """Manual promotion of a version."""
    return spark.createDataFrame([(model, alias, int(version), at, event_id)], EVENT_SCHEMA)


def alias_holders(events: DataFrame) -> DataFrame:
    """Version each alias points to now: its last event."""
    return latest_per_key(events, ["model", "alias"], ["at", "event_id"]).select("model", "alias", "version")


def serving_versions(versions: DataFrame, events: DataFrame) -> DataFrame:
    """Per model the champion, or the newest version when it has none that still exists."""
    newest = versions.groupBy("model").agg(F.max("version").alias("_newest"))
    champion = (
        alias_holders(events).filter(F.col("alias") == CHAMPION)
        .join(versions.select("model", "version"), ["model", "version"], "left_semi")
        .select("model", F.col("version").alias("_champion"))
    )
    return newest.join(champion, "model", "left").select(
        "model", F.coalesce("_champion", "_newest").alias("version"),
        F.col("_champion").isNotNull().cast("int").alias("est_champion"),
    )


def resolve_champion(versions: DataFrame, events: DataFrame, model: str) -> int:
    row = serving_versions(versions, events).filter(F.col("model") == model).first()
    if row is None:
        raise ValueError(f"Aucune version du modèle {model} trouvée")
    return row["version"]


def version_list(versions: DataFrame, metrics: DataFrame, events: DataFrame) -> DataFrame:
    """Every version with its aliases and figures, newest version (as a number) first."""
    aliases = alias_holders(events).groupBy("model", "version").agg(
        F.array_join(F.sort_array(F.collect_list("alias")), ", ").alias("alias")
    )
    return (
        versions.join(aliases, ["model", "version"], "left")
        .join(metrics.select("run_id", "pr_auc", "roc_auc", "lift"), "run_id", "left")
        .select(
            "model", "version", F.coalesce("alias", F.lit(NO_ALIAS)).alias("alias"),
            F.coalesce("run_name", F.lit(NO_ALIAS)).alias("run_name"), "pr_auc", "roc_auc", "lift", "date",
            "run_id", F.coalesce("user", F.lit("inconnu")).alias("user"),
        )
        .orderBy("model", F.desc("version"))
    )
