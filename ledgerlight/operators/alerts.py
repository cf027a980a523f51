"""Alerts, audit log and import history as append-only tables with folds over them.

alerts:  alert_id, user_id, transaction_data (JSON text), score, decision, niveau_risque, created_at
states:  alert_id (null for a whole user), user_id, action, at
audit:   log_id, user_id, action, details, created_at
imports: import_id, user_id, filename, results (JSON text), created_at
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import scalars as S
from ledgerlight.operators.ordered import latest_n, spread_join
from ledgerlight.sources.tables import append_once

# Actions on alerts.
READ, READ_ALL, DELETED = "lu", "tout_lu", "supprime"
RESULT_FIELDS = "montant double, type_transaction string, score double, decision string, niveau_risque string"
ALERT_LIMIT, AUDIT_LIMIT, IMPORT_LIMIT = 50, 100, 5


def fraud_alerts(
    scored: DataFrame, key: str, user: str, at: str, payload: Sequence[str | Column], score: str = "fraud_proba"
) -> DataFrame:
    """One unread alert per transaction decided as fraud, its payload as JSON text."""
    return scored.filter(S.decision(score) == S.FRAUD).select(
        F.col(key).alias("alert_id"), F.col(user).alias("user_id"),
        S.json_text(*payload).alias("transaction_data"),
        F.col(score).alias("score"), S.decision(score).alias("decision"),
        S.score_level(score).alias("niveau_risque"), F.col(at).alias("created_at"),
    )


# --- appends: every event once, however often its lot is delivered ----------

def append_alerts(alerts: DataFrame, path: str, lot: str) -> None:
    append_once(alerts, path, lot, ["alert_id"], "created_at")


def append_states(states: DataFrame, path: str, lot: str) -> None:
    """Read, read-all and delete actions, known by all their parts."""
    append_once(states, path, lot, ["alert_id", "user_id", "action", "at"], "at")


def append_audit(audit: DataFrame, path: str, lot: str) -> None:
    append_once(audit, path, lot, ["log_id"], "created_at")


def append_imports(imports: DataFrame, path: str, lot: str) -> None:
    append_once(imports, path, lot, ["import_id"], "created_at")


def fold_states(alerts: DataFrame, states: DataFrame) -> DataFrame:
    """Alerts not deleted, with ``lu`` 0/1.

    "Read all" of a user covers the alerts created up to its time.  Both
    kinds of action are reduced before they meet the alerts.
    """
    single = (
        states.filter(F.col("alert_id").isNotNull())
        .groupBy("alert_id")
        .agg(
            F.bool_or(F.col("action") == READ).alias("_read"),
            F.bool_or(F.col("action") == DELETED).alias("_gone"),
        )
    )
    whole = states.filter(F.col("action") == READ_ALL).groupBy("user_id").agg(F.max("at").alias("_all_at"))
    no = F.lit(False)
    read = F.coalesce("_read", no) | F.coalesce(F.col("created_at") <= F.col("_all_at"), no)
    return (
        spread_join(alerts, whole, ["user_id"])
        .join(single, "alert_id", "left")
        .filter(~F.coalesce("_gone", no))
        .withColumn("lu", read.cast("int"))
        .drop("_read", "_gone", "_all_at")
    )


def unread_counts(folded: DataFrame) -> DataFrame:
    return folded.groupBy("user_id").agg(F.count_if(F.col("lu") == 0).alias("non_lues"))


def latest_alerts(
    folded: DataFrame, limit: int = ALERT_LIMIT, unread_only: bool = False, user=None, decision: str | None = None,
    level: str | None = None,
) -> DataFrame:
    """Newest alerts per user, by time and then id; of one user, decision or risk level if given."""
    rows = folded if user is None else folded.filter(F.col("user_id") == user)
    rows = rows if decision is None else rows.filter(F.col("decision") == decision)
    rows = rows if level is None else rows.filter(F.col("niveau_risque") == level)
    rows = rows.filter(F.col("lu") == 0) if unread_only else rows
    return latest_n(rows, ["user_id"], ["created_at", "alert_id"], limit)


def activity_stats(users: DataFrame, folded: DataFrame, active: str = "actif") -> DataFrame:
    """Active users, alerts, unread alerts and frauds, as one row."""
    people = users.agg(F.count_if(F.col(active) == 1)).scalar()
    return folded.agg(
        F.count(F.lit(1)).alias("n_alerts"), F.count_if(F.col("lu") == 0).alias("n_unread"),
        F.count_if(F.col("decision") == S.FRAUD).alias("n_frauds"),
    ).select(people.alias("n_users"), "n_alerts", "n_unread", "n_frauds")


def audit_trail(audit: DataFrame, limit: int = AUDIT_LIMIT, user=None) -> DataFrame:
    """Newest log rows of one user, or of all."""
    rows = audit if user is None else audit.filter(F.col("user_id") == user)
    return rows.orderBy(F.desc("created_at"), F.desc("log_id")).limit(limit)


def audit_per_user(audit: DataFrame, limit: int = AUDIT_LIMIT) -> DataFrame:
    return latest_n(audit, ["user_id"], ["created_at", "log_id"], limit)


def import_history(imports: DataFrame, limit: int = IMPORT_LIMIT) -> DataFrame:
    """Newest imports per user with their row and fraud counts; unreadable results count 0."""
    newest = latest_n(imports, ["user_id"], ["created_at", "import_id"], limit)
    rows = S.json_rows("results", RESULT_FIELDS)
    return newest.withColumns({"lignes": F.size(rows), "fraudes": S.decided_rows(rows)}).drop("results")
