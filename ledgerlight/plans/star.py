"""Star schema: three dimensions, three facts, and the measures read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.operators import clean, quality
from ledgerlight.operators.joins import latest_join

# First and last day of the time dimension.
FIRST_DAY, LAST_DAY = "2020-01-01", "2026-12-31"
# Columns of the dimensions and facts.
DIM_CLIENT = (
    "client_id", "type_client", "civilite", "nom_complet", "age", "ville", "region", "segment_client",
    "tranche_revenu", "revenu_mensuel", "score_credit", "niveau_risque_client", "statut_client",
    "anciennete_annees", "agence_id",
)
DIM_AGENCE = ("agence_id", "nom_agence", "ville", "region", "type_agence", "date_ouverture")
FACT_TRANSACTIONS = (
    "transaction_id", "client_id", "agence_id", "date_key", "date_transaction", "montant",
    "frais_transaction", "canal", "type_transaction", "mode_paiement", "sens_operation",
    "est_international", "is_weekend", "is_night", "hors_agence", "fraud_flag", "fraud_type",
    "fraud_rule_triggered",
)
LOAN_COLUMNS = (
    "credit_id", "client_id", "agence_id", "date_key", "type_credit", "montant_initial",
    "montant_restant_du", "taux_interet_nominal", "duree_totale_mois", "duree_restante_mois",
    "montant_mensualite", "jours_retard", "statut_credit", "classification_bale",
    "provision_constituee",
)
CLASSIFICATION_COLUMNS = (
    "categorie_reglementaire", "categorie_bale_ii", "categorie_ifrs9", "probabilite_defaut_pd",
    "perte_en_cas_defaut_lgd", "exposition_en_cas_defaut_ead", "perte_attendue_el",
    "provision_requise", "taux_provisionnement",
)
FACT_LIQUIDITE = (
    "ratio_id", "agence_id", "date_key", "niveau_consolidation", "type_ratio", "lcr_ratio",
    "lcr_conforme", "nsfr_ratio", "nsfr_conforme", "depot_total", "credit_total",
    "ratio_credit_depot", "statut_global", "alerte_niveau",
)


def dim_client(clients_silver: DataFrame) -> DataFrame:
    rows = clean.keep_columns(clients_silver, DIM_CLIENT)
    return clean.dedup(rows, ["client_id"], DIM_CLIENT)


def dim_agence(agences_silver: DataFrame) -> DataFrame:
    rows = clean.keep_columns(agences_silver, DIM_AGENCE)
    return clean.dedup(rows, ["agence_id"], DIM_AGENCE)


def dim_temps(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds: ``standard_bounds`` or ``bounds_of`` a fact."""
    return D.calendar(bounds).withColumns(D.calendar_columns("date"))


def standard_bounds(spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(FIRST_DAY).cast("date").alias("start"), F.lit(LAST_DAY).cast("date").alias("end")
    )


def bounds_of(df: DataFrame, time_col: str) -> DataFrame:
    """First and last day of a table, widened to whole years."""
    first, last = F.min(time_col), F.max(time_col)
    return df.agg(first.alias("a"), last.alias("b")).select(
        F.make_date(F.year("a"), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year("b"), F.lit(12), F.lit(31)).alias("end"),
    )


def fact_transactions(transactions_silver: DataFrame) -> DataFrame:
    keyed = transactions_silver.withColumn("date_key", D.date_key("date_transaction"))
    return clean.keep_columns(keyed, FACT_TRANSACTIONS)


def fact_credits(
    credits_silver: DataFrame, classification_silver: DataFrame,
    newest: Sequence[str] = ("date_classification", "classification_id"),
) -> DataFrame:
    """Loans with their latest classification; one row per loan."""
    loans = clean.keep_columns(credits_silver.withColumn("date_key", D.date_key("date_octroi")), LOAN_COLUMNS)
    return latest_join(loans, classification_silver, "credit_id", newest, CLASSIFICATION_COLUMNS)


def fact_liquidite(ratios_silver: DataFrame) -> DataFrame:
    keyed = ratios_silver.withColumn("date_key", D.date_key("date_calcul"))
    return clean.keep_columns(keyed, FACT_LIQUIDITE)


def integrity(
    transactions: DataFrame, credits: DataFrame, liquidite: DataFrame,
    clients: DataFrame, agences: DataFrame, temps: DataFrame,
) -> DataFrame:
    """The six foreign keys of the star; a liquidity row may have no branch."""
    client, agence = ("client_id", "dim_client", clients, "client_id"), ("agence_id", "dim_agence", agences, "agence_id")
    temps_link = ("date_key", "dim_temps", temps, "date_key")
    return quality.integrity_report(
        [
            quality.integrity_of("fact_transactions", transactions, [(*link, False) for link in (client, agence, temps_link)]),
            quality.integrity_of("fact_credits", credits, [(*client, False), (*agence, False)]),
            quality.integrity_of("fact_liquidite", liquidite, [(*agence, True)]),
        ]
    )


# --- measures ----------------------------------------------------------------
# Facts are reduced to their keys before they meet a dimension, so the join
# sees a few rows per day or branch instead of all transactions.

def fraud_by_month(transactions: DataFrame, temps: DataFrame) -> DataFrame:
    daily = transactions.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"), F.sum("fraud_flag").alias("f"))
    return (
        daily.join(temps.select("date_key", "mois_annee"), "date_key")
        .groupBy("mois_annee")
        .agg(F.sum("n").alias("transactions"), F.sum("f").alias("fraudes"))
        .withColumn("taux_fraude", F.col("fraudes") / F.col("transactions"))
    )


def volume_by_channel(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("canal").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("montant").alias("volume"),
        F.avg(F.col("fraud_flag").cast("double")).alias("taux_fraude"),
    )


def fraud_by_place(transactions: DataFrame, agences: DataFrame) -> DataFrame:
    per_branch = transactions.groupBy("agence_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fraud_flag").alias("f"), F.sum("montant").alias("m")
    )
    return (
        per_branch.join(agences.select("agence_id", "region", "ville"), "agence_id")
        .groupBy("region", "ville")
        .agg(F.sum("n").alias("transactions"), F.sum("f").alias("fraudes"), F.sum("m").alias("volume"))
        .withColumn("taux_fraude", F.col("fraudes") / F.col("transactions"))
    )


def outstanding_by_category(credits: DataFrame) -> DataFrame:
    return credits.groupBy("categorie_reglementaire").agg(
        F.count(F.lit(1)).alias("credits"), F.sum("montant_restant_du").alias("encours"),
        F.sum("perte_attendue_el").alias("perte_attendue"),
    )


def liquidity_by_month(liquidite: DataFrame, temps: DataFrame) -> DataFrame:
    """Mean LCR and NSFR per month, and how many series conform."""
    return (
        liquidite.join(temps.select("date_key", "mois_annee"), "date_key")
        .groupBy("mois_annee")
        .agg(
            F.avg("lcr_ratio").alias("lcr_moyen"), F.avg("nsfr_ratio").alias("nsfr_moyen"),
            F.count_if(F.col("lcr_conforme") & F.col("nsfr_conforme")).alias("series_conformes"),
        )
    )
