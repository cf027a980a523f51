"""Feature table of the fraud model, its cleaning and its feature lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.scalars import safe_div
from ledgerlight.operators import clean
from ledgerlight.operators.joins import enrich
from ledgerlight.operators.ordered import MAX_ROWS

LABEL = "fraud_flag"
KEY = "transaction_id"

# Columns of the feature table, and ground truth that must never be in it.
FEATURE_TABLE = (
    "transaction_id", "client_id", "compte_touche", "agence_id", "date_transaction", "heure",
    "tranche_horaire", "jour_semaine", "is_weekend", "is_night", "montant", "frais_transaction",
    "type_transaction", "canal", "mode_paiement", "est_international", "hors_agence",
    "sens_operation", "device_id", "ip_address", "montant_moyen_client_30j",
    "ecart_type_client_30j", "nb_transactions_client_30j", "ecart_relatif_montant",
    "montant_cumule_client", "age", "segment_client", "tranche_revenu", "revenu_mensuel",
    "score_credit", "niveau_risque_client", "fraud_flag",
)
GROUND_TRUTH = ("fraud_type", "fraud_rule_triggered")
# Those of the customer that the cleaned transactions do not have.
CUSTOMER_COLUMNS = ("score_credit", "niveau_risque_client")

# The model features.
NUMERIC = (
    "montant", "frais_transaction", "ecart_relatif_montant", "ratio_montant_revenu",
    "taux_utilisation_30j", "montant_moyen_client_30j", "ecart_type_client_30j",
    "nb_transactions_client_30j", "montant_cumule_client",
)
CATEGORICAL = ("type_transaction", "mode_paiement", "sens_operation", "tranche_horaire")
BINARY = ("is_night", "is_weekend", "est_international")
FEATURES = (*NUMERIC, *CATEGORICAL, *BINARY)

# The features studied one by one.
STUDIED_NUMERIC = (
    "montant", "frais_transaction", "montant_moyen_client_30j", "ecart_type_client_30j",
    "nb_transactions_client_30j", "ecart_relatif_montant", "montant_cumule_client", "age",
    "revenu_mensuel", "score_credit", "ratio_montant_revenu", "taux_utilisation_30j",
)
STUDIED_CATEGORICAL = (
    "type_transaction", "canal", "mode_paiement", "sens_operation", "segment_client",
    "tranche_revenu", "niveau_risque_client", "tranche_horaire",
)
STUDIED_BINARY = ("is_night", "is_weekend", "est_international", "hors_agence")


def feature_table(transactions_silver: DataFrame, clients_silver: DataFrame) -> DataFrame:
    """One row per transaction: allow-listed columns and two ratios.

    Customer columns that the transactions already carry are not joined again.
    """
    lacking = [c for c in CUSTOMER_COLUMNS if c not in transactions_silver.columns]
    rows = enrich(transactions_silver, clients_silver, "client_id", lacking) if lacking else transactions_silver
    return clean.keep_columns(rows, FEATURE_TABLE, GROUND_TRUTH).withColumns(
        {
            "ratio_montant_revenu": safe_div("montant", "revenu_mensuel"),
            "taux_utilisation_30j": safe_div("montant", "montant_moyen_client_30j", 1.0),
        }
    )


def clean_features(
    features: DataFrame, fit_on: DataFrame | None = None, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Structural category, age indicator, medians and residual category.

    ``fit_on`` restricts the medians to training rows.  The residual fills do
    nothing when the customer join left no nulls.
    """
    rows = clean.fill_defaults(
        features, {"mode_paiement": clean.NOT_APPLICABLE, "niveau_risque_client": clean.UNKNOWN}
    )
    return clean.impute_medians(rows, ["age", "score_credit"], {"age": "age_manquant"}, fit_on, max_rows)


def missing_by_type(features: DataFrame) -> DataFrame:
    """Is the payment mode missing by structure?  Counts per type, known against missing."""
    known = F.col("mode_paiement").isNotNull()
    return features.groupBy("type_transaction").agg(
        F.count_if(~known).alias("absent"), F.count_if(known).alias("renseigne")
    )
