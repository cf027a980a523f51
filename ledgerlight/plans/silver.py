"""Cleaned layer: one function per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.functions import scalars as S
from ledgerlight.operators import clean, risk
from ledgerlight.operators.joins import enrich
from ledgerlight.operators.ordered import MAX_ROWS, ordered_features, time_features

PREVIOUS_ROWS = 30

# Columns of the cleaned branches table.
BRANCH_COLUMNS = (
    "agence_id", "nom_agence", "adresse", "ville", "code_postal", "region", "pays", "telephone",
    "email", "directeur", "date_ouverture", "type_agence", "latitude", "longitude",
)
# Columns of the cleaned transactions table.
TRANSACTION_COLUMNS = (
    "transaction_id", "compte_id", "client_id", "agence_id", "date_transaction", "compte_touche",
    "sens_operation", "date_valeur", "heure_transaction", "heure", "tranche_horaire", "montant",
    "devise", "type_transaction", "categorie", "sous_categorie", "canal", "mode_paiement",
    "statut_transaction", "reference_transaction", "libelle", "merchant_id", "code_mcc",
    "nom_marchand", "pays_marchand", "ville_transaction", "pays_origine", "pays_destination",
    "numero_carte_masque", "terminal_id", "frais_transaction", "solde_avant", "solde_apres",
    "latitude", "longitude", "ip_address", "device_id", "is_international", "est_international",
    "is_weekend", "is_night", "fraud_flag", "fraud_type", "fraud_rule_triggered", "jour_semaine",
    "mois_annee", "age", "segment_client", "tranche_revenu", "revenu_mensuel", "type_compte",
    "montant_moyen_client_30j", "ecart_type_client_30j", "nb_transactions_client_30j",
    "ecart_relatif_montant", "montant_cumule_client", "hors_agence",
)


def branches(agences: DataFrame) -> DataFrame:
    one = clean.drop_null_keys(clean.dedup(agences, ["agence_id"], agences.columns), ["agence_id"])
    return one.withColumn("email", S.replace_mail_domain("email", "gmail.com", "banque.com")).select(*BRANCH_COLUMNS)


def clients(clients: DataFrame, as_of: Column | None = None) -> DataFrame:
    as_of = F.current_date() if as_of is None else as_of
    return clients.withColumns(
        {
            "age": D.whole_years("date_naissance", as_of),
            "anciennete_annees": D.whole_years("date_premier_contact", as_of),
            "tranche_revenu": S.income_band("revenu_mensuel"),
            "statut_client_binaire": S.equals_flag("statut_client", "Actif"),
            "nom_complet": S.full_name(),
        }
    ).drop("nom", "prenom")


def accounts(comptes: DataFrame, as_of: Column | None = None) -> DataFrame:
    as_of = F.current_date() if as_of is None else as_of
    return comptes.withColumns(
        {
            "anciennete_compte_mois": D.months_since("date_ouverture", as_of),
            "est_actif": S.equals_flag("statut_compte", "Actif"),
            "solde_normalise": S.scaled_balance("type_compte", "solde"),
        }
    )


def behaviour(
    transactions: DataFrame, previous: int = PREVIOUS_ROWS, max_rows: int = MAX_ROWS, mode: str = "rows"
) -> DataFrame:
    """What the customer did before: mean, deviation and count, gap, cumulative amount.

    ``mode``: "rows" looks at the ``previous`` rows, "days" at the rows of the ``previous`` days before.
    """
    if mode not in ("rows", "days"):
        raise ValueError("mode is rows or days")
    order = ["date_transaction", "transaction_id"]
    mean = "montant_moyen_client_30j"
    frame = {
        mean: F.avg("montant"),
        "ecart_type_client_30j": F.stddev("montant"),
        "nb_transactions_client_30j": F.count("transaction_id"),
    }
    rows = ordered_features(
        transactions, ["client_id"], order, previous, frame=frame if mode == "rows" else None,
        running={"montant_cumule_client": F.col("montant")}, max_rows=max_rows,
    )
    if mode == "days":
        rows = time_features(rows, ["client_id"], "date_transaction", order, previous, frame, max_rows)
    rows = clean.fill_defaults(
        rows, {mean: 0.0, "ecart_type_client_30j": 0.0, "nb_transactions_client_30j": 0}
    )
    return rows.withColumn("ecart_relatif_montant", S.safe_div(F.col("montant") - F.col(mean), mean))


def with_context(
    transactions: DataFrame, clients_silver: DataFrame, accounts_silver: DataFrame, more: Sequence[str] = ()
) -> DataFrame:
    """Customer columns (``more`` beside the table's own) and account columns, time parts and flags; row-wise work only."""
    rows = enrich(
        transactions, clients_silver, "client_id",
        ["age", "ville", "segment_client", "tranche_revenu", "revenu_mensuel", *more],
    )
    rows = enrich(rows, accounts_silver, "compte_source_id", ["type_compte"], right_key="compte_id")
    return rows.withColumns(
        {
            "jour_semaine": F.dayofweek("date_transaction"),
            "mois_annee": D.year_month("date_transaction"),
            "heure": D.hour_of_clock("heure_transaction"),
        }
    ).withColumns(
        {
            "tranche_horaire": D.day_band("heure"),
            "est_international": S.abroad_flag("pays_marchand", "pays_destination"),
            "hors_agence": S.elsewhere_flag("ville_transaction", "ville"),
            "compte_touche": S.touched_account("compte_source_id", "compte_destination_id"),
            "sens_operation": S.direction("compte_source_id", "compte_destination_id"),
        }
    )


def transactions(
    transactions: DataFrame, clients_silver: DataFrame, accounts_silver: DataFrame,
    columns: Sequence[str] = TRANSACTION_COLUMNS, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Cleaned transactions: joins, window features and flags in one plan.

    Columns that the table itself does not have are taken from the customer, in the same join; a column
    found nowhere is an error.
    """
    # Windows first: their exchange on the customer also serves the join that follows.
    more = [c for c in columns if c not in TRANSACTION_COLUMNS]
    rows = with_context(behaviour(transactions, max_rows=max_rows), clients_silver, accounts_silver, more)
    return clean.keep_columns(rows, columns)


def loans(credits: DataFrame) -> DataFrame:
    return risk.loan_ratios(credits)


def classifications(classification: DataFrame) -> DataFrame:
    return risk.classification_ratios(classification)


def liquidity(ratios: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    return risk.monthly_changes(ratios, max_rows=max_rows)
