"""Column expressions: guarded ratios, bands, flags, texts and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlight.functions.dates import _c

HOME_COUNTRY = "MA"

# Band edges and labels.
INCOME_EDGES = (5000, 15000, 30000, 50000)
INCOME_LABELS = ("0-5k", "5k-15k", "15k-30k", "30k-50k", "50k+")
CREDIT_EDGES = (650, 750)
CREDIT_LABELS = ("Élevé", "Moyen", "Faible")
SCORE_EDGES = (0.2, 0.5, 0.8)
SCORE_LABELS = ("Faible", "Moyen", "Élevé", "Très élevé")
EFFECT_EDGES = (0.03, 0.10, 0.30)
EFFECT_LABELS = ("Négligeable", "Faible", "Modéré", "Fort")
FRAUD, NORMAL = "FRAUDE", "NORMAL"
KEEP, DROP = "Garder", "Écarter (effet négligeable malgré p-value)"
DEBIT, CREDIT, INTERNAL, OTHER = "Débit", "Crédit", "Virement interne", "Autre"
DEBIT_TYPES = ("Paiement", "Retrait", "Prélèvement")


# --- arithmetic ------------------------------------------------------------

def safe_div(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """``num / den``; ``default`` for a zero or null denominator."""
    den = _c(den)
    return F.when(den != 0, _c(num) / den).otherwise(F.lit(default))


def band(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open band ``[edge, next edge)``; null takes the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    col = _c(col)
    out = F
    for edge, label in zip(edges, labels):
        out = out.when(col < edge, label)
    return out.otherwise(labels[-1])


def income_band(income: Column | str) -> Column:
    return band(income, INCOME_EDGES, INCOME_LABELS)


def credit_risk_level(score: Column | str) -> Column:
    return band(score, CREDIT_EDGES, CREDIT_LABELS)


def score_level(score: Column | str) -> Column:
    return band(score, SCORE_EDGES, SCORE_LABELS)


def decision(score: Column | str, threshold: float = 0.5) -> Column:
    return F.when(_c(score) >= threshold, FRAUD).otherwise(NORMAL)


def percent(score: Column | str) -> Column:
    return F.round(_c(score) * 100, 2)


def effect_label(effect: Column | str) -> Column:
    return band(effect, EFFECT_EDGES, EFFECT_LABELS)


def effect_decision(label: Column | str) -> Column:
    return F.when(_c(label) != EFFECT_LABELS[0], KEEP).otherwise(DROP)


def customer_segment(kind: Column | str, income: Column | str) -> Column:
    """Deterministic part of the segment rule; the split of firms is not a rule."""
    income = _c(income)
    return (
        F.when(_c(kind) == "Entreprise", "PME")
        .when(income > 30000, "Particuliers aisés")
        .otherwise("Particuliers standard")
    )


def fee_estimate(kind: Column | str, amount: Column | str) -> Column:
    """0.5 % of a payment, nothing for other types."""
    return F.when(_c(kind) == "Paiement", F.round(_c(amount) * 0.005, 2)).otherwise(0.0)


def annuity(principal: Column | str, yearly_rate: Column | str, months: Column | str) -> Column:
    """Constant monthly payment; null where it is undefined (no rate, no duration)."""
    monthly = _c(yearly_rate) / 12
    return F.round(F.try_divide(_c(principal) * monthly, 1 - F.pow(1 + monthly, -_c(months))), 2)


def scaled_balance(kind: Column | str, balance: Column | str) -> Column:
    """Relative scale per account type."""
    return _c(balance) / F.when(_c(kind) == "Compte épargne", 1000).otherwise(10000)


# --- flags -----------------------------------------------------------------

def flag(condition: Column) -> Column:
    """1 where true; 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def equals_flag(col: Column | str, value: str) -> Column:
    return flag(_c(col) == value)


def abroad_flag(merchant: Column | str, target: Column | str, home: str = HOME_COUNTRY) -> Column:
    return flag((_c(merchant) != home) | (_c(target) != home))


def elsewhere_flag(town: Column | str, home_town: Column | str) -> Column:
    """1 when both towns are known and differ."""
    return flag(_c(town) != _c(home_town))


def touched_account(source: Column | str, target: Column | str) -> Column:
    return F.coalesce(_c(source), _c(target))


def direction(source: Column | str, target: Column | str) -> Column:
    """Direction read off which account columns are filled (training side)."""
    has_source, has_target = _c(source).isNotNull(), _c(target).isNotNull()
    return (
        F.when(has_source & has_target, INTERNAL)
        .when(has_source, DEBIT)
        .when(has_target, CREDIT)
        .otherwise(OTHER)
    )


def direction_by_type(kind: Column | str) -> Column:
    """Direction for a bare transaction without accounts (serving side).

    It differs from ``direction``: a transfer is a credit here.  Both are kept,
    because a model trained on one is served with the other.
    """
    return F.when(_c(kind).isin(*DEBIT_TYPES), DEBIT).otherwise(CREDIT)


# --- texts -----------------------------------------------------------------

def normalised(text: Column | str) -> Column:
    return F.lower(F.trim(_c(text)))


def replace_mail_domain(mail: Column | str, old: str, new: str) -> Column:
    """Replace a mail domain taken literally, dots included."""
    return F.replace(_c(mail), F.lit("@" + old), F.lit("@" + new))


def full_name(kind: Column | str = "type_client") -> Column:
    """Title, first and last name of a person; company name of a firm."""
    kind = _c(kind)
    blank = F.lit("")
    person = F.concat_ws(
        " ", F.coalesce("civilite", blank), F.coalesce("prenom", blank), F.coalesce("nom", blank)
    )
    return (
        F.when(kind == "Particulier", person)
        .when(kind == "Entreprise", F.coalesce("raison_sociale", "nom"))
        .otherwise(F.col("nom"))
    )


def matched_names(rules: dict[str, Column], sep: str = " ") -> Column:
    """Names of the rules that hold, in the given order, as one text."""
    return F.concat_ws(sep, *[F.when(cond, name) for name, cond in rules.items()])


# --- JSON ------------------------------------------------------------------

def json_text(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))


def json_rows(text: Column | str, fields: str) -> Column:
    """JSON array text as an array of structs; unreadable text as an empty array."""
    parsed = F.from_json(_c(text), f"array<struct<{fields}>>")
    return F.coalesce(parsed, F.array().cast(f"array<struct<{fields}>>"))


def json_object(text: Column | str, fields: str) -> Column:
    """JSON object text as a struct; unreadable text as a struct of nulls."""
    return F.from_json(_c(text), f"struct<{fields}>")


def decided_rows(rows: Column, value: str = FRAUD) -> Column:
    """How many entries of a result array carry the decision ``value``."""
    return F.size(F.filter(rows, lambda r: r["decision"] == value))
