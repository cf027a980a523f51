"""Loan risk, liquidity and rule-based fraud measures as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.dates import _c
from ledgerlight.functions.scalars import matched_names, safe_div
from ledgerlight.operators.joins import range_lookup
from ledgerlight.operators.ordered import MAX_ROWS, ordered_features, spread_join
from ledgerlight.operators.profile import weighted_average
from ledgerlight.operators.ranks import exact_quantiles

# Regulatory categories as (days from, days to, category, minimum provision rate).
LOAN_CATEGORIES = (
    (0, 89, "Saine", 0.0),
    (90, 180, "Pré-douteuse", 0.20),
    (181, 360, "Douteuse", 0.50),
    (361, 3650, "Compromise", 1.00),
)
# Default-probability bounds up to a number of days late.
PD_BOUNDS = ((0, 0.005, 0.02), (30, 0.02, 0.05), (90, 0.05, 0.15), (180, 0.15, 0.35), (360, 0.35, 0.65))
PD_WORST = (0.65, 0.95)
# Loss bounds per collateral.
LGD_MORTGAGE = (0.20, 0.35)
LGD_SECURED = (0.35, 0.55)
LGD_OTHER = (0.55, 0.75)
SECURED = ("Nantissement", "Caution personnelle", "Garantie autonome")
# Weights of the fraud rules and of the probability.
RULE_WEIGHTS = {
    "ecart_z": 0.30, "nuit": 0.20, "intl": 0.15, "device": 0.10,
    "montant_eleve": 0.15, "weekend_nuit": 0.10, "solde_neg": 0.15,
}
TRACED_RULES = ("ecart_z", "nuit", "intl", "device", "montant_eleve", "solde_neg")
HIGH_AMOUNT = 30000
TARGET_RATE = 0.012
FRAUD_TYPE = "Score de risque élevé"


# --- loans -------------------------------------------------------------------

def expected_loss(pd_: Column | str, lgd: Column | str, ead: Column | str) -> Column:
    return F.round(_c(pd_) * _c(lgd) * _c(ead), 2)


def ifrs9_stage(days: Column | str) -> Column:
    days = _c(days)
    return F.when(days == 0, "Stage 1").when(days <= 90, "Stage 2").otherwise("Stage 3")


def regulatory_category(days: Column | str) -> Column:
    return range_lookup(days, LOAN_CATEGORIES, 2)


def minimum_provision_rate(days: Column | str) -> Column:
    return range_lookup(days, LOAN_CATEGORIES, 3)


def internal_grade(score: Column | str, days: Column | str) -> Column:
    score, days = _c(score), _c(days)
    return (
        F.when((score >= 700) & (days == 0), "A")
        .when((score >= 600) & (days <= 30), "B")
        .when(days <= 90, "C")
        .otherwise("D")
    )


def loan_status(days: Column | str) -> Column:
    days = _c(days)
    return (
        F.when(days == 0, "En cours")
        .when(days <= 90, "En cours (retard)")
        .when(days <= 180, "Incident de paiement")
        .otherwise("Contentieux")
    )


def litigation_flag(days: Column | str) -> Column:
    return F.when(loan_status(days) == "Contentieux", 1).otherwise(0)


def late_reason(days: Column | str) -> Column:
    return F.when(_c(days) > 30, "Retard de paiement").otherwise("Normal")


def remaining_principal(principal: Column | str, paid: Column | str, months: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.round(_c(principal) * (1 - F.try_divide(_c(paid), _c(months))), 2))


def remaining_months(months: Column | str, paid: Column | str) -> Column:
    return F.greatest(F.lit(0), _c(months) - _c(paid))


def pd_bounds(days: Column | str) -> tuple[Column, Column]:
    days, low, high = _c(days), F, F
    for limit, lo, hi in PD_BOUNDS:
        low, high = low.when(days <= limit, lo), high.when(days <= limit, hi)
    return low.otherwise(PD_WORST[0]), high.otherwise(PD_WORST[1])


def lgd_bounds(collateral: Column | str) -> tuple[Column, Column]:
    kind = _c(collateral)
    sides = [
        F.when(kind == "Hypothèque", LGD_MORTGAGE[i]).when(kind.isin(*SECURED), LGD_SECURED[i]).otherwise(LGD_OTHER[i])
        for i in (0, 1)
    ]
    return sides[0], sides[1]


def loan_ratios(credits: DataFrame) -> DataFrame:
    return credits.withColumns(
        {
            "ratio_restant_initial": safe_div("montant_restant_du", "montant_initial"),
            "provision_ratio": safe_div("provision_constituee", "montant_restant_du"),
        }
    )


def classification_ratios(classification: DataFrame) -> DataFrame:
    return classification.withColumns(
        {
            "taux_perte_attendue": safe_div("perte_attendue_el", "exposition_en_cas_defaut_ead"),
            "ratio_provision_exposition": safe_div("provision_constituee", "exposition_en_cas_defaut_ead"),
        }
    )


def portfolio_summary(classification: DataFrame) -> DataFrame:
    """Exposure-weighted PD and LGD, total loss and provisions, gap between them."""
    ead = "exposition_en_cas_defaut_ead"
    gap = F.col("provision_totale") - F.col("el_total")
    return classification.agg(
        weighted_average("probabilite_defaut_pd", ead).alias("pd_pondere"),
        weighted_average("perte_en_cas_defaut_lgd", ead).alias("lgd_pondere"),
        F.sum("perte_attendue_el").alias("el_total"),
        F.sum("provision_constituee").alias("provision_totale"),
    ).withColumns({"ecart": gap, "ecart_pct": safe_div(gap * 100, F.col("el_total"))})


# --- liquidity ---------------------------------------------------------------

def percent_ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return F.round(safe_div(_c(num) * 100, den, None), digits)


def conforms(ratio: Column | str) -> Column:
    return _c(ratio) >= 100


def global_status(lcr_ok: Column | str, nsfr_ok: Column | str) -> Column:
    a, b = _c(lcr_ok), _c(nsfr_ok)
    return F.when(a & b, "Conforme").when(a | b, "Surveillance").otherwise("Non conforme")


def alert_colour(lcr_ok: Column | str, nsfr_ok: Column | str) -> Column:
    a, b = _c(lcr_ok), _c(nsfr_ok)
    return F.when(a & b, "Vert").when(a | b, "Orange").otherwise("Rouge")


def reserve_measures(treasury: Column | str, deposits: Column | str, sight: Column | str) -> dict[str, Column]:
    """Mandatory reserve of 4 %, its share of deposits, sight and term deposits."""
    reserve = F.round(_c(treasury) * 0.04, 2)
    return {
        "reserve_obligatoire": reserve,
        "ratio_reserve": percent_ratio(reserve, deposits, 4),
        "depot_terme": _c(deposits) - _c(sight),
        "ratio_depot_vue": F.round(safe_div(sight, deposits, None), 4),
    }


def monthly_changes(
    ratios: DataFrame,
    series: Sequence[str] = ("niveau_consolidation", "agence_id", "type_ratio"),
    order: Sequence[str] = ("date_calcul", "ratio_id"),
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Change of LCR and NSFR against the row before of the same series, and the LCR trend."""
    before = {f"_{c}": F.max(c) for c in ("lcr_ratio", "nsfr_ratio")}
    change = F.col("lcr_variation_mensuelle")
    return (
        ordered_features(ratios, series, order, previous=1, frame=before, max_rows=max_rows)
        .withColumns(
            {
                "lcr_variation_mensuelle": F.col("lcr_ratio") - F.col("_lcr_ratio"),
                "nsfr_variation_mensuelle": F.col("nsfr_ratio") - F.col("_nsfr_ratio"),
            }
        )
        .withColumn(
            "tendance_lcr",
            F.when(change > 0, "Amélioration").when(change < 0, "Détérioration").otherwise("Stable"),
        )
        .drop(*before)
    )


# --- ledger and fraud rules --------------------------------------------------

def running_balance(
    moves: DataFrame, accounts: DataFrame, account: str = "compte_id", amount: str = "mouvement",
    order: Sequence[str] = ("date_transaction", "transaction_id"), opening: str = "solde",
    max_rows: int = MAX_ROWS, beside: Sequence[str] = (),
) -> DataFrame:
    """Balance before and after every signed move, one time-ordered ledger per account.

    ``beside``: other columns of the account to add in the same join.
    """
    after = ordered_features(moves, [account], order, running={"_cumul": F.col(amount)}, max_rows=max_rows)
    start = F.coalesce(F.col(opening), F.lit(0.0))
    return (
        after.join(accounts.select(account, opening, *beside), account, "left")
        .withColumns(
            {
                "solde_avant": start + F.col("_cumul") - F.col(amount),
                "solde_apres": start + F.col("_cumul"),
            }
        )
        .drop("_cumul", opening)
    )


def account_moves(transactions: DataFrame) -> DataFrame:
    """Signed moves: minus on the source account, plus on another target account.

    One pass: every transaction becomes an array of one or two moves.
    """
    source, target = F.col("compte_source_id"), F.col("compte_destination_id")
    debit = F.when(
        source.isNotNull(), F.struct(source.alias("compte_id"), (-F.col("montant")).alias("mouvement"))
    )
    credit = F.when(
        target.isNotNull() & ~target.eqNullSafe(source),
        F.struct(target.alias("compte_id"), F.col("montant").alias("mouvement")),
    )
    return transactions.select(
        "transaction_id", "date_transaction", F.explode(F.array_compact(F.array(debit, credit))).alias("_m")
    ).select("transaction_id", "date_transaction", "_m.*")


def overdrawn_flag(after: Column | str, overdraft: Column | str) -> Column:
    """1 when the balance is below zero by more than the allowed overdraft."""
    after = _c(after)
    return F.when((after < 0) & (F.abs(after) > _c(overdraft)), 1).otherwise(0)


def occurrence_numbers(
    df: DataFrame, key: str, what: str, order: Sequence[str], max_rows: int = MAX_ROWS
) -> DataFrame:
    """Number of the row per key, and whether ``what`` shows up for the first time.

    First sight is found by an aggregate per (key, what), not by a window.
    """
    numbered = ordered_features(df, [key], order, running={"rang": F.lit(1)}, max_rows=max_rows)
    first = df.groupBy(key, what).agg(F.min(F.struct(*order)).alias("_first"))
    joined = spread_join(numbered, first, [key, what], null_safe=True, max_rows=max_rows)
    return joined.withColumn("premiere_vue", (F.struct(*order) == F.col("_first")).cast("int")).drop("_first")


def fraud_rules(z: Column, rank: Column) -> dict[str, Column]:
    """The seven boolean terms of the rule score."""
    night, weekend = F.col("is_night") == 1, F.col("is_weekend") == 1
    return {
        "ecart_z": z > 3,
        "nuit": night,
        "intl": F.col("is_international") == 1,
        "device": rank == 1,
        "montant_eleve": F.col("montant") > HIGH_AMOUNT,
        "weekend_nuit": weekend & night,
        "solde_neg": F.col("solde_negatif_anormal") == 1,
    }


def rule_score(rules: dict[str, Column], weights: dict[str, float] = RULE_WEIGHTS) -> Column:
    terms = [F.when(cond, weights[name]).otherwise(0.0) for name, cond in rules.items()]
    return sum(terms[1:], terms[0])


def rule_probability(score: Column) -> Column:
    return 0.001 + 0.45 * score


def label_by_quantile(
    df: DataFrame, probability: str, rate: float = TARGET_RATE, label: str = "fraud_flag", max_rows: int = MAX_ROWS
) -> DataFrame:
    """1 for rows at or above the ``1 - rate`` quantile; ties may exceed the rate."""
    cut = exact_quantiles(df, [probability], {"cut": 1 - rate}, max_rows=max_rows).select("cut").scalar()
    return df.withColumn(label, F.when(F.col(probability) >= cut, 1).otherwise(0))


def rule_trail(rules: dict[str, Column], label: str = "fraud_flag") -> dict[str, Column]:
    """Audit text of the rules that held, and the type text, on labelled rows only."""
    traced = {n: rules[n] for n in TRACED_RULES}
    hit = F.col(label) == 1
    return {
        "fraud_rule_triggered": F.when(hit, matched_names(traced)).otherwise(""),
        "fraud_type": F.when(hit, FRAUD_TYPE),
    }
