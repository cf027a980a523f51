"""Cleaning: keys, fills, imputation, duplicate removal, row validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.dates import DEFAULT_HOUR, lenient_hour
from ledgerlight.operators.ordered import MAX_ROWS, first_per_key
from ledgerlight.operators.ranks import exact_medians
from ledgerlight.operators.sketches import approximate_quantiles

# Category texts for missing values.
NOT_APPLICABLE = "Non_applicable"
UNKNOWN = "Inconnu"
REQUIRED_UPLOAD = ("montant", "type_transaction", "mode_paiement", "heure")
DEFAULT_MODE = "Carte"


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Colonnes manquantes : {', '.join(missing)}")
    return df


def keep_columns(df: DataFrame, columns: Sequence[str], banned: Sequence[str] = ()) -> DataFrame:
    """Projection on an allow-list that must not contain a banned column."""
    leaked = sorted(set(columns) & set(banned))
    if leaked:
        raise ValueError(f"banned columns in the projection: {leaked}")
    return require_columns(df, columns).select(*columns)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; with ``order`` always the same one."""
    if order is None:
        return df.dropDuplicates(list(keys))
    return first_per_key(df, keys, order)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def fill_defaults(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def median_values(
    df: DataFrame, columns: Sequence[str], max_rows: int = MAX_ROWS, approximate: bool = False
) -> dict[str, float]:
    """Medians of several columns from one pass; a column of nulls is missing.

    ``approximate`` takes them from sketches: no shuffle by value, a rank error of ``sketches.RANK_ERROR``.
    """
    found = approximate_quantiles(df, columns, {"mediane": 0.5}) if approximate else exact_medians(df, columns, max_rows=max_rows)
    rows = found.collect()   # one row per column
    return {row["variable"]: row["mediane"] for row in rows}


def impute_medians(
    df: DataFrame, columns: Sequence[str], indicators: dict[str, str] | None = None, fit_on: DataFrame | None = None,
    max_rows: int = MAX_ROWS, approximate: bool = False,
) -> DataFrame:
    """Fill nulls with exact (or ``approximate``) medians; ``indicators`` names a 0/1 column per column that gets one.

    ``fit_on`` takes the medians from other rows (the training part) so that
    the test part does not leak into them.  The columns become doubles whether
    or not they hold nulls, so the schema does not depend on the data.
    """
    middle = median_values(df if fit_on is None else fit_on, columns, max_rows, approximate)
    flags = {flag: F.col(c).isNull().cast("int") for c, flag in (indicators or {}).items()}
    fills = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c)).cast("double")) for c in columns
    }
    return df.withColumns(flags).withColumns(fills)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    columns = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()


def assert_no_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    left = {c: n for c, n in null_counts(df, columns).items() if n}
    if left:
        raise ValueError(f"null values left: {left}")
    return df


# --- hand-made input rows ---------------------------------------------------

def _binary(df: DataFrame, name: str) -> tuple[Column, Column]:
    if name not in df.columns:
        return F.lit(0), F.lit(None).cast("string")
    raw = F.trim(F.col(name).cast("string"))
    value = F.when(raw.isNull() | (raw == ""), 0).otherwise(raw.try_cast("int"))
    error = F.when(value.isNull() | ~value.between(0, 1), F.concat(F.lit(f"{name} hors limites (0-1) : "), raw))
    return value, error


def validate_rows(df: DataFrame) -> DataFrame:
    """Typed transaction fields plus ``errors``, the list of broken rules (empty: good row)."""
    amount = F.col("montant").try_cast("double")
    amount_text = F.coalesce(F.col("montant").cast("string"), F.lit(""))
    clock = lenient_hour("heure") if "heure" in df.columns else F.struct(
        F.lit(DEFAULT_HOUR).alias("hour"), F.lit(None).cast("string").alias("error")
    )
    weekend, weekend_error = _binary(df, "is_weekend")
    abroad, abroad_error = _binary(df, "est_international")
    mode = F.col("mode_paiement") if "mode_paiement" in df.columns else F.lit(None).cast("string")
    checks = [
        F.when(amount.isNull() | F.isnan(amount), F.concat(F.lit("Montant invalide : "), amount_text)).when(
            amount < 0, F.concat(F.lit("Montant négatif : "), amount_text)
        ),
        F.when(F.col("type_transaction").isNull(), F.lit("Type de transaction manquant")),
        clock["error"],
        weekend_error,
        abroad_error,
    ]
    return df.withColumn("errors", F.array_compact(F.array(*checks))).withColumns(
        {
            "montant_texte": amount_text,
            "montant": amount,
            "mode_paiement": F.coalesce(mode, F.lit(DEFAULT_MODE)),
            "heure": clock["hour"],
            "is_weekend": weekend,
            "est_international": abroad,
        }
    )


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows with errors) of a validated frame."""
    return df.filter(F.size("errors") == 0).drop("errors"), df.filter(F.size("errors") > 0)
