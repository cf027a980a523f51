"""Decisions at a threshold: confusion cells, class reports, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.scalars import safe_div

# Class names, the threshold shown by the monitoring page and its bins.
CLASS_NAMES = ("Normal", "Fraude")
UNKNOWN_CLASS = "Inconnue"
MONITORING_THRESHOLD = 0.8394
HISTOGRAM_BINS = 60


def _known(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def confusion(df: DataFrame, label: str, score: str, threshold: float = MONITORING_THRESHOLD) -> DataFrame:
    """All four cells (reel, predit, nombre); empty cells count 0."""
    real, hit = F.col(label) != 0, F.col(score) >= threshold
    cells = {(0, 0): ~real & ~hit, (0, 1): ~real & hit, (1, 0): real & ~hit, (1, 1): real & hit}
    one = _known(df, label, score).agg(*[_count(c).alias(f"c{y}{p}") for (y, p), c in cells.items()])
    rows = [
        F.struct(F.lit(y).alias("reel"), F.lit(p).alias("predit"), F.col(f"c{y}{p}").alias("nombre"))
        for y, p in cells
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_report(df: DataFrame, label: str, score: str, thresholds: dict[str, float]) -> DataFrame:
    """Precision, recall, F1 and support per class and threshold, from one pass.

    Rows per threshold: both classes, ``accuracy`` (in the f1 column), ``macro
    avg`` and ``weighted avg``.
    """
    real = F.col(label) != 0
    one = _known(df, label, score).agg(
        _count(real).alias("pos"), _count(~real).alias("neg"),
        *[_count(real & (F.col(score) >= t)).alias(f"tp_{i}") for i, t in enumerate(thresholds.values())],
        *[_count(~real & (F.col(score) >= t)).alias(f"fp_{i}") for i, t in enumerate(thresholds.values())],
    )
    pos, neg = F.col("pos"), F.col("neg")
    total = pos + neg
    rows = []
    for i, (name, _) in enumerate(thresholds.items()):
        tp, fp = F.col(f"tp_{i}"), F.col(f"fp_{i}")
        fn, tn = pos - tp, neg - fp
        measures = {
            CLASS_NAMES[0]: (safe_div(tn, tn + fn), safe_div(tn, neg), safe_div(2 * tn, 2 * tn + fn + fp), neg),
            CLASS_NAMES[1]: (safe_div(tp, tp + fp), safe_div(tp, pos), safe_div(2 * tp, 2 * tp + fn + fp), pos),
        }
        normal, fraud = measures.values()
        null = F.lit(None).cast("double")
        measures["accuracy"] = (null, null, safe_div(tp + tn, total), total)
        measures["macro avg"] = (*[(a + b) / 2 for a, b in zip(normal[:3], fraud[:3])], total)
        measures["weighted avg"] = (
            *[safe_div(a * neg + b * pos, total) for a, b in zip(normal[:3], fraud[:3])], total
        )
        rows += [
            F.struct(
                F.lit(name).alias("seuil"), F.lit(cls).alias("classe"), p.alias("precision"),
                r.alias("recall"), f.alias("f1"), n.alias("support"),
            )
            for cls, (p, r, f, n) in measures.items()
        ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def score_histogram(df: DataFrame, score: str, label: str | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts per equal-width bin of [0, 1] and true class."""
    cls = F.lit(UNKNOWN_CLASS)
    if label:
        cls = F.when(F.col(label) == 0, CLASS_NAMES[0]).when(F.col(label) == 1, CLASS_NAMES[1]).otherwise(UNKNOWN_CLASS)
    slot = F.least(F.width_bucket(F.col(score), F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return df.filter(F.col(score).isNotNull()).groupBy(slot.cast("int").alias("tranche"), cls.alias("classe")).agg(
        F.count(F.lit(1)).alias("nombre")
    )


def prediction_table(
    df: DataFrame, features: list[str], label: str, score: str, best_threshold: float, default: float = 0.5
) -> DataFrame:
    """Features, truth, score and the two decisions, under one fixed schema."""
    return df.select(
        *features,
        F.col(label).alias("y_true"),
        F.col(score).alias("y_proba"),
        F.when(F.col(score) >= default, 1).otherwise(0).alias("y_pred_default"),
        F.when(F.col(score) >= best_threshold, 1).otherwise(0).alias("y_pred_optimal"),
    )
