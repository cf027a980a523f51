"""Exact rank statistics and score curves without a global sort in one task.

Everything starts from a table of distinct values with class counts, which
removes ties, and from its cumulative counts (``running_totals``, which cuts
long groups into segments).  Quantiles, Mann-Whitney U, AUC, precision-recall
and ROC points, best-F1 and least-cost thresholds are then plain aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.scalars import safe_div
from ledgerlight.operators.ordered import MAX_ROWS, lagged, match_small, running_totals, spread_join
from ledgerlight.session import materialise


def long_form(df: DataFrame, features: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """(keep..., variable, value) with one row per non-null feature value."""
    pairs = [F.struct(F.lit(f).alias("variable"), F.col(f).cast("double").alias("value")) for f in features]
    return (
        df.select(*keep, F.explode(F.array(*pairs)).alias("_p"))
        .select("*", "_p.*")
        .drop("_p")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def distinct_values(df: DataFrame, features: Sequence[str], by: Sequence[str], aggs: Sequence[Column], keep: Sequence[Column] = ()) -> DataFrame:
    """(by..., variable, value, aggs...): one row per distinct value of each feature, written once.

    Features are aggregated one by one from a written narrow table, so a task holds the values of one feature in
    one piece of a file, and not those of all features in all its rows.
    """
    names = [f"_f{k}" for k in range(len(features))]
    rows = df.select(*by, *keep, *[F.col(f).cast("double").alias(n) for f, n in zip(features, names, strict=True)])
    if len(features) > 1:
        rows = materialise(rows)

    def one(feature: str, name: str) -> DataFrame:
        known = rows.filter(F.col(name).isNotNull() & ~F.isnan(name)).withColumn("value", F.col(name))
        return known.groupBy(*by, F.lit(feature).alias("variable"), "value").agg(*aggs)

    return materialise(reduce(DataFrame.unionAll, [one(f, n) for f, n in zip(features, names, strict=True)]))


def with_totals(df: DataFrame, totals: DataFrame, group: Sequence[str], one_row: bool, max_rows: int) -> DataFrame:
    """Add the totals of each group, null-safe.

    Without grouping columns the totals have one row per feature and are
    broadcast; with them their number grows with the data.
    """
    if one_row:
        return match_small(df, totals, group, "left")
    return spread_join(df, totals, group, null_safe=True, max_rows=max_rows)


# --- quantiles -------------------------------------------------------------

def value_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, value, n): the distinct values of each feature, written once."""
    return distinct_values(df, features, by, [F.count(F.lit(1)).alias("n")])


def quantiles_of(
    counts: DataFrame, probs: dict[str, float], by: Sequence[str] = (), max_rows: int = MAX_ROWS
) -> DataFrame:
    """Linear-interpolated quantiles of a ``value_counts`` table."""
    group = [*by, "variable"]
    upto = running_totals(counts, group, ["value"], {"upto": F.col("n")}, max_rows)
    total = counts.groupBy(*group).agg(F.sum("n").alias("total"))
    ranked = with_totals(upto, total, group, one_row=not by, max_rows=max_rows)

    aggs = []
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("total") - 1)
        for side, index in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.min(F.when(F.col("upto") > index, F.col("value"))).alias(f"_{name}_{side}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_{name}_part"))
    out = ranked.groupBy(*group).agg(*aggs)
    return out.select(
        *group,
        *[
            (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")).alias(n)
            for n in probs
        ],
    )


def moments_of(counts: DataFrame, by: Sequence[str] = (), max_rows: int = MAX_ROWS) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of a ``value_counts`` table."""
    group = [*by, "variable"]
    value, n = F.col("value"), F.col("n")
    first = counts.groupBy(*group).agg(
        F.sum("n").alias("nombre"), (F.sum(value * n) / F.sum(n)).alias("moyenne"),
        F.min("value").alias("minimum"), F.max("value").alias("maximum"),
    )
    gap = value - F.col("moyenne")
    rows = with_totals(counts, first, group, one_row=not by, max_rows=max_rows)
    spread = F.when(F.col("nombre") > 1, F.sqrt(F.sum(gap * gap * n) / (F.col("nombre") - 1)))
    return rows.groupBy(*group, "nombre", "moyenne", "minimum", "maximum").agg(spread.alias("ecart_type"))


def exact_quantiles(
    df: DataFrame, features: Sequence[str], probs: dict[str, float], by: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Quantiles per feature (and group): (by..., variable, names of ``probs``).

    Same values as ``percentile``, whose buffer would hold every distinct
    value of a group in one task.
    """
    return quantiles_of(value_counts(df, features, by), probs, by, max_rows)


def exact_medians(df: DataFrame, features: Sequence[str], by: Sequence[str] = (), max_rows: int = MAX_ROWS):
    return exact_quantiles(df, features, {"mediane": 0.5}, by, max_rows)


# --- two-class ranks -------------------------------------------------------

def class_counts(label: Column) -> list[Column]:
    return [
        F.sum(F.when(label != 0, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(label == 0, 1).otherwise(0)).alias("neg"),
    ]


def rank_sums(df: DataFrame, features: Sequence[str], label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per feature: class sizes, U of the positive class and the tie term."""
    known = df.filter(F.col(label).isNotNull())
    counts = distinct_values(known, features, [], class_counts(F.col("_y")), [F.col(label).alias("_y")])
    cum = running_totals(counts, ["variable"], ["value"], {"cum_neg": F.col("neg")}, max_rows)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tied = pos + neg
    return cum.groupBy("variable").agg(
        F.sum("pos").alias("n1"),
        F.sum("neg").alias("n0"),
        F.sum(pos * (F.col("cum_neg") - neg / 2)).alias("u"),
        F.sum(tied * tied * tied - tied).alias("ties"),
    )


def univariate_auc(df: DataFrame, features: Sequence[str], label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """AUC of each raw feature against the label; null when a class is missing."""
    pairs = F.col("n1").cast("double") * F.col("n0")
    return rank_sums(df, features, label, max_rows).select(
        "variable", F.when(pairs > 0, F.col("u") / pairs).alias("auc")
    )


# --- score curves ----------------------------------------------------------

def score_curve(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), max_rows: int = MAX_ROWS
) -> DataFrame:
    """One row per distinct score used as threshold (decision: score >= threshold).

    Columns: by..., threshold, pos, neg (at that score), tp, fp, fn, tn,
    precision, recall, fpr.  Rows with a null label or score are left out.
    """
    by = list(by)
    group = [*by, "_all"]
    counts = materialise(
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
        .groupBy(*by, F.lit(0).alias("_all"), F.col(score).cast("double").alias("threshold"))
        .agg(*class_counts(F.col(label)))
    )
    cum = running_totals(
        counts, group, ["threshold"], {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")}, max_rows
    )
    totals = counts.groupBy(*group).agg(F.sum("pos").alias("p_all"), F.sum("neg").alias("n_all"))
    fn, tn = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    tp, fp = F.col("p_all") - fn, F.col("n_all") - tn
    return with_totals(cum, totals, group, one_row=not by, max_rows=max_rows).select(
        *by, "threshold", "pos", "neg",
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        (tp / (tp + fp)).alias("precision"),
        safe_div(tp, F.col("p_all"), 1.0).alias("recall"),
        safe_div(fp, F.col("n_all"), 0.0).alias("fpr"),
    )


def _highest() -> Column:
    """Marks the highest threshold of a curve: no row lies above it."""
    return F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")


def _with_end(point: Column, end: Column, last: Column) -> Column:
    """The points of a row: its own and, beside the last one, the end of the curve."""
    return F.inline(F.when(last, F.array(point, end)).otherwise(F.array(point)))


def precision_recall_points(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """PR curve by rising threshold, closed by the point (precision 1, recall 0)."""
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.select(*by, _with_end(F.struct("threshold", "precision", "recall"), end, _highest()))


def roc_points(curve: DataFrame, drop_intermediate: bool = True, max_rows: int = MAX_ROWS) -> DataFrame:
    """ROC curve from (0, 0) on; points on a straight line are dropped on request."""
    points = curve.select(
        "threshold", "pos", "neg", "fpr", F.col("recall").alias("tpr"), _highest().alias("_last"), F.lit(0).alias("_all")
    )
    if drop_intermediate:
        points = lagged(points, ["_all"], ["threshold"], {"_pos": "pos", "_neg": "neg"}, max_rows)
        straight = (F.col("pos") == F.col("_pos")) & (F.col("neg") == F.col("_neg")) & ~F.col("_last")
        points = points.filter(~F.coalesce(straight, F.lit(False)))
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.select(_with_end(F.struct("threshold", "fpr", "tpr"), start, F.col("_last")))


def curve_summary(
    curve: DataFrame, by: Sequence[str] = (), min_precision: float = 0.80, cost_fp: float = 10, cost_fn: float = 1000
) -> DataFrame:
    """All figures of a model in one aggregate over the curve.

    Ties between thresholds go to the lowest one, as a first-maximum search
    over rising thresholds would find it.
    """
    pos, neg, tn = (F.col(c).cast("double") for c in ("pos", "neg", "tn"))
    p_all, n_all = F.max(F.col("tp") + F.col("fn")), F.max(F.col("fp") + F.col("tn"))
    precision, recall, at = F.col("precision"), F.col("recall"), F.col("threshold")
    f1 = 2 * (precision * recall) / (precision + recall + 1e-9)
    cost = F.col("fp") * cost_fp + F.col("fn") * cost_fn
    best_f1 = F.max(F.struct(f1.alias("v"), (-at).alias("at")))
    best_cost = F.min(F.struct(cost.cast("double").alias("v"), at.alias("at")))
    out = curve.groupBy(*by).agg(
        p_all.alias("n_pos"), n_all.alias("n_neg"),
        F.sum(pos * precision).alias("_ap"),
        F.sum(pos * (tn + neg / 2)).alias("_u"),
        F.coalesce(F.max(F.when(precision >= min_precision, recall)), F.lit(0.0)).alias("recall_at_precision"),
        best_f1.alias("_f1"), best_cost.alias("_cost"),
    )
    n_pos, n_neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    pr_auc = safe_div(F.col("_ap"), n_pos, 0.0)
    base = n_pos / (n_pos + n_neg)
    return out.select(
        *by, "n_pos", "n_neg",
        pr_auc.alias("pr_auc"),
        F.when(n_pos * n_neg > 0, F.col("_u") / (n_pos * n_neg)).alias("roc_auc"),
        base.alias("baseline_pr_auc"),
        safe_div(pr_auc, base, 0.0).alias("lift"),
        "recall_at_precision",
        (-F.col("_f1.at")).alias("best_threshold_f1"), F.col("_f1.v").alias("best_f1"),
        F.col("_cost.at").alias("best_threshold_cost"), F.col("_cost.v").alias("min_cost"),
    )
