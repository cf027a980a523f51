"""Feature tests: correlation, collinearity, rank tests, contingency tests."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerlight.functions.scalars import KEEP, effect_decision, effect_label
from ledgerlight.operators.ordered import MAX_ROWS
from ledgerlight.operators.ranks import class_counts, long_form, rank_sums
from ledgerlight.session import materialise


# --- tail probabilities, for result tables of one row per feature -----------
# The helpers are nested so that they travel to the executors by value, where
# this package need not be installed.

def two_sided_normal(z: Column | str) -> Column:
    """Two-sided tail of the standard normal distribution."""

    def tail(values: pd.Series) -> pd.Series:
        return values.map(lambda v: min(1.0, math.erfc(v / math.sqrt(2.0))), na_action="ignore")

    return F.pandas_udf(tail, DoubleType())(z)


def chi2_tail(x: Column | str, dof: Column | str) -> Column:
    """Upper tail of the chi-squared distribution; 1 for 0 degrees of freedom."""

    def upper_gamma(a: float, x: float) -> float:
        # Regularised Q(a, x): power series below the mode, continued fraction above.
        if x <= 0:
            return 1.0
        scale = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1:
            k, term = a, 1.0 / a
            total = term
            while abs(term) > abs(total) * 1e-16:
                k += 1
                term *= x / k
                total += term
            return 1.0 - total * scale
        fraction = 0.0
        for i in range(400 + int(4 * math.sqrt(a)), 0, -1):
            fraction = i * (a - i) / (x - a + 2 * i + 1 + fraction)
        return scale / (x - a + 1 + fraction)

    def tail(values: pd.Series, dofs: pd.Series) -> pd.Series:
        return pd.Series(
            [upper_gamma(k / 2, v / 2) if k > 0 else 1.0 for v, k in zip(values, dofs)], dtype="float64"
        )

    return F.pandas_udf(tail, DoubleType())(x, dof)


# --- correlation and collinearity -------------------------------------------

def _rows(one: DataFrame, structs: list) -> DataFrame:
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def label_correlations(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Pearson correlation of every feature with the label, one pass."""
    one = df.agg(*[F.corr(F.col(f).cast("double"), F.col(label).cast("double")).alias(f) for f in features])
    return _rows(
        one, [F.struct(F.lit(f).alias("variable"), F.col(f).alias("correlation")) for f in features]
    ).orderBy(F.desc_nulls_last("correlation"), "variable")


def correlation_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Upper triangle of the Pearson matrix, strongest pair first, one pass."""
    pairs = list(combinations(features, 2))
    one = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    )
    return _rows(
        one,
        [
            F.struct(F.lit(a).alias("variable_1"), F.lit(b).alias("variable_2"), F.col(f"c{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ],
    ).orderBy(F.abs("correlation").desc_nulls_last(), "variable_1", "variable_2")


RANK_TOLERANCE = 1e-12


def pivoted_cholesky(unit: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, list[int]]:
    """(lower factor in pivot order, pivots) of a positive semi-definite matrix with ones on its diagonal.

    The largest remaining diagonal entry leads; the factor ends where that is below the tolerance, so the
    number of pivots is the numerical rank.
    """
    k = len(unit)
    rest, order, rows = np.diag(unit).copy(), list(range(k)), np.zeros((k, k))
    for step in range(k):
        lead = max(range(step, k), key=lambda i: rest[order[i]])
        if rest[order[lead]] <= tolerance:
            return rows[order][:step, :step], order[:step]
        order[step], order[lead] = order[lead], order[step]
        p = order[step]
        rows[p, step] = math.sqrt(rest[p])
        for q in order[step + 1 :]:
            rows[q, step] = (unit[q, p] - rows[q, :step] @ rows[p, :step]) / rows[p, step]
            rest[q] -= rows[q, step] ** 2
    return rows[order], order


def _spanned(unit: np.ndarray, pivots: list[int], i: int) -> bool:
    """Whether column i is a combination of the other columns that all pivots but it span."""
    others = [p for p in range(len(unit)) if p != i]
    return len(pivoted_cholesky(unit[np.ix_(others, others)])[1]) == len(pivots)


def variance_inflation(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """VIF without intercept: ``G[i,i] * inv(G)[i,i]`` of the Gram matrix G.

    The sums run on Spark in one pass; only the small matrix is factored on the driver.  Nulls count as 0.
    The rank is decided by a pivoted Cholesky factor of the matrix scaled to ones on its diagonal: a feature that is a combination
    of others has an infinite VIF, the rest theirs among a set of independent features; a feature of zeros has 1.
    """
    k = len(features)
    x = {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    sums = df.agg(*[F.sum(x[features[i]] * x[features[j]]).alias(f"g_{i}_{j}") for i, j in cells]).first()
    gram = np.zeros((k, k))
    for i, j in cells:
        gram[i, j] = gram[j, i] = sums[f"g_{i}_{j}"] or 0.0
    some = [i for i in range(k) if gram[i, i] > 0]
    vif = np.ones(k)
    if some:
        scale = np.sqrt(np.diag(gram)[some])
        unit = gram[np.ix_(some, some)] / np.outer(scale, scale)
        factor, pivots = pivoted_cholesky(unit)
        inverse = np.linalg.inv(factor)
        for at, p in enumerate(pivots):
            vif[some[p]] = float(np.square(inverse[:, at]).sum())
        if len(pivots) < len(some):
            for i in range(len(some)):
                if i not in pivots or _spanned(unit, pivots, i):
                    vif[some[i]] = math.inf
    return df.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(features, vif)], "variable string, vif double"
    ).orderBy(F.desc("vif"), "variable")


# --- tests ------------------------------------------------------------------

def mann_whitney(df: DataFrame, features: Sequence[str], label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """Two-sided rank test, positive against negative class, per feature.

    Normal approximation with tie and continuity correction; the effect is the
    absolute rank-biserial correlation.
    """
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    n, pairs = n1 + n0, n1 * n0
    mean = pairs / 2
    variance = pairs / 12 * ((n + 1) - F.col("ties") / (n * (n - 1)))
    z = (F.greatest(F.col("u"), pairs - F.col("u")) - mean - 0.5) / F.sqrt(variance)
    return (
        rank_sums(df, features, label, max_rows)
        .filter(pairs > 0)
        .select(
            "variable", F.lit("numérique").alias("type"), "n1", "n0", "u",
            F.when(variance > 0, z).otherwise(0.0).alias("z"),
            F.abs(1 - 2 * F.col("u") / pairs).alias("taille_effet"),
        )
    )


#: Classes up to this size are tested exactly.
SMALL_CLASS = 20


def exact_rank_tests(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = (), most: int = SMALL_CLASS) -> DataFrame:
    """(by..., variable, n1, n0, u, p_value) of features and groups whose classes both have 1 to ``most`` rows.

    The two-sided p-value is the share of all ways to choose the positive rows whose rank sum is at least as far from its
    mean; ties share their middle rank.  The ways are counted value by value: a table by rows chosen and rank sum (in
    halves), which takes at most ``most`` times 2 * most * (2 * most + 1) numbers, whatever the number of ways.
    """
    by = list(by)
    counts = (
        long_form(df.filter(F.col(label).isNotNull()), features, [*by, F.col(label).alias("_y")])
        .groupBy(*by, "variable", "value").agg(*class_counts(F.col("_y")))
    )
    # Groups beyond the size leave before their rows are gathered; the rest have 2 * most rows at most.
    sizes = counts.groupBy(*by, "variable").agg(F.sum("pos").alias("n1"), F.sum("neg").alias("n0"))
    small = sizes.filter(F.col("n1").between(1, most) & F.col("n0").between(1, most))
    small = small.withColumnsRenamed({c: f"_k_{c}" for c in [*by, "variable"]})
    same = reduce(lambda a, b: a & b, [counts[c].eqNullSafe(small[f"_k_{c}"]) for c in [*by, "variable"]])
    rows = counts.join(small, same).select(*by, "variable", "n1", "n0", F.struct("value", "pos", "neg").alias("cell"))
    cells = rows.groupBy(*by, "variable", "n1", "n0").agg(F.sort_array(F.collect_list("cell")).alias("cells"))

    def test(tables: pd.Series) -> pd.DataFrame:
        out = []
        for table in tables:
            pos = np.array([c["pos"] for c in table])
            size = pos + np.array([c["neg"] for c in table])
            n1, n = int(pos.sum()), int(size.sum())
            rank2 = 2 * (np.cumsum(size) - size) + size + 1            # twice the middle rank
            ways = np.zeros((n1 + 1, n * (n + 1) + 1))
            ways[0, 0] = 1.0
            for t, r in zip(size.tolist(), rank2.tolist()):
                before, ways = ways, ways.copy()
                for j in range(1, min(t, n1) + 1):
                    ways[j:, j * r :] += math.comb(t, j) * before[: n1 + 1 - j, : ways.shape[1] - j * r]
            seen = float((pos * rank2).sum())
            mean = n1 * (n + 1)
            far = np.abs(np.arange(ways.shape[1]) - mean) >= abs(seen - mean)
            out.append((seen / 2 - n1 * (n1 + 1) / 2, ways[n1, far].sum() / math.comb(n, n1)))
        return pd.DataFrame(out, columns=["u", "p_value"])

    tested = F.pandas_udf(test, "u double, p_value double")("cells")
    return cells.select(*by, "variable", "n1", "n0", tested.alias("t")).select(*by, "variable", "n1", "n0", "t.*")


def contingency(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(variable, modalite, pos, neg) for every column in one pass; null categories left out."""
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("modalite")) for c in columns]
    return (
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).alias("_y"), F.explode(F.array(*pairs)).alias("_p"))
        .select("_y", "_p.*")
        .filter(F.col("modalite").isNotNull())
        .groupBy("variable", "modalite")
        .agg(*class_counts(F.col("_y")))
    )


def chi_square(df: DataFrame, columns: Sequence[str], label: str, yates: bool = True) -> DataFrame:
    """Chi-squared statistic, degrees of freedom and Cramér's V per column.

    With one degree of freedom the Yates correction is applied by default.
    """
    cells = materialise(contingency(df, columns, label))   # read for the cells and for the margins
    margins = cells.groupBy("variable").agg(
        F.sum("pos").cast("double").alias("p_all"), F.sum("neg").cast("double").alias("n_all"),
        F.count(F.lit(1)).alias("r"),
    )
    classes = F.when((F.col("p_all") > 0) & (F.col("n_all") > 0), 2).otherwise(1)
    dof = (F.col("r") - 1) * (classes - 1)
    n = F.col("p_all") + F.col("n_all")
    row = F.col("pos") + F.col("neg")

    def part(seen, share):
        expected = row * share / n
        gap = F.abs(seen - expected)
        if yates:
            gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.when(expected > 0, gap * gap / expected).otherwise(0.0)

    chi2 = F.sum(part(F.col("pos"), F.col("p_all")) + part(F.col("neg"), F.col("n_all")))
    smaller = F.least(F.col("r"), classes) - 1
    return (
        cells.join(F.broadcast(margins), "variable")  # one row per tested column
        .groupBy("variable", dof.cast("int").alias("dof"), n.alias("n"), smaller.cast("int").alias("_m"))
        .agg(chi2.alias("chi2"))
        .select(
            "variable", F.lit("catégorielle/binaire").alias("type"), "n", "dof",
            F.when(F.col("dof") > 0, F.col("chi2")).otherwise(0.0).alias("chi2"),
            F.when(F.col("_m") > 0, F.sqrt(F.col("chi2") / (F.col("n") * F.col("_m")))).otherwise(0.0)
            .alias("taille_effet"),
        )
    )


def adjusted_p(tests: DataFrame, p: str = "p_value", key: str = "variable") -> DataFrame:
    """Benjamini-Hochberg adjustment over a table of one row per test."""
    rising = Window.orderBy(p, key)
    falling = Window.orderBy(F.desc(p), F.desc(key)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.count(F.lit(1)).over(Window.partitionBy())
    raw = F.col(p) * F.col("_m") / F.col("_rank")
    return (
        tests.withColumns({"_rank": F.row_number().over(rising), "_m": total})
        .withColumn("p_value_ajuste", F.least(F.lit(1.0), F.min(raw).over(falling)))
        .drop("_rank", "_m")
    )


def feature_verdicts(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Both families of tests, adjusted together, with effect label and keep/drop verdict.

    Rank tests of classes up to SMALL_CLASS rows have exact p-values.
    """
    num = mann_whitney(df, numeric, label, max_rows).withColumn("p_value", two_sided_normal("z"))
    if num.filter((F.col("n1") <= SMALL_CLASS) & (F.col("n0") <= SMALL_CLASS)).limit(1).count():
        exact = exact_rank_tests(df, numeric, label).select("variable", F.col("p_value").alias("_exact"))
        num = num.join(exact, "variable", "left").withColumn("p_value", F.coalesce("_exact", "p_value")).drop("_exact")
    cat = chi_square(df, categorical, label).withColumn("p_value", chi2_tail("chi2", "dof"))
    cols = ["variable", "type", "p_value", "taille_effet"]
    tests = num.select(cols).unionByName(cat.select(cols))
    return (
        adjusted_p(tests)
        .withColumn("force_effet", effect_label("taille_effet"))
        .withColumn("decision", effect_decision("force_effet"))
        .orderBy(F.desc("taille_effet"), "variable")
    )
