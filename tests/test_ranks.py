"""Quantiles, rank tests and curves against direct computation."""

import math
import random

import numpy as np
import pytest

from ledgerlight.operators import evaluate, ranks, stats


def sample(seed=3, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        out.append((i, y, round(min(1.0, max(0.0, rng.gauss(0.35 + 0.25 * y, 0.2))), 2)))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(sample(), "id int, y int, s double")


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_quantiles_equal_numpy(spark, scored, max_rows):
    got = ranks.exact_quantiles(scored, ["s"], {"a": 0.1, "b": 0.5, "c": 0.988}, max_rows=max_rows).first()
    values = [s for _, _, s in sample()]
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.988])))


def test_quantiles_by_group_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), (None, 7.0), ("b", None)], "g string, v double")
    got = {r["g"]: r["mediane"] for r in ranks.exact_medians(df, ["v"], ["g"]).collect()}
    assert got == {"a": 2.0, None: 7.0}


def test_values_of_many_features_are_counted_one_feature_at_a_time(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ranks, "materialise", lambda rows, keep=ranks.materialise: written.append(rows.columns) or keep(rows))
    nan = float("nan")
    df = spark.createDataFrame([("a", 1, 1.0, 5), ("a", 0, 1.0, None), (None, 1, nan, 5), ("a", 1, 2.0, 5), ("b", None, None, 7)], "g string, y int, v double, w int")
    counts = ranks.value_counts(df, ["v", "w"], ["g"])
    got = sorted((r["variable"], r["value"], str(r["g"]), r["n"]) for r in counts.collect())
    assert got == [("v", 1.0, "a", 2), ("v", 2.0, "a", 1), ("w", 5.0, "None", 1), ("w", 5.0, "a", 2), ("w", 7.0, "b", 1)]
    sums = {r["variable"]: (r["n1"], r["n0"], r["u"]) for r in ranks.rank_sums(df, ["v", "w"], "y").collect()}
    assert sums == {"v": (2, 1, 1.5), "w": (3, 0, 0.0)}
    # The narrow rows are written first, so no task holds the pairs of all features of its rows.
    assert written[0] == ["g", "_f0", "_f1"] and written[2] == ["_y", "_f0", "_f1"]


def brute_u(data):
    return sum((a > b) + 0.5 * (a == b) for _, ya, a in data if ya for _, yb, b in data if not yb)


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_auc_equals_pairs(spark, scored, max_rows):
    data = sample()
    n1 = sum(y for _, y, _ in data)
    expected = brute_u(data) / (n1 * (len(data) - n1))
    assert ranks.univariate_auc(scored, ["s"], "y", max_rows).first()["auc"] == pytest.approx(expected)
    assert ranks.curve_summary(ranks.score_curve(scored, "y", "s", max_rows=max_rows)).first()["roc_auc"] == pytest.approx(expected)


def brute_curve(data):
    out = []
    for t in sorted({s for _, _, s in data}):
        tp = sum(y for _, y, s in data if s >= t)
        fp = sum(1 - y for _, y, s in data if s >= t)
        out.append((t, tp, fp))
    return out


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_curve_and_figures(spark, scored, max_rows):
    data = sample()
    pos = sum(y for _, y, _ in data)
    neg = len(data) - pos
    brute = brute_curve(data)
    curve = ranks.score_curve(scored, "y", "s", max_rows=max_rows)
    assert [(r["threshold"], r["tp"], r["fp"]) for r in curve.orderBy("threshold").collect()] == brute
    last = curve.orderBy("threshold").first()
    assert (last["tp"], last["fp"]) == (pos, neg)

    got = ranks.curve_summary(curve).first()
    precision = [tp / (tp + fp) for _, tp, fp in brute]
    recall = [tp / pos for _, tp, _ in brute]
    steps = recall[1:] + [0.0]
    assert got["pr_auc"] == pytest.approx(sum((r - s) * p for r, s, p in zip(recall, steps, precision)))
    assert got["lift"] == pytest.approx(got["pr_auc"] / (pos / len(data)))
    f1 = [2 * p * r / (p + r + 1e-9) for p, r in zip(precision, recall)]
    assert got["best_threshold_f1"] == brute[int(np.argmax(f1))][0] and got["best_f1"] == pytest.approx(max(f1))
    cost = [10 * fp + 1000 * (pos - tp) for _, tp, fp in brute]
    assert got["best_threshold_cost"] == brute[int(np.argmin(cost))][0] and got["min_cost"] == min(cost)
    good = [r for p, r in zip(precision, recall) if p >= 0.8]
    assert got["recall_at_precision"] == pytest.approx(max(good, default=0.0))


@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_roc_points_keep_the_corners(spark, scored, max_rows):
    curve = ranks.score_curve(scored, "y", "s", max_rows=max_rows)
    every = ranks.roc_points(curve, drop_intermediate=False)
    few = ranks.roc_points(curve, max_rows=max_rows).orderBy("fpr", "tpr").collect()
    assert (few[0]["fpr"], few[0]["tpr"]) == (0.0, 0.0) and (few[-1]["fpr"], few[-1]["tpr"]) == (1.0, 1.0)
    full = [(r["fpr"], r["tpr"]) for r in every.orderBy("fpr", "tpr").collect()]
    assert len(few) <= len(full)
    area = lambda p: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(p, p[1:]))
    assert area([(r["fpr"], r["tpr"]) for r in few]) == pytest.approx(area(full))


@pytest.mark.parametrize(
    "data", [[(1, 1.0), (1, 0.5)], [(1, 0.3)], [(0, 0.0), (1, 1.0)], [(1, 0.4), (0, 0.4)], [(None, 0.3), (1, None), (1, 0.2)]]
)
def test_curve_edges(spark, data):
    df = spark.createDataFrame(data, "y int, s double")
    known = [(y, s) for y, s in data if y is not None and s is not None]
    got = ranks.curve_summary(ranks.score_curve(df, "y", "s")).first()
    assert got["n_pos"] + got["n_neg"] == len(known)
    assert (got["roc_auc"] is None) == (len({y for y, _ in known}) == 1)
    assert ranks.precision_recall_points(ranks.score_curve(df, "y", "s")).filter("threshold is null").count() == 1


def test_grouped_curves_are_independent(spark, scored):
    both = scored.selectExpr("'x' as g", "y", "s").unionByName(scored.selectExpr("'z' as g", "y", "1 - s as s"))
    got = {r["g"]: r["roc_auc"] for r in ranks.curve_summary(ranks.score_curve(both, "y", "s", ["g"], 10), ["g"]).collect()}
    assert got["x"] + got["z"] == pytest.approx(1.0)


def test_mann_whitney_against_known_values(spark):
    """By hand: x = 1 2 3 4 5, y = 3 4 5 6 7 gives U = 4.5 and two-sided p of about 0.1139."""
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 4, 5)] + [(0, float(v)) for v in (3, 4, 5, 6, 7)], "y int, v double")
    got = stats.mann_whitney(df, ["v"], "y").withColumn("p", stats.two_sided_normal("z")).first()
    assert got["u"] == 4.5
    ranks_var = 25 / 12 * (11 - 3 * 6 / 90)
    z = (20.5 - 12.5 - 0.5) / math.sqrt(ranks_var)
    assert got["z"] == pytest.approx(z) and got["p"] == pytest.approx(math.erfc(z / math.sqrt(2)))
    assert got["taille_effet"] == pytest.approx(abs(1 - 2 * 4.5 / 25))


def test_chi_square_and_yates(spark):
    data = [("a", 1)] * 10 + [("a", 0)] * 20 + [("b", 1)] * 30 + [("b", 0)] * 40 + [(None, 1)] * 5
    df = spark.createDataFrame(data, "c string, y int")
    with_yates, without = (stats.chi_square(df, ["c"], "y", yates=f).first() for f in (True, False))
    cells = {("a", 1): 10, ("a", 0): 20, ("b", 1): 30, ("b", 0): 40}
    expected = {k: (30 if k[0] == "a" else 70) * (40 if k[1] else 60) / 100 for k in cells}
    plain = sum((cells[k] - e) ** 2 / e for k, e in expected.items())
    yates = sum((abs(cells[k] - e) - 0.5) ** 2 / e for k, e in expected.items())
    assert without["chi2"] == pytest.approx(plain) and with_yates["chi2"] == pytest.approx(yates)
    assert with_yates["dof"] == 1 and with_yates["n"] == 100
    assert with_yates["taille_effet"] == pytest.approx(math.sqrt(yates / 100))


def test_chi_square_of_one_category_is_zero(spark):
    got = stats.chi_square(spark.createDataFrame([("a", 1), ("a", 0)], "c string, y int"), ["c"], "y").first()
    assert (got["dof"], got["chi2"], got["taille_effet"]) == (0, 0.0, 0.0)


def test_chi2_tail(spark):
    """Closed forms: one degree by erfc, two by exp, four by exp times a line."""
    rows = [(3.84, 1), (0.1, 1), (5.99, 2), (60.0, 2), (9.49, 4), (0.5, 4), (0.0, 3), (1.0, 0)]
    got = [r["p"] for r in spark.createDataFrame(rows, "x double, k int").select(stats.chi2_tail("x", "k").alias("p")).collect()]
    want = [math.erfc(math.sqrt(3.84 / 2)), math.erfc(math.sqrt(0.05)), math.exp(-2.995), math.exp(-30.0),
            math.exp(-4.745) * 5.745, math.exp(-0.25) * 1.25, 1.0, 1.0]
    assert got == pytest.approx(want, rel=1e-12)


def test_adjusted_p(spark):
    p = {"a": 0.01, "b": 0.04, "c": 0.03, "d": 0.9}
    got = {r["variable"]: r["p_value_ajuste"] for r in stats.adjusted_p(spark.createDataFrame(list(p.items()), "variable string, p_value double")).collect()}
    assert got == pytest.approx({"a": 0.04, "c": 0.04 * 4 / 3, "b": 0.04 * 4 / 3, "d": 0.9})
    assert all(got[k] >= p[k] for k in p)


def test_vif_equals_regression(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) + [5, 0, 1, 2]
    x[:, 3] = x[:, 0] * 0.8 + rng.normal(size=200) * 0.3
    names = ["a", "b", "c", "d"]
    got = {r["variable"]: r["vif"] for r in stats.variance_inflation(spark.createDataFrame(x.tolist(), names), names).collect()}
    for i, n in enumerate(names):
        rest = np.delete(x, i, axis=1)
        fit = rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fit) ** 2).sum() / (x[:, i] ** 2).sum()
        assert got[n] == pytest.approx(1 / (1 - r2))


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (None, 0.9), (1, None)], "y int, s double")
    cells = {(r["reel"], r["predit"]): r["nombre"] for r in evaluate.confusion(df, "y", "s", 0.5).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    report = {r["classe"]: r for r in evaluate.class_report(df, "y", "s", {"t": 0.95}).collect()}
    assert report["Fraude"]["precision"] == 0.0 and report["Normal"]["recall"] == 1.0 and report["accuracy"]["f1"] == 0.5


def test_histogram_ends(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (None, 0.5)], "y int, s double")
    got = {(r["tranche"], r["classe"]): r["nombre"] for r in evaluate.score_histogram(df, "s", "y").collect()}
    assert got == {(1, "Normal"): 1, (60, "Fraude"): 1, (31, "Inconnue"): 1}
