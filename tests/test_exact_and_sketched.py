"""Exact small tests, collinearity with a rank decision, sketches: against enumeration and exact answers."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import clean, sketches, stats


def middle_ranks(values):
    return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]


def enumerated(values, labels):
    ranks, n1 = middle_ranks(values), sum(labels)
    seen, mean = sum(r for r, y in zip(ranks, labels) if y), n1 * (len(values) + 1) / 2
    sums = [sum(c) for c in itertools.combinations(ranks, n1)]
    return seen - n1 * (n1 + 1) / 2, sum(abs(s - mean) >= abs(seen - mean) - 1e-9 for s in sums) / len(sums)


def test_exact_rank_tests_equal_enumeration(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for g, (n1, n0, distinct) in enumerate([(1, 1, 5), (3, 4, 100), (4, 5, 3), (2, 9, 2), (5, 5, 1), (6, 7, 8)]):
        values = [float(rng.randrange(distinct)) for _ in range(n1 + n0)]
        labels = [1] * n1 + [0] * n0
        rows += [(g, v, y) for v, y in zip(values, labels)]
        want[g] = enumerated(values, labels)
    rows += [(None, 1.0, 1), (None, 2.0, 0), (90, 1.0, 1), (91, 1.0, 0), (92, None, 1), (92, 1.0, None), (92, float("nan"), 0)]
    rows += [(93, float(k), k % 2) for k in range(60)]                       # classes of 30: not small
    df = spark.createDataFrame(rows, "g int, x double, y int")
    got = {r["g"]: r for r in stats.exact_rank_tests(df, ["x"], "y", ["g"]).collect()}
    assert set(got) == {*want, None}
    for g, (u, p) in want.items():
        assert got[g]["u"] == pytest.approx(u) and got[g]["p_value"] == pytest.approx(p)
    assert (got[None]["n1"], got[None]["n0"], got[None]["p_value"]) == (1, 1, 1.0)


def test_exact_p_of_great_classes_and_in_verdicts(spark):
    df = spark.createDataFrame([(float(k), int(k < 20), "a") for k in range(40)], "x double, y int, c string")
    p = stats.exact_rank_tests(df, ["x"], "y").first()
    assert p["p_value"] == pytest.approx(2 / math.comb(40, 20)) and p["u"] == 0.0
    verdict = stats.feature_verdicts(df, ["x"], ["c"], "y").filter("variable = 'x'").first()
    assert verdict["p_value"] == pytest.approx(2 / math.comb(40, 20))
    more = df.unionByName(df.withColumn("x", F.col("x") + 0.5))
    about = stats.feature_verdicts(more, ["x"], ["c"], "y").filter("variable = 'x'").first()
    assert about["p_value"] > 1e-20 and stats.exact_rank_tests(more, ["x"], "y").count() == 0


def test_pivoted_cholesky():
    rng = np.random.default_rng(2)
    for size, rank in ((1, 1), (4, 4), (6, 3)):
        base = rng.normal(size=(size, rank))
        a = base @ base.T
        unit = a / np.sqrt(np.outer(np.diag(a), np.diag(a)))
        factor, order = stats.pivoted_cholesky(unit)
        assert len(order) == rank and len(set(order)) == rank and np.allclose(np.triu(factor, 1), 0)
        assert np.allclose(factor @ factor.T, unit[np.ix_(order, order)])


def test_variance_inflation_decides_the_rank(spark):
    rng = random.Random(3)
    rows = [(a, b, a + 2 * b, rng.random(), 0.0) for a, b in ((rng.random(), rng.random()) for _ in range(50))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, z double")
    got = {r["variable"]: r["vif"] for r in stats.variance_inflation(df, ["a", "b", "c", "d", "z"]).collect()}
    assert got["a"] == got["b"] == got["c"] == math.inf and 1 <= got["d"] < 20 and got["z"] == 1.0
    x = np.array(rows)[:, [0, 1, 3]]
    gram = x.T @ x
    plain = np.diag(gram) * np.diag(np.linalg.inv(gram))
    sound = {r["variable"]: r["vif"] for r in stats.variance_inflation(df, ["a", "b", "d"]).collect()}
    assert [sound[c] for c in "abd"] == pytest.approx(plain.tolist())


def test_quantile_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 20_000).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    probs = {"q1": 0.01, "m": 0.5, "q9": 0.9}
    merged = sketches.sketched_quantiles(sketches.quantile_sketches(df, ["x", "y"], ["g"]), probs).collect()
    assert [r["variable"] for r in merged] == ["x"] and merged[0]["nombre"] == 20_000       # a column of nulls is missing
    for name, p in probs.items():
        assert abs(merged[0][name] / 20_000 - p) <= sketches.RANK_ERROR
    per_group = sketches.sketched_quantiles(sketches.quantile_sketches(df, ["x"], ["g"]), probs, ["g"])
    assert per_group.count() == 7 and per_group.agg(F.sum("nombre")).first()[0] == 20_000
    gaps = sketches.rank_gaps(df, sketches.approximate_quantiles(df, ["x"], probs), probs).first()
    assert max(gaps[n] for n in probs) <= sketches.RANK_ERROR
    off = sketches.rank_gaps(df, df.limit(1).select(F.lit("x").alias("variable"), *[F.lit(0.0).alias(n) for n in probs]), probs).first()
    assert off["q9"] == pytest.approx(0.9, abs=1e-3)


def test_approximate_medians_fill(spark):
    df = spark.createDataFrame([(float(k) if k % 5 else None,) for k in range(1, 1001)], "x double")
    exact, about = (clean.impute_medians(df, ["x"], {"x": "f"}, approximate=a).agg(F.min(F.when(F.col("f") == 1, F.col("x")))).first()[0] for a in (False, True))
    assert exact == 500.5 or abs(exact - 500) < 2
    assert abs(about - exact) <= 1000 * sketches.RANK_ERROR + 1


def test_distinct_sketches_merge(spark):
    df = spark.range(30_000).select((F.col("id") % 5).alias("g"), (F.col("id") % 9000).alias("k"), F.lit(None).cast("string").alias("none"))
    got = {r["variable"]: r for r in sketches.sketched_distincts(sketches.distinct_sketches(df, ["k", "none"], ["g"])).collect()}
    assert got["k"]["lignes"] == 30_000 and abs(got["k"]["distincts"] - 9000) <= 9000 * sketches.DISTINCT_ERROR
    assert got["none"]["distincts"] == 0
    assert sketches.approximate_key_counts(df, ["k"]).first()["distincts"] == got["k"]["distincts"]
