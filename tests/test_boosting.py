"""Boosted trees against plain restatements: splits, growth, both training forms, scoring."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import boosting
from ledgerlight.operators.boosting import Bins, Settings, Tree


def made(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n) / 2, rng.normal(size=n).round(1), rng.integers(0, 2, n)]).astype(float)
    x[rng.random(n) < 0.2, 0] = np.nan
    x[rng.random(n) < 0.1, 1] = np.nan
    y = ((np.nan_to_num(x[:, 0], nan=5.0) > 3) ^ (x[:, 2] > 0)) & (rng.random(n) < 0.9)
    return x, y.astype(float), np.where(y, 3.0, 1.0)


def exact_bins(x):
    ends = []
    for c in x.T:
        v = np.unique(c[~np.isnan(c)])
        ends.append((v[:-1] + v[1:]) / 2)
    return Bins(ends)


def best_split(x, g, h, s):
    """(gain, feature, threshold or None for all present values left, missing left, left rows) over every split."""
    best = (0.0, None)
    whole = g.sum() ** 2 / (h.sum() + s.l2)
    for f, c in enumerate(x.T):
        values = np.unique(c[~np.isnan(c)])
        for t in [*(values[:-1] + values[1:]) / 2, None]:
            for way in (False, True):
                left = np.where(np.isnan(c), way, True if t is None else c <= t)
                if min(left.sum(), (~left).sum()) < s.min_rows or min(h[left].sum(), h[~left].sum()) < s.min_hessian:
                    continue
                gain = g[left].sum() ** 2 / (h[left].sum() + s.l2) + g[~left].sum() ** 2 / (h[~left].sum() + s.l2) - whole
                if gain > best[0] + 1e-9:
                    best = (gain, (f, t, way, left))
    return best


def plain_tree(x, g, h, s):
    """Best-first growth by trying every split: the leaf value of each row."""
    leaves = [(np.arange(len(x)), 0)]
    while len(leaves) < s.max_leaves:
        tried = []
        for k, (rows, depth) in enumerate(leaves):
            gain, split = best_split(x[rows], g[rows], h[rows], s) if depth < s.max_depth else (0.0, None)
            if split:
                tried.append((gain, k, split[3]))
        if not tried:
            break
        _, k, left = max(tried, key=lambda t: t[0])
        rows, depth = leaves.pop(k)
        leaves += [(rows[left], depth + 1), (rows[~left], depth + 1)]
    out = np.zeros(len(x))
    for rows, _ in leaves:
        out[rows] = -s.step * g[rows].sum() / (h[rows].sum() + s.l2)
    return out, len(leaves)


@pytest.mark.parametrize("settings", [
    Settings(max_depth=1, min_rows=1), Settings(max_depth=3, min_rows=5), Settings(max_depth=5, max_leaves=6, min_rows=10, l2=0.0),
    Settings(max_depth=4, max_leaves=9, l2=25.0), Settings(max_depth=2, min_rows=300),
])
def test_tree_equals_trying_every_split(settings):
    x, y, w = made()
    bins = exact_bins(x)
    numbers = bins.numbers(list(x.T))
    g, h = boosting.slopes(np.full(len(y), -0.3), y, w)
    tree, rows = Tree(bins, settings), {1: np.arange(len(y))}
    while tree.measured:
        tree.absorb(boosting.level_sums(tree, numbers, rows, g, h))
        rows = tree.step_down(numbers, rows)
    tree.finish()
    want, leaves = plain_tree(x, g, h, settings)
    assert np.allclose(tree.values(numbers), want, atol=1e-9)
    assert all(np.allclose(tree.value[node], want[own], atol=1e-9) for node, own in rows.items())
    assert sum(n[1] < 0 for n in tree.plain()) == leaves


def frame(spark, x, y):
    cells = [[None if math.isnan(v) else float(v) for v in row] for row in x]
    return spark.createDataFrame([(k, *row, int(c)) for k, (row, c) in enumerate(zip(cells, y, strict=True))], "id long, a double, b double, c double, y int")


def test_both_forms_and_a_plain_loop_agree(spark, monkeypatch):
    x, y, w = made(300)
    df = frame(spark, x, y).repartition(4)
    settings = Settings(max_iter=7, max_depth=3, max_leaves=5, min_rows=5, step=0.3)
    monkeypatch.setattr(boosting, "KEEP_EVERY", 3)
    weight = F.when(F.col("y") == 1, 3.0).otherwise(1.0)
    one = boosting.fit_trees(df, ["a", "b", "c"], "y", weight, settings)
    jobs = boosting.fit_trees(df, ["a", "b", "c"], "y", weight, settings, one_task=0)
    flat = lambda m: [n[:4] for t in m.trees for n in t]
    assert len(one.trees) == 7 and flat(one) == flat(jobs)
    raw = np.full(len(y), math.log((w * y).sum() / (w * (1 - y)).sum()))
    for _ in range(7):
        raw += plain_tree(x, *boosting.slopes(raw, y, w), settings)[0]
    want = 1 / (1 + np.exp(-raw))
    for m in (one, jobs):
        got = m.scorer()(list(x.T))
        assert np.allclose(got, want, atol=1e-9)
    scored = boosting.add_probability(df, one, "p").orderBy("id").select("p", "a").toPandas()
    assert np.allclose(scored["p"], want, atol=1e-9) and scored["a"].isna().sum() == np.isnan(x[:, 0]).sum()


def test_model_is_saved_whole(spark, tmp_path):
    x, y, _ = made(200)
    m = boosting.fit_trees(frame(spark, x, y), ["a", "b", "c"], "y", F.lit(1.0), Settings(max_iter=4, max_leaves=64, min_rows=1))
    m.save(spark, str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(spark, str(tmp_path / "m"))
    new = [np.array([np.nan, -1e9, 1e9, 2.2]), np.array([0.0, np.nan, 5.0, -5.0]), np.array([1.0, 0.0, np.nan, 7.0])]
    assert again.features == m.features and np.array_equal(again.scorer()(new), m.scorer()(new))


def test_missing_branch_and_l2(spark):
    df = spark.createDataFrame([(None, 1)] * 30 + [(1.0, 0)] * 30 + [(2.0, 0)] * 30, "a double, y int")
    m = boosting.fit_trees(df, ["a"], "y", F.lit(1.0), Settings(max_iter=1, step=1.0, l2=0.0))
    low, high, none = m.scorer()([np.array([1.0, 2.0, np.nan])])
    assert low == high < 0.34 < none                  # only a branch of its own parts the missing rows
    strong = boosting.fit_trees(df, ["a"], "y", F.lit(1.0), Settings(max_iter=1, step=1.0, l2=1000.0))
    assert abs(strong.scorer()([np.array([np.nan])])[0] - 1 / 3) < 0.02


def test_training_stops_when_the_held_back_loss_does(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"a": rng.normal(size=1500), "y": rng.integers(0, 2, 1500)}))
    settings = Settings(max_iter=200, step=0.3, stop_from=1000, patience=3)
    one = boosting.fit_trees(df, ["a"], "y", F.lit(1.0), settings)
    assert 3 <= len(one.trees) < 60                   # noise: nothing to learn
    assert len(boosting.fit_trees(df, ["a"], "y", F.lit(1.0), Settings(max_iter=30, stop_from=1000, patience=0)).trees) == 30
    assert len(boosting.fit_trees(df, ["a"], "y", F.lit(1.0), settings, one_task=0).trees) == len(one.trees)


def test_bins_of_many_and_of_no_values(spark):
    df = spark.range(5000).select((F.col("id") % 1000).cast("double").alias("a"), F.lit(None).cast("double").alias("b"), F.lit(float("nan")).alias("c"), (F.col("id") % 3).cast("double").alias("d"))
    bins = boosting.find_bins(df.select("a", "b", "d", F.when(~F.isnan("c"), F.col("c")).alias("c")), ["a", "b", "c", "d"])
    assert 200 <= len(bins.edges[0]) <= 254 and [len(e) for e in bins.edges[1:]] == [0, 0, 2]
    sizes = np.bincount(np.searchsorted(bins.edges[0], np.arange(1000.0), "left"))
    assert sizes.max() <= 6 and bins.edges[3].tolist() == [0.5, 1.5]


def test_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 0)] * 50, "a double, y int")
    assert boosting.fit_trees(df, ["a"], "y", F.lit(1.0), Settings(max_iter=3)).scorer()([np.array([1.0, np.nan])]).max() < 1e-6
    for empty in (df.limit(0), df.withColumn("y", F.lit(None).cast("int"))):
        with pytest.raises(ValueError, match="no labelled rows"):
            boosting.fit_trees(empty, ["a"], "y", F.lit(1.0))


def test_many_rows_train_without_writing_or_reading_them_again(spark, monkeypatch):
    x, y, w = made(600)
    df = frame(spark, x, y).repartition(5)
    settings = Settings(max_iter=6, max_depth=3, max_leaves=6, min_rows=5, step=0.3)
    weight = F.when(F.col("y") == 1, 3.0).otherwise(1.0)
    monkeypatch.setattr(boosting, "PART_ROWS", 200)
    monkeypatch.setattr(boosting, "KEEP_EVERY", 2)
    written = []
    monkeypatch.setattr(boosting, "materialise", lambda rows, keep=boosting.materialise: written.append(rows) or keep(rows))
    one = boosting.fit_trees(df, ["a", "b", "c"], "y", weight, settings)
    before = len(written)
    jobs = boosting.fit_trees(df, ["a", "b", "c"], "y", weight, settings, one_task=599)
    assert len(written) - before == before == 1        # the training table alone, not the scores of every few trees
    assert len(jobs.trees) == 6 and [n[:4] for t in one.trees for n in t] == [n[:4] for t in jobs.trees for n in t]
    assert np.allclose(jobs.scorer()(list(x.T)), one.scorer()(list(x.T)), atol=1e-9)


def test_sums_by_codes_of_several_features_are_the_sums_by_feature(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CODED_ROWS", 150)
    x, y, w = made(900)
    bins, settings = exact_bins(x), Settings(max_iter=5, max_depth=4, min_rows=5, step=0.3)
    numbers = bins.numbers(list(x.T))
    for most in (bins.total**3, int(bins.width.max())):      # all features in one code, or one or two in each
        monkeypatch.setattr(boosting, "CODES", most)
        assert sorted(f for g in bins.coded() for f in g) == [0, 1, 2]
        codes, (g, h) = bins.codes(numbers), boosting.slopes(np.full(len(y), -0.3), y, w)
        tree, rows = Tree(bins, settings), {1: np.arange(len(y))}
        while tree.measured:
            plain = boosting.level_sums(tree, numbers, rows, g, h)
            assert np.allclose(boosting.level_sums(tree, numbers, rows, g, h, codes), plain, atol=1e-9)
            of = plain[:, 0, bins.start[1] : bins.start[1] + bins.width[1]]
            at = rows[tree.measured[0]]
            assert np.allclose(of, [[v[at][numbers[1, at] == b].sum() for b in range(bins.width[1])] for v in (g, h, np.ones(len(y)))])
            tree.absorb(plain)
            rows = tree.step_down(numbers, rows)
    held = Settings(max_iter=5, max_depth=4, min_rows=5, step=0.3, stop_from=800)
    weight = F.when(F.col("y") == 1, 3.0).otherwise(1.0)
    coded = boosting.fit_trees(frame(spark, x, y), ["a", "b", "c"], "y", weight, held)
    jobs = boosting.fit_trees(frame(spark, x, y), ["a", "b", "c"], "y", weight, held, one_task=0)
    assert [n[:4] for t in coded.trees for n in t] == [n[:4] for t in jobs.trees for n in t] and len(coded.trees) == 5


def test_rows_side_by_side_give_the_same_sums_to_the_last_bit(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CODED_ROWS", 150)
    x, y, w = made(900)
    bins, settings = exact_bins(x), Settings(max_iter=5, max_depth=5, min_rows=5, step=0.3)
    numbers, raw = bins.numbers(list(x.T)), np.linspace(-2, 2, len(y))
    p = 1 / (1 + np.exp(-raw))
    g, h = boosting.slopes(raw, y, w)
    assert np.array_equal(g, w * (p - y)) and np.array_equal(h, w * p * (1 - p))
    for codes in (None, bins.codes(numbers)):
        beside = [boosting.side_by_side(c) for c in (numbers, np.stack([g, h]), codes) if c is not None]
        assert [len(b) for b in beside] == [len(y)] * len(beside)
        tree, rows, seen, sizes = Tree(bins, settings), {1: np.arange(len(y))}, None, set()
        while tree.measured:
            plain = boosting.level_sums(tree, numbers, rows, g, h, codes)
            assert np.array_equal(boosting.level_sums(tree, numbers, rows, g, h, codes, beside, seen), plain)
            if seen is None:
                seen = plain[2, 0].copy()
                assert np.array_equal(boosting.level_sums(tree, numbers, rows, g, h, codes, beside, seen), plain)
            sizes |= {len(rows[n]) >= 150 for n in tree.measured}
            tree.absorb(plain)
            rows = tree.step_down(numbers, rows)
            assert sorted(np.concatenate(list(rows.values())).tolist()) == list(range(len(y)))
        assert sizes == {True, False}                  # nodes with codes and nodes without


def test_bins_count_the_features_as_groups_of_one_sketch(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(boosting.F, "approx_count_distinct", lambda c, rsd, f=F.approx_count_distinct: seen.append((c, rsd)) or f(c, rsd))
    df = spark.range(3000).select(*[(F.col("id") % m).cast("double").alias(f"f{m}") for m in (2, 40, 200, 900, 3000)], F.lit(None).cast("double").alias("none"))
    bins = boosting.find_bins(df, df.columns)
    assert len(seen) == 1
    assert [len(e) for e in bins.edges[:3]] == [1, 39, 199] and all(200 <= len(e) <= 254 for e in bins.edges[3:5]) and len(bins.edges[5]) == 0
    assert [len(e) for e in boosting.find_bins(df.limit(0), df.columns).edges] == [0] * 6


@pytest.mark.parametrize("leaves", [31, 64])
def test_moved_features_get_the_scores_of_whole_rows(spark, leaves):
    rng = np.random.default_rng(2)
    x, y = np.column_stack([rng.normal(size=1500), rng.normal(size=1500), rng.integers(0, 2, 1500)]), rng.integers(0, 2, 1500)
    x[::11, 0] = np.nan
    m = boosting.fit_trees(frame(spark, x, y), ["a", "b", "c"], "y", F.lit(1.0), Settings(max_iter=9, max_leaves=leaves, min_rows=1))
    assert (max(sum(n[1] < 0 for n in t) for t in m.trees) > 31) == (leaves == 64)
    numbers, score = m.bins.numbers(list(x.T)), m.scorer()
    moves = {f: np.stack([rng.permutation(len(y)) for _ in range(3)]) for f in (0, 2)}
    plain, moved = m.moved_scorer()(numbers, {f: numbers[f][to] for f, to in moves.items()})
    assert np.array_equal(plain, score(list(x.T))) and moved.keys() == {0, 2}
    for f, to in moves.items():
        for got, at in zip(moved[f], to, strict=True):
            assert np.array_equal(got, score([x[at, k] if k == f else x[:, k] for k in range(3)]))
    none = boosting.BoostedTrees(m.features, m.bins, 0.5, [])
    assert none.moved_scorer()(numbers, {1: numbers[1][None]})[1][1].tolist() == [none.scorer()(list(x.T)).tolist()]


def test_sums_of_a_partition_are_the_sums_of_its_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, y = np.column_stack([rng.normal(size=900).round(1), rng.normal(size=900).round(1), rng.integers(0, 2, 900)]), rng.integers(0, 2, 900).astype(float)
    x[::9, 0], w = np.nan, np.where(y, 3.0, 1.0)
    bins, settings = exact_bins(x), Settings(max_iter=5, max_depth=6, max_leaves=64, min_rows=2, step=0.3)
    numbers, raw = bins.numbers(list(x.T)), np.linspace(-2, 2, len(y))
    part = boosting.Part.of(numbers, y, w, raw)
    assert part.pairs.shape[1] == 2 and part.pair.dtype == np.uint8
    g, h = boosting.slopes(raw, y, w)
    for coded, block in ((30_000, 1 << 15), (1, 100), (120, 64), (120, 1 << 15)):
        for name, most in (("CODED_ROWS", coded), ("BLOCK", block), ("CHUNK", 130)):
            monkeypatch.setattr(boosting, name, most)
        for part.seen in (None, np.concatenate([np.bincount(b, minlength=n) for b, n in zip(numbers, bins.width)])):
            tree, rows = Tree(bins, settings), {1: np.arange(len(y))}
            while tree.measured:
                plain = boosting.level_sums(tree, numbers, rows, g, h)
                assert np.allclose(boosting.part_sums(tree, part), plain, atol=1e-9)
                tree.absorb(plain)
                rows = tree.step_down(numbers, rows)
            nodes = list(rows)
            at, place = tree.reached(numbers, nodes)
            assert len(nodes) > 31 and at.tolist() == list(range(len(y)))
            assert all(np.array_equal(np.flatnonzero(place == k), np.sort(rows[n])) for k, n in enumerate(nodes))
            at, place = tree.reached(numbers, nodes[3:5])
            assert np.array_equal(at[place == 1], np.sort(rows[nodes[4]])) and len(at) == len(rows[nodes[3]]) + len(rows[nodes[4]])
            tree.finish()
            assert np.array_equal(part.plus(tree).raw, raw + tree.values(numbers))
    many = boosting.Part.of(numbers, y, np.arange(1.0, 901), raw)          # a weight of its own for each row
    want = boosting.slopes(raw, y, np.arange(1.0, 901))
    assert all(np.array_equal(a, b) for a, b in zip(many.slopes(slice(None)), want))
    assert many.losses() == pytest.approx(boosting.losses(raw, y, np.arange(1.0, 901)))


def test_rows_travel_in_pieces_and_a_silent_partition_is_asked(spark, monkeypatch):
    x, y, w = made(900)
    df, weight = frame(spark, x, y).repartition(5), F.when(F.col("y") == 1, 3.0).otherwise(1.0)
    settings = Settings(max_iter=6, max_depth=3, max_leaves=6, min_rows=5, step=0.3, stop_from=500)
    fit = lambda **more: boosting.fit_trees(df, ["a", "b", "c"], "y", weight, settings, **more)
    one = fit()
    monkeypatch.setattr(boosting, "PART_ROWS", 200)
    monkeypatch.setattr(boosting, "PIECE", 64)
    monkeypatch.setattr(boosting, "KEEP_EVERY", 2)
    told, flat = [], lambda m: [n[:4] for t in m.trees for n in t]
    monkeypatch.setattr(boosting.Told, "addInPlace", lambda self, a, b: told.extend(b.values()) or a | b)
    jobs = fit(one_task=0)
    assert flat(jobs) == flat(one) and len(one.trees) == 6
    counted = [s[1][2].sum() / 3 for s in told]                 # a row has one bin of each of the three features
    assert 7 * 700 < sum(counted) < 7 * 900 and sum(counted) % 7 == 0          # roots of six trees and of the next; a tenth is held back
    assert np.allclose(jobs.scorer()(list(x.T)), one.scorer()(list(x.T)), atol=1e-9)
    monkeypatch.setattr(boosting.Told, "addInPlace", lambda self, a, b: {})
    assert flat(fit(one_task=0)) == flat(one)

