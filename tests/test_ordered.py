"""Windows over cut groups must equal the plain windows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import ordered as O
from ledgerlight.operators.profile import with_group_stats
from ledgerlight.operators.risk import occurrence_numbers

FRAME = {"mean": F.avg, "dev": F.stddev, "n": F.count}


def rows(seed=1, n=600):
    """A third of the rows on one key, many equal times, some null keys."""
    rng = random.Random(seed)
    keys = ["hot"] * 3 + ["a", "b", "c", None, "d", "e"]
    return [(i, rng.choice(keys), rng.randrange(40), float(rng.randrange(100))) for i in range(n)]


def features(df, max_rows, previous=30):
    return (
        O.ordered_features(
            df, ["k"], ["t", "id"], previous,
            {n: f("x") for n, f in FRAME.items()}, {"total": F.col("x"), "rank": F.lit(1)}, max_rows,
        )
        .orderBy("id").toPandas()
    )


@pytest.mark.parametrize("max_rows,previous", [(70, 3), (70, 8), (100, 5), (150, 30), (60, 1)])
def test_cut_groups_equal_plain_windows(spark, max_rows, previous):
    df = spark.createDataFrame(rows(n=1500), "id int, k string, t int, x double")
    plain = features(df, 10**6, previous)
    cut = features(df, max_rows, previous)
    pd.testing.assert_frame_equal(plain, cut[plain.columns], check_exact=False, rtol=1e-12)


def test_groups_are_really_cut(spark):
    df = spark.createDataFrame(rows(), "id int, k string, t int, x double")
    cut = O.cut_hot_groups(df, ["k"], ["t", "id"], 70)
    assert cut.cuts is not None
    per_key = cut.frame.groupBy("k").agg(F.countDistinct(O.SEG).alias("n")).filter("k = 'hot'").first()["n"]
    sizes = cut.frame.filter("k = 'hot'").groupBy(O.SEG).count().orderBy(O.SEG).collect()
    assert per_key > 2
    assert all(r["count"] >= 64 for r in sizes[:-1])


def test_matches_brute_force(spark):
    data = rows(5, 300)
    got = {r["id"]: r for r in features(spark.createDataFrame(data, "id int, k string, t int, x double"), 64, 5).to_dict("records")}
    for key in {r[1] for r in data}:
        mine = sorted((t, i, x) for i, k, t, x in data if k == key)
        total = 0.0
        for pos, (t, i, x) in enumerate(mine):
            before = [v for _, _, v in mine[max(0, pos - 5):pos]]
            total += x
            assert got[i]["total"] == pytest.approx(total) and got[i]["rank"] == pos + 1
            assert got[i]["n"] == len(before)
            if before:
                assert got[i]["mean"] == pytest.approx(sum(before) / len(before))


def test_history_lengths(spark):
    """0, 1, 2 and 32 earlier rows; a deviation of one row is null."""
    df = spark.createDataFrame([(i, "k", i, 1.0) for i in range(33)], "id int, k string, t int, x double")
    got = features(df, 10**6)
    assert list(got["n"])[:3] == [0, 1, 2] and got["n"].iloc[32] == 30
    assert pd.isna(got["mean"].iloc[0]) and pd.isna(got["dev"].iloc[1]) and got["dev"].iloc[2] == 0.0


@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_left_join(spark, null_safe):
    df = spark.createDataFrame(rows(), "id int, k string, t int, x double")
    side = spark.createDataFrame([("hot", 1), ("a", 2), ("z", 3), (None, 4)], "k string, v int")
    plain = O.spread_join(df, side, ["k"], null_safe).orderBy("id").collect()
    spread = O.spread_join(df, side, ["k"], null_safe, max_rows=50).orderBy("id").collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in spread]
    assert {r["v"] for r in plain if r["k"] is None} == ({4} if null_safe else {None})


def test_group_stats_and_occurrences_with_hot_keys(spark):
    df = spark.createDataFrame(rows(), "id int, k string, t int, x double")
    for fn in (
        lambda m: with_group_stats(df, ["k"], "x", max_rows=m),
        lambda m: occurrence_numbers(df, "k", "t", ["x", "id"], max_rows=m),
    ):
        plain = fn(10**6).orderBy("id").toPandas()
        cut = fn(60).orderBy("id").toPandas()
        pd.testing.assert_frame_equal(plain, cut[plain.columns], check_exact=False, rtol=1e-12)


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, "c"), (None, 1, "d")], "k int, t int, v string")
    assert {tuple(r) for r in O.latest_per_key(df, ["k"], ["t"]).collect()} == {(1, 2, "b"), (2, 5, "c"), (None, 1, "d")}
    assert {tuple(r) for r in O.first_per_key(df, ["k"], ["t"]).collect()} == {(1, 1, "a"), (2, 5, "c"), (None, 1, "d")}


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, k string, t int, x double")
    assert len(features(df, 10)) == 0


@pytest.mark.parametrize("max_rows,days", [(70, 3), (70, 30), (100, 0.5), (10**6, 7)])
def test_time_frames_equal_brute_force(spark, max_rows, days):
    data = [(i, k, None if i % 97 == 0 else t / 4, x) for i, k, t, x in rows(8, 700)]
    at = F.when(F.col("d").isNotNull(), F.timestamp_micros((F.col("d") * 86_400_000_000).cast("long")))
    df = spark.createDataFrame(data, "id int, k string, d double, x double").withColumn("t", at)
    got = O.time_features(df, ["k"], "t", ["t", "id"], days, {"mean": F.avg("x"), "n": F.count("id")}, max_rows)
    assert set(got.columns) == {"id", "k", "d", "x", "t", "mean", "n"}
    got = {r["id"]: r for r in got.collect()}
    assert len(got) == len(data)
    for i, k, d, _ in data:
        before = [x for _, j, e, x in data if j == k and d is not None and e is not None and d - days <= e < d]
        if d is not None:
            assert got[i]["n"] == len(before)
            assert got[i]["mean"] == (pytest.approx(sum(before) / len(before)) if before else None)


def test_time_frames_of_cut_groups_equal_plain_windows(spark):
    df = spark.createDataFrame(rows(n=1500), "id int, k string, t int, x double").withColumn("t", F.timestamp_seconds(F.col("t") * 40_000))
    frame = {"mean": F.avg("x"), "dev": F.stddev("x"), "n": F.count("id")}
    plain, cut = (O.time_features(df, ["k"], "t", ["t", "id"], 4, frame, m).orderBy("id").toPandas() for m in (10**6, 80))
    pd.testing.assert_frame_equal(plain, cut[plain.columns], check_exact=False, rtol=1e-12)
