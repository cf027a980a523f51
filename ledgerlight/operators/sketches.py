"""Mergeable sketches: quantiles (KLL) and distinct counts (HyperLogLog).

A sketch table has one small row per group; months or days are sketched once and merged later, so an
answer over years reads sketches, not rows.  No value is shuffled: tasks combine sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.ranks import long_form

KLL_SIZE = 2048          # sketch size
RANK_ERROR = 0.005       # share of the rows by which a quantile of such a sketch may be off; twice its 99 % error
HLL_BITS = 14
DISTINCT_ERROR = 0.04    # relative error; five standard errors of 1.04 / sqrt(2^14)


def quantile_sketches(df: DataFrame, features: Sequence[str], by: Sequence[str | Column] = (), size: int = KLL_SIZE) -> DataFrame:
    """(by..., variable, sketch): one sketch of the non-null values per feature and group."""
    rows = long_form(df, features, by)
    names = [c for c in rows.columns if c not in ("variable", "value")]
    return rows.groupBy(*names, "variable").agg(F.kll_sketch_agg_double("value", size).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: dict[str, float], by: Sequence[str] = (), size: int = KLL_SIZE) -> DataFrame:
    """(by..., variable, nombre, names of ``probs``) of merged sketches; quantiles are values of the data."""
    merged = sketches.groupBy(*by, "variable").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    return merged.select(
        *by, "variable", F.kll_sketch_get_n_double("sketch").alias("nombre"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for n, p in probs.items()],
    )


def approximate_quantiles(df: DataFrame, features: Sequence[str], probs: dict[str, float], size: int = KLL_SIZE) -> DataFrame:
    """(variable, nombre, names of ``probs``) in one pass, off by RANK_ERROR of the rows at most."""
    return sketched_quantiles(quantile_sketches(df, features, size=size), probs, size=size)


def rank_gaps(df: DataFrame, quantiles: DataFrame, probs: dict[str, float]) -> DataFrame:
    """(variable, nombre, names of ``probs``): how far, as a share of the rows, each value is from its rank.

    ``quantiles`` has one row per feature and is broadcast.  The ranks of equal values are a range; a rank within is no gap.
    """
    features = [r["variable"] for r in quantiles.select("variable").collect()]
    rows = long_form(df, features).join(F.broadcast(quantiles.select("variable", *probs)), "variable")
    sums = [F.count(F.lit(1)).alias("nombre")]
    for name in probs:
        sums += [F.count_if(F.col("value") < F.col(name)).alias(f"{name}_below"), F.count_if(F.col("value") <= F.col(name)).alias(f"{name}_upto")]
    gaps = [
        F.greatest(F.lit(0.0), F.col(f"{n}_below") / F.col("nombre") - p, p - F.col(f"{n}_upto") / F.col("nombre")).alias(n)
        for n, p in probs.items()
    ]
    return rows.groupBy("variable").agg(*sums).select("variable", "nombre", *gaps)


def distinct_sketches(df: DataFrame, keys: Sequence[str], by: Sequence[str | Column] = (), bits: int = HLL_BITS) -> DataFrame:
    """(by..., variable, lignes, sketch): one sketch of the non-null keys per key column and group."""
    pairs = F.array(*[F.struct(F.lit(k).alias("variable"), F.col(k).cast("string").alias("cle")) for k in keys])
    rows = df.select(*by, F.explode(pairs).alias("_p")).select("*", "_p.*").drop("_p")
    names = [c for c in rows.columns if c not in ("variable", "cle")]
    return rows.groupBy(*names, "variable").agg(F.count(F.lit(1)).alias("lignes"), F.hll_sketch_agg("cle", bits).alias("sketch"))


def sketched_distincts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, lignes, distincts) of merged sketches."""
    merged = sketches.groupBy(*by, "variable").agg(F.sum("lignes").alias("lignes"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "variable", "lignes", F.hll_sketch_estimate("sketch").alias("distincts"))


def approximate_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(variable, lignes, distincts) of several key columns in one pass without a shuffle of keys."""
    return sketched_distincts(distinct_sketches(df, keys))
