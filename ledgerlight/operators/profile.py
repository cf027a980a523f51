"""Profiles and group aggregates, each from one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions.scalars import safe_div
from ledgerlight.operators.ordered import MAX_ROWS, match_small, spread_join
from ledgerlight.operators.ranks import moments_of, quantiles_of, value_counts
from ledgerlight.session import materialise


def _unpivot(one: DataFrame, structs: list[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def group_count(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("nombre")).orderBy(F.desc("nombre"), key)


def top_groups(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return group_count(df, key).limit(n)


def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("nombre"), F.avg(value).alias("moyenne"),
            F.min(value).alias("minimum"), F.max(value).alias("maximum"),
        )
        .orderBy(F.desc("moyenne"), key)
    )


def fraud_rate(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Count, frauds and rate in percent with two decimals, highest rate first."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total"), F.sum(label).alias("fraudes"))
        .withColumn("taux_fraude_pct", F.round(F.col("fraudes") * F.lit(100.0) / F.col("total"), 2))
        .orderBy(F.desc("taux_fraude_pct"), *keys)
    )


def rate_per_category(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(variable, modalite, nb, taux_fraude) for all columns in one pass."""
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("modalite")) for c in columns]
    return (
        df.select(F.col(label).alias("_y"), F.explode(F.array(*pairs)).alias("_p"))
        .select("_y", "_p.*")
        .filter(F.col("modalite").isNotNull())
        .groupBy("variable", "modalite")
        .agg(F.count("_y").alias("nb"), F.avg("_y").alias("taux_fraude"))
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and duplicates.

    Two plain aggregates instead of ``countDistinct``: the first one combines
    on the map side, so a hot key costs one row per task.
    """
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("lignes"),
            F.count(key).alias("distincts"),
        )
        .withColumn("doublons", F.col("lignes") - F.col("distincts"))
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(variable, nb_manquants, pct_manquants) per column."""
    columns = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    return _unpivot(
        one,
        [
            F.struct(
                F.lit(c).alias("variable"), F.col(f"c{i}").alias("nb_manquants"),
                F.round(safe_div(F.col(f"c{i}") * F.lit(100.0), F.col("_n")), 2).alias("pct_manquants"),
            )
            for i, c in enumerate(columns)
        ],
    )


def column_overview(df: DataFrame) -> DataFrame:
    """(variable, type, non_nuls) per column."""
    one = df.agg(*[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return _unpivot(
        one,
        [
            F.struct(F.lit(c).alias("variable"), F.lit(t).alias("type"), F.col(f"c{i}").alias("non_nuls"))
            for i, (c, t) in enumerate(df.dtypes)
        ],
    )


def describe(df: DataFrame, features: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per feature, from one table of value counts."""
    counts = value_counts(df, features)
    quartiles = quantiles_of(counts, {"q1": 0.25, "mediane": 0.5, "q3": 0.75}, max_rows=max_rows)
    return moments_of(counts, max_rows=max_rows).join(F.broadcast(quartiles), "variable")  # one row per feature


def class_comparison(df: DataFrame, features: Sequence[str], label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """Mean and exact median of every feature per class: (variable, label, moyenne, mediane)."""
    counts = value_counts(df, features, [label])
    means = counts.groupBy("variable", label).agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("moyenne")
    )
    return match_small(means, quantiles_of(counts, {"mediane": 0.5}, [label], max_rows), ["variable", label], "left")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Size of both classes, rate of the positive one and the ratio between them."""
    rate = F.avg(F.col(label).cast("double"))
    return df.filter(F.col(label).isNotNull()).agg(
        F.count_if(F.col(label) == 0).alias("normales"), F.count_if(F.col(label) == 1).alias("fraudes"),
        rate.alias("taux_fraude"),
    ).withColumn("ratio", safe_div(F.col("normales").cast("double"), F.col("fraudes"), 0.0))



def split_balance(df: DataFrame, label: str, part: str = "partie") -> DataFrame:
    """Label counts and percents, train beside test."""
    side = {p: F.count_if(F.col(part) == p) for p in ("train", "test")}
    counts = df.groupBy(label).agg(*[n.alias(f"{p}_effectif") for p, n in side.items()])
    whole = Window.partitionBy()   # over one row per class
    columns = [F.col(label)]
    for p in side:
        size = F.col(f"{p}_effectif")
        columns += [size, safe_div(size * F.lit(100.0), F.sum(size).over(whole)).alias(f"{p}_pct")]
    return counts.select(*columns)


def weighted_average(value: Column | str, weight: Column | str) -> Column:
    value, weight = (F.col(c) if isinstance(c, str) else c for c in (value, weight))
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def category_shares(df: DataFrame, key: str) -> DataFrame:
    """Count and share of every category."""
    counts = materialise(df.groupBy(key).agg(F.count(F.lit(1)).alias("nombre")))
    share = F.col("nombre") / counts.agg(F.sum("nombre")).scalar()
    return counts.withColumn("part", share).orderBy(F.desc("nombre"), key)


def with_group_stats(
    df: DataFrame, keys: Sequence[str], value: str, prefix: str = "client", max_rows: int = MAX_ROWS
) -> DataFrame:
    """Mean, sample deviation (0 for one row) and z-score ``(x - mean) / (std + 1)`` per row.

    Aggregate and join back: a window over the key would run a hot key in one task.
    """
    stats = df.groupBy(*keys).agg(
        F.avg(value).alias(f"{prefix}_moyenne"),
        F.coalesce(F.stddev(value), F.lit(0.0)).alias(f"{prefix}_ecart_type"),
    )
    z = (F.col(value) - F.col(f"{prefix}_moyenne")) / (F.col(f"{prefix}_ecart_type") + 1)
    return spread_join(df, stats, keys, max_rows=max_rows).withColumn(f"{prefix}_z", z)


def decision_summary(df: DataFrame, decision: str) -> DataFrame:
    """Rows, frauds, rate and normals of scored rows."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(decision) == "FRAUDE").alias("fraudes"),
    ).select(
        "total", "fraudes",
        safe_div(F.col("fraudes").cast("double"), F.col("total")).alias("taux"),
        (F.col("total") - F.col("fraudes")).alias("normales"),
    )


def sanity_counts(df: DataFrame, key: str, amount: str, age: str) -> DataFrame:
    """Duplicate keys, amounts of 0 or less, ages outside 18-100."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(amount) <= 0).alias("a"),
        F.count_if((F.col(age) < 18) | (F.col(age) > 100)).alias("b"),
    )
    zero = F.lit(0)
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("doublons"),
        F.coalesce(F.sum("a"), zero).alias("montants_non_positifs"),
        F.coalesce(F.sum("b"), zero).alias("ages_hors_plage"),
    )
