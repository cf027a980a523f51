"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.profile import key_uniqueness

OK, TO_CHECK = "OK", "À investiguer"


def uniqueness_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: rows, distinct keys, duplicates, verdict."""
    parts = [
        key_uniqueness(df, key).select(
            F.lit(name).alias("table_name"), F.lit(key).alias("cle"), "lignes", "distincts", "doublons"
        )
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "statut", F.when(F.col("doublons") == 0, OK).otherwise(TO_CHECK)
    )


def integrity_of(fact_name: str, fact: DataFrame, links: Sequence[tuple]) -> DataFrame:
    """Total, orphans and allowed nulls of each foreign key of one fact.

    ``links``: (key, name of the dimension, dimension, its key, nulls allowed).  The fact is read once and
    reduced to counts per link and key, so its rows never meet a dimension and a hot key is one row.
    """
    named = lambda i, key: [F.lit(i).alias("_link"), F.col(key).cast("string").alias("_key")]
    pairs = F.explode(F.array(*[F.struct(*named(i, link[0])) for i, link in enumerate(links)])).alias("_p")
    per_key = fact.select(pairs).groupBy("_p._link", "_p._key").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionByName, [dim.select(*named(i, key)) for i, (_, _, dim, key, _) in enumerate(links)])
    rows = per_key.join(known.distinct().withColumn("_known", F.lit(True)), ["_link", "_key"], "left")
    missing, empty = F.col("_known").isNull(), F.col("_key").isNull()
    count = lambda rule: F.coalesce(F.sum(F.when(rule, F.col("n"))), F.lit(0))
    sums, out = [], []
    for i, (key, dim_name, _, _, nulls_allowed) in enumerate(links):
        mine = F.col("_link") == i
        sums += [
            count(mine).alias(f"t{i}"), count(mine & missing & ~(empty & F.lit(nulls_allowed))).alias(f"o{i}"),
            count(mine & empty & F.lit(nulls_allowed)).alias(f"e{i}"),
        ]
        out.append(
            F.struct(
                F.lit(fact_name).alias("fait"), F.lit(dim_name).alias("dimension"), F.lit(key).alias("cle"),
                F.col(f"t{i}").alias("total"), F.col(f"o{i}").alias("orphelins"), F.col(f"e{i}").alias("nuls_admis"),
                F.when(F.col(f"o{i}") == 0, OK).otherwise(TO_CHECK).alias("statut"),
            )
        )
    return rows.agg(*sums).select(F.inline(F.array(*out)))


def integrity_check(
    fact_name: str, fact: DataFrame, dim_name: str, dim: DataFrame, key: str, dim_key: str | None = None,
    nulls_allowed: bool = False,
) -> DataFrame:
    """``integrity_of`` for one foreign key."""
    return integrity_of(fact_name, fact, [(key, dim_name, dim, dim_key or key, nulls_allowed)])


def integrity_report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (a rule that is unknown is not broken), one pass."""
    one = df.agg(*[F.count_if(~r).alias(n) for n, r in rules.items()])
    rows = [
        F.struct(
            F.lit(n).alias("regle"), F.col(n).alias("violations"),
            F.when(F.col(n) == 0, OK).otherwise(TO_CHECK).alias("statut"),
        )
        for n in rules
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def label_rate(df: DataFrame, label: str, target: float) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("taux")).select(
        "taux", F.lit(target).alias("cible"), (F.col("taux") - target).alias("ecart")
    )


def unknown_codes(df: DataFrame, encoded: list[str]) -> DataFrame:
    """Values the encoder had not seen (code -1), per column: a drift signal."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c) == -1).alias(c) for c in encoded])
    rows = [
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("inconnues"), F.col("_n").alias("total")) for c in encoded
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def require_encoder_match(encoded: list[str], features: list[str]) -> None:
    lost = sorted(set(encoded) - set(features))
    if lost:
        raise ValueError(f"encoder columns unknown to the model: {lost}")
