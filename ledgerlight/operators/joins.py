"""Joins: enrichment, orphans, key lookups and range lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.ordered import latest_per_key, running_totals, spread_join
from ledgerlight.session import materialise


def enrich(facts: DataFrame, side: DataFrame, key: str, columns: Sequence[str], right_key: str | None = None) -> DataFrame:
    """Left join of some columns of ``side``; its key may have another name, and then is kept.

    No broadcast hint: Spark broadcasts a side it knows to be small, and AQE
    splits a hot key of ``facts`` in a sort-merge join.
    """
    right_key = right_key or key
    if right_key == key:
        return facts.join(side.select(key, *columns), key, "left")
    return facts.join(side.select(right_key, *columns), F.col(key) == F.col(right_key), "left")


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "inner")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose key, null included, is missing from ``dim``."""
    return fact.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


def orphan_count_outer(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Same count written as left join plus null filter, to cross-check ``orphans``; ``dim`` has unique keys."""
    known = dim.select(F.col(key).alias("_known"))
    return (
        fact.join(known, fact[key] == F.col("_known"), "left")
        .filter(F.col("_known").isNull())
        .agg(F.count(F.lit(1)).alias("orphelins"))
    )


def missing_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys absent from the parent."""
    return orphans(
        child.select(child_key).filter(F.col(child_key).isNotNull()).distinct(), parent, child_key, parent_key
    )


def missing_links(child: DataFrame, links: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """(lien, cle): distinct non-null keys of ``child`` absent from the parent of their link.

    ``links``: name to (key, parent, key of the parent).  The child is read once.
    """
    named = lambda name, key: [F.lit(name).alias("lien"), F.col(key).cast("string").alias("cle")]
    pairs = F.explode(F.array(*[F.struct(*named(name, link[0])) for name, link in links.items()])).alias("_p")
    keys = child.select(pairs).select("_p.*").filter(F.col("cle").isNotNull()).distinct()
    known = reduce(DataFrame.unionByName, [parent.select(*named(name, key)) for name, (_, parent, key) in links.items()])
    return keys.join(known, ["lien", "cle"], "left_anti")


def lookup(facts: DataFrame, key: str, table: DataFrame, table_key: str, value: str, default) -> DataFrame:
    """Value of ``table`` per key, with a default for unknown or null keys."""
    side = table.select(F.col(table_key).alias("_lk"), F.col(value).alias("_lv"))
    return (
        facts.join(side, F.col(key) == F.col("_lk"), "left")
        .withColumn(value, F.coalesce("_lv", F.lit(default)))
        .drop("_lk", "_lv")
    )


def range_lookup(col: Column | str, bands: Sequence[tuple], field: int) -> Column:
    """Field of the first row ``(low, high, ...)`` that holds the value; else of the first row.

    The table is a handful of constants, so it becomes a CASE expression and
    needs no join at all.
    """
    col = F.col(col) if isinstance(col, str) else col
    out = F
    for row in bands:
        out = out.when(col.between(row[0], row[1]), F.lit(row[field]))
    return out.otherwise(F.lit(bands[0][field]))


BLOCK = 64                   # entries of one array: a row that meets an array carries a copy of it
SMALL = 1_000_000            # bands and starts up to this number are broadcast


def band_join(
    facts: DataFrame, value: str, bands: DataFrame, low: str, high: str, columns: Sequence[str], block: int = BLOCK
) -> DataFrame:
    """Left join of the band that holds ``value``: the one with the greatest ``low`` at or below it, if its ``high`` reaches it.

    Bands come from a table and may have gaps; where they overlap, the later start wins, and of equal starts the greater
    ``high``.  Null values and values in a gap get nulls.  A null ``low`` is no band; a null ``high`` has no end.

    The bands are cut into sorted arrays of ``block``, the first starts of these into arrays of ``block`` again, and so on
    up to a single array.  A fact goes down from there: in each array it finds the next one by halving and meets it in an
    equi-join.  Up to ``SMALL`` entries a level is broadcast; above, hot arrays are.
    """
    if block < 2:
        raise ValueError("an array has two entries at least")
    carried = [f"_b_{c}" for c in columns]
    rows = bands.filter(F.col(low).isNotNull()).select(
        F.col(low).alias("low"), F.struct(F.col(high).isNull().alias("open"), F.col(high).alias("high"), *[F.col(c).alias(f"_b_{c}") for c in columns]).alias("own")
    )
    # One band per start; open ends sort last.
    rows = materialise(rows.groupBy("low").agg(F.max("own").alias("own")).select("low", "own.*"))
    n, at = rows.count(), F.col(value)
    # Places from counted ranks; bands are as many as distinct starts.
    level = running_totals(rows.withColumn("_all", F.lit(0)), ["_all"], ["low"], {"_n": F.lit(1)})
    level = level.withColumn("_n", F.col("_n") - 1)
    entry, levels = F.struct("low", "open", "high", *carried), []
    while True:
        node = F.floor(F.col("_n") / block).cast("long").alias("_node")
        arrays = materialise(level.groupBy(node).agg(F.sort_array(F.collect_list(entry)).alias("_bands")))
        levels.append((arrays, n))
        if n <= block:
            break
        level, n = arrays.select(F.col("_node").alias("_n"), F.col("_bands")[0]["low"].alias("low")), -(-n // block)
        entry = F.struct("low")

    index = _last_start("_bands", at, block)
    met = facts.withColumn("_node", F.lit(0).cast("long"))
    for depth, (arrays, entries) in reversed(list(enumerate(levels))):
        met = met.join(F.broadcast(arrays), "_node", "left") if entries <= SMALL else spread_join(materialise(met), arrays, ["_node"])
        if depth:
            place = F.col("_node") * block + index
            # A value below all starts is below the first one of the first array.
            met = met.withColumn("_node", F.when(place >= 0, place)).drop("_bands")
    own = F.get("_bands", index)
    inside = own["open"] | (at <= own["high"])
    met = met.withColumn("_own", F.when(inside, own))
    return met.select(*facts.columns, *[F.col("_own")[f"_b_{c}"].alias(c) for c in columns])


def _last_start(array: str, at: Column, longest: int) -> Column:
    """Index of the last element whose ``low`` is at or below ``at`` in a sorted array of at most ``longest``; -1: none."""
    steps = F.array(*[F.lit(1 << power) for power in reversed(range(longest.bit_length()))])
    below = lambda k, step: F.get(array, k + step - 1)["low"] <= at
    return F.aggregate(steps, F.lit(0), lambda k, step: k + F.when(below(k, step), step).otherwise(0)) - 1


def latest_join(facts: DataFrame, versions: DataFrame, key: str, newest: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join of the newest version per key, so the join never adds rows."""
    needed = list(dict.fromkeys([key, *newest, *columns]))
    newest_rows = latest_per_key(versions.select(*needed), [key], newest)
    return facts.join(newest_rows.select(key, *columns), key, "left")
