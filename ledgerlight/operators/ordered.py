"""Ordered windows that survive a key holding a large share of all rows.

Spark runs one window partition in one task, and AQE does not split it.  Here
a group larger than ``max_rows`` is cut into segments at sampled positions of
its own order, each segment is windowed alone, and what a segment needs from
the earlier ones is handed over:

* running sums: the total of the earlier segments of the key,
* frames over the previous ``n`` rows: a copy of the last ``n`` rows of the
  segment before it.

The cut points depend only on row values, so a recomputed task assigns the
same segments.  Groups below the limit keep one segment, and when no group is
above it the plan is the plain window: one exchange and one sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.session import materialise

MAX_ROWS = 1_000_000      # rows one window task takes
MAX_SEGMENTS = 200_000    # bounds the small tables that are broadcast
SIZE_SAMPLE = 20_000      # sampled rows that make a group count as large
SEG, COPY, CUTS, BLOCK, NEAR = "_segment", "_copied", "_cuts", "_block", "_near"


@dataclass
class Segmented:
    """``frame`` with a segment number per row; the table of cut groups.

    Where groups were cut, rows of cut groups have a block, and those of a segment with a successor the
    sampled point ``NEAR`` its end.
    """

    frame: DataFrame
    keys: list[str]
    cuts: DataFrame | None   # None: no group was cut


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality, because a window also groups null keys."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _renamed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_k_{c}" for c in cols})


def match_small(df: DataFrame, small: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Join a table of at most ``2 * MAX_SEGMENTS`` rows to ``df``, null-safe."""
    side = F.broadcast(_renamed(small, cols))
    on = same_keys(df, side, [(c, f"_k_{c}") for c in cols])
    return df.join(side, on, how).drop(*[f"_k_{c}" for c in cols])


def hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int) -> tuple[DataFrame | None, int]:
    """Keys of the groups above the limit, as a written table, and the limit.

    Sizes are estimated from a row sample, so the pass reads the key columns
    but shuffles next to nothing; a group at the limit has ``SIZE_SAMPLE``
    sampled rows.  Results never depend on the estimate, only the balance of
    the tasks does.  At most ``MAX_SEGMENTS`` keys come back.
    """
    rows, share = df.select(*keys), min(1.0, SIZE_SAMPLE / max_rows)
    if share < 1:
        rows = rows.sample(share, seed=7)
    sizes = rows.groupBy(*keys).agg((F.count(F.lit(1)) / share).alias("_n"))
    top, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
    if top is None or top <= max_rows:
        return None, max_rows
    limit = max(max_rows, int(total // MAX_SEGMENTS) + 1)
    return materialise(sizes.filter(F.col("_n") > limit).select(*keys)), limit


def spread_join(
    facts: DataFrame, side: DataFrame, keys: Sequence[str], null_safe: bool = False, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Left join of a side that has one row per key, safe against hot keys of ``facts``.

    AQE splits a hot key only when both inputs come straight from a shuffle,
    not when the side is an aggregate.  Here the few hot keys take their side
    rows by broadcast (at most one row per hot key) and never meet in one
    task; all other keys join by shuffle.
    """
    keys = list(keys)

    def joined(rows: DataFrame, other: DataFrame) -> DataFrame:
        if not null_safe:
            return rows.join(other, keys, "left")
        other = _renamed(other, keys)
        return rows.join(other, same_keys(rows, other, [(c, f"_k_{c}") for c in keys]), "left").drop(
            *[f"_k_{c}" for c in keys]
        )

    hot, _ = hot_groups(facts, keys, max_rows)
    if hot is None:
        return joined(facts, side)
    flagged = match_small(facts, hot.withColumn("_hot", F.lit(True)), keys, "left")
    cold = flagged.filter(F.col("_hot").isNull()).drop("_hot")
    warm = flagged.filter(F.col("_hot").isNotNull()).drop("_hot")
    return joined(cold, side).unionByName(joined(warm, F.broadcast(match_small(side, hot, keys, "left_semi"))))


def cut_hot_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS, previous: int = 0
) -> Segmented:
    """Number the segments of every group; only groups above ``max_rows`` have several.

    ``order`` must be unique within a group.  Cuts are every ``per_segment``-th
    row of a sample taken by hash, so every segment but the last holds at least
    that many rows.  A row finds its segment by two binary searches in arrays
    of about the square root of its key's cuts.  The numbered rows are written
    once, because tails, totals and the windows all read them.
    """
    keys, order = list(keys), list(order)
    hot, limit = hot_groups(df, keys, max_rows)
    if hot is None:
        return Segmented(df.withColumn(SEG, F.lit(0)), keys, None)

    per_segment = max(64, 8 * previous)
    stride = max(1, limit // per_segment)
    position = F.struct(*order)
    sample = match_small(
        df.select(*dict.fromkeys(keys + order)).filter(F.pmod(F.xxhash64(*order), F.lit(stride)) == 0),
        hot, keys, "left_semi",
    )
    in_group = Window.partitionBy(*keys).orderBy(*order)
    points = (
        sample.select(*keys, position.alias("at"), *order)
        .withColumns({"_rn": F.row_number().over(in_group), "near": F.lag("at", previous).over(in_group)})
        .filter(F.col("_rn") % per_segment == 0)
    )
    cuts = materialise(
        points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "near"))).alias(CUTS))
    )
    longest = cuts.agg(F.max(F.size(CUTS))).first()[0]
    if longest is None:
        return Segmented(df.withColumn(SEG, F.lit(0)), keys, None)
    # All cuts of a key would be copied into every row: first the block of cuts, then the cut inside of it.
    width = math.isqrt(longest) + 1
    ends = F.transform(F.filter(CUTS, lambda _, i: (i + 1) % width == 0), lambda cut: F.struct(cut["at"].alias("at")))
    blocks = cuts.select(*keys, ends.alias(CUTS))
    last = F.floor((F.size(CUTS) - 1) / width).cast("int")
    inside = cuts.withColumn(BLOCK, F.explode(F.sequence(F.lit(0), last))).withColumn(
        CUTS, F.slice(CUTS, F.col(BLOCK) * width + 1, width)
    )
    placed = match_small(df, blocks, keys, "left")
    block = F.when(F.col(CUTS).isNotNull(), passed_cuts(position, width))
    placed = match_small(placed.withColumn(BLOCK, block).drop(CUTS), inside, [*keys, BLOCK], "left")
    placed = placed.withColumn("_in", passed_cuts(position, width)).withColumns(
        {SEG: F.coalesce(F.col(BLOCK) * width + F.col("_in"), F.lit(0)), NEAR: F.get(CUTS, F.col("_in"))["near"]}
    )
    return Segmented(materialise(placed.drop(CUTS, "_in")), keys, cuts)


def passed_cuts(position: Column, most: int) -> Column:
    """How many of the at most ``most`` rising cuts of a row lie below its position."""
    steps = F.array(*[F.lit(1 << power) for power in reversed(range(most.bit_length()))])
    below = lambda at, step: F.get(CUTS, at + step - 1)["at"] < position
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(below(at, step), step).otherwise(0))


def segment_tails(cut: Segmented, order: Sequence[str], previous: int) -> DataFrame:
    """The last ``previous`` rows of every segment that has a successor.

    Only rows behind the sampled point ``near`` the end can be among them, so
    the rest is dropped before the sort.
    """
    near_end = cut.frame.filter(F.col(NEAR).isNotNull() & (F.struct(*order) > F.col(NEAR))).drop(BLOCK, NEAR)
    last_first = Window.partitionBy(*cut.keys, SEG).orderBy(*[F.col(c).desc() for c in order])
    return near_end.withColumn("_rn", F.row_number().over(last_first)).filter(F.col("_rn") <= previous).drop("_rn")


def ordered_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: int = 0,
    frame: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add window columns per ``keys`` in the total order ``order``.

    ``frame``: aggregates over the ``previous`` rows before the current one.
    ``running``: sums from the first row of the group to the current one.
    """
    frame, running = frame or {}, running or {}
    # Values are fixed on the rows first, so the copied rows carry the same ones.
    values = {f"_v_{n}": v for n, v in running.items()}
    cut = cut_hot_groups(df, keys, order, max_rows, previous)
    if cut.cuts is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        before = w.rowsBetween(-previous, -1) if previous else None
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns(
            {
                **{n: agg.over(before) for n, agg in frame.items()},
                **{n: F.sum(v).over(upto) for n, v in running.items()},
            }
        )

    cut.frame = cut.frame.withColumns(values).withColumn(COPY, F.lit(False))
    rows = cut.frame.drop(BLOCK, NEAR)
    hot_rows = cut.frame.filter(F.col(BLOCK).isNotNull())
    in_segment = [*cut.keys, SEG]

    both = rows
    if frame:
        tails = segment_tails(cut, order, previous)
        both = rows.unionByName(tails.withColumns({SEG: F.col(SEG) + 1, COPY: F.lit(True)}))
    w = Window.partitionBy(*in_segment).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumns(
        {
            **{n: agg.over(w.rowsBetween(-previous, -1)) for n, agg in frame.items()},
            **{n: F.sum(F.when(~F.col(COPY), F.col(f"_v_{n}"))).over(upto) for n in running},
        }
    ).filter(~F.col(COPY))

    if running:
        # At most one row per segment, so at most 2 * MAX_SEGMENTS rows.
        earlier = Window.partitionBy(*cut.keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        totals = hot_rows.groupBy(*in_segment).agg(
            *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in running]
        )
        carried = totals.withColumns(
            {f"_o_{n}": F.sum(f"_t_{n}").over(earlier) for n in running}
        ).drop(*[f"_t_{n}" for n in running])
        out = match_small(out, carried, in_segment, "left").withColumns(
            {
                n: F.when(F.col(f"_o_{n}").isNull(), F.col(n)).otherwise(
                    F.coalesce(F.col(n), F.lit(0)) + F.col(f"_o_{n}")
                )
                for n in running
            }
        ).drop(*[f"_o_{n}" for n in running])
    return out.drop(SEG, COPY, *values)


def time_features(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], days: float, frame: dict[str, Column],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Aggregates over the rows of the ``days`` before the current one's time; rows of the same time do not count.

    ``order`` is a total order that begins with ``time``.  A cut group hands every segment the rows of
    earlier segments that lie within ``days`` of its first row, so segments are windowed alone.  Rows of a null time
    see each other only, as in SQL.  A group is cut by its rows, whatever its span: where many segments lie within
    ``days``, a row is copied to each of them.
    """
    keys, order, at, span = list(keys), list(order), "_at", int(days * 86_400_000_000)
    timed = df.withColumn(at, F.unix_micros(F.col(time).cast("timestamp")))
    windowed = lambda rows, by: rows.withColumns(
        {n: agg.over(Window.partitionBy(*by).orderBy(at).rangeBetween(-span, -1)) for n, agg in frame.items()}
    )
    cut = cut_hot_groups(timed, keys, order, max_rows)
    if cut.cuts is None:
        return windowed(timed, keys).drop(at)
    rows, by = cut.frame.drop(BLOCK, NEAR), [*keys, SEG]
    hot = cut.frame.filter(F.col(BLOCK).isNotNull() & F.col(at).isNotNull()).drop(BLOCK, NEAR)
    # At most 2 * MAX_SEGMENTS rows.  The last segment that begins within ``days`` of a segment's end:
    bounds = materialise(hot.groupBy(*by).agg(F.min(at).alias("_first"), F.max(at).alias("_last")))
    starts = bounds.select(*keys, SEG, F.col("_first").alias("_p"), F.lit(0).alias("_kind"))
    ends = bounds.select(*keys, SEG, (F.col("_last") + span).alias("_p"), F.lit(1).alias("_kind"))
    begun = Window.partitionBy(*keys).orderBy("_p", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = (
        starts.unionByName(ends).withColumn("_reach", F.max(F.when(F.col("_kind") == 0, F.col(SEG))).over(begun))
        .filter((F.col("_kind") == 1) & (F.col("_reach") > F.col(SEG))).select(*by, "_reach")
    )
    later = F.explode(F.sequence(F.col(SEG) + 1, F.col("_reach")))
    copies = match_small(hot, reach, by, "inner").withColumn(SEG, later).drop("_reach")
    copies = match_small(copies, bounds.select(*by, "_first"), by, "inner").filter(F.col(at) >= F.col("_first") - span)
    both = rows.withColumn(COPY, F.lit(False)).unionByName(copies.drop("_first").withColumn(COPY, F.lit(True)))
    return windowed(both, by).filter(~F.col(COPY)).drop(COPY, SEG, at)


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column], max_rows: int = MAX_ROWS
) -> DataFrame:
    """Cumulative sums per group, current row included."""
    return ordered_features(df, keys, order, running=sums, max_rows=max_rows)


def lagged(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str],
           max_rows: int = MAX_ROWS) -> DataFrame:
    """Value of the row before, per group; null on the first row."""
    frame = {new: F.max(old) for new, old in cols.items()}
    return ordered_features(df, keys, order, previous=1, frame=frame, max_rows=max_rows)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``newest``.

    An aggregate with map-side combine: a hot key sends one row per map task,
    where a window would send them all to one.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], oldest: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``oldest`` (same plan as ``latest_per_key``)."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*oldest)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def latest_n(df: DataFrame, keys: Sequence[str], newest: Sequence[str], n: int) -> DataFrame:
    """The ``n`` greatest rows per key; Spark limits each map task to ``n`` per key first."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest])
    return df.withColumn("rang", F.row_number().over(w)).filter(F.col("rang") <= n)
