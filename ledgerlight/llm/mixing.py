"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.texts import WORD, beside, own_names
from ledgerlight.session import materialise

WEIGHTS = (5, 2, 1)          # by source in code-point order, repeating
SHARE = 1.5                  # words of the mix / words of all sources
MOST = 2                     # a source is repeated so often at most
BUCKET_ROWS = 10_000
SEED = "mix"
MADE = ("size", "source_size", "target", "taken")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Targets of a table (_null, _source, _words), one row per source.

    Shares go by weight; what a source cannot take (``most`` times its words) goes to the others by
    weight.  With sources ordered by limit / weight, those before a point are full and the rest
    share what is left, so two running sums give the fixed point.  One row per source is sorted
    here in one task: the rows are as many as there are sources, whatever the corpus.
    """
    by_code_point = Window.orderBy("_null", "_source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.expr(f"cast((_rank - 1) % {len(weights)} as int) + 1"))
    ranked = sources.withColumn("_rank", F.row_number().over(by_code_point)).withColumn("_weight", weight)
    limited = ranked.withColumn("_limit", F.lit(float(most)) * F.col("_words"))
    by_room = Window.orderBy(F.col("_limit") / F.col("_weight"), "_rank")
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = limited.withColumn(
        "_level",
        (F.lit(float(share)) * F.sum("_words").over(everything)
         - (F.sum("_limit").over(by_room.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_limit")))
        / F.sum("_weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)),
    ).withColumn("_place", F.row_number().over(by_room))
    level = level.withColumn("_open", F.col("_level") * F.col("_weight") < F.col("_limit"))
    common = F.min(F.when(F.col("_open"), F.struct("_place", "_level"))).over(everything)["_level"]
    return level.withColumn("_common", common).select(
        "_null", "_source", "_words",
        F.round(F.when(F.col("_open"), F.col("_common") * F.col("_weight")).otherwise(F.col("_limit")), 6).alias("_target"),
    )


@own_names("id_col", "text", "source")
def mix_sources(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
    id_col: str = "doc_id", text: str = "text", source: str = "source", bucket_rows: int = BUCKET_ROWS, seed: str = SEED,
) -> DataFrame:
    """All columns, and size, source_size, target, taken (a column of such a name is replaced).

    A source's documents are ordered by a hash of their id and text; whole epochs are taken first, then
    documents in that order up to the exact word; the document at the cut gives a part of its
    words.  Null texts have no words, a null source is a source of its own, sorted last.  Rows that
    repeat an id are documents of their own, and only rows equal in id and text share a hash.  Sources without words have target 0.

    Hash keys are uniform, so equal ranges of them split any source evenly: ``bucket_rows`` rows to a
    bucket, in the largest source.  Sums per bucket, running sums over the buckets of a source, then
    running sums inside each bucket replace a sort of a whole source.
    """
    others = [F.col(f"`{c}`") for c in beside(docs, MADE)]
    words = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.md5(words.cast("binary"))).cast("binary"), 256)
    size = F.regexp_count(words, F.lit(WORD)).cast("long")
    of_source = F.col(f"`{source}`").cast("string")
    keyed = lambda *more: docs.select(
        *more, of_source.isNull().alias("_null"), F.coalesce(of_source, F.lit("")).alias("_source"),
        size.alias("size"), F.substring(key, 1, 16).alias("_key"),
    )
    narrow = materialise(keyed())
    most_rows = narrow.groupBy("_null", "_source").count().agg(F.max("count")).head()[0] or 0
    buckets = max(1, -(-most_rows // bucket_rows))
    bucket = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * F.lit(buckets)).alias("_bucket")

    per_bucket = narrow.select("_null", "_source", "size", bucket).groupBy("_null", "_source", "_bucket").agg(
        F.sum("size").alias("_bucket_words")
    )
    targets = source_targets(
        per_bucket.groupBy("_null", "_source").agg(F.sum("_bucket_words").alias("_words")), weights, share, most
    )
    earlier = Window.partitionBy("_null", "_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_bucket.withColumn(
        "_offset", F.sum("_bucket_words").over(earlier) - F.col("_bucket_words")
    ).join(targets, ["_null", "_source"])
    offsets = materialise(offsets)

    inside = Window.partitionBy("_null", "_source", "_bucket").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed(*others).select("*", bucket).withColumn("_before", F.sum("size").over(inside) - F.col("size"))
    budget = F.round("_target").cast("long")
    epochs = F.when(F.col("_words") > 0, F.floor(budget / F.col("_words"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("_words") - F.col("_offset") - F.col("_before")
    return placed.join(offsets, ["_null", "_source", "_bucket"]).select(
        *others, "size", F.col("_words").alias("source_size"), F.col("_target").alias("target"),
        (epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))).alias("taken"),
    )


SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         substr(sha256('mix:' || doc_id || ':' || md5(coalesce(text, ''))), 1, 16) as k
  from documents
), s as (
  select source, sum(size) as words, [5.0, 2.0, 1.0][cast((row_number() over (order by source nulls last) - 1) % 3 as int) + 1]::double as w,
         row_number() over (order by source nulls last) as rk
  from d group by source
), l as (select *, 2.0::double * words as lim from s),
p as (
  select *, (1.5::double * sum(words) over () - (sum(lim) over (order by lim / w, rk rows between unbounded preceding and current row) - lim))
         / sum(w) over (order by lim / w, rk rows between current row and unbounded following) as lev,
         row_number() over (order by lim / w, rk) as place
  from l
), c as (select min_by(lev, place) as com from p where lev * w < lim),
t as (
  select source, cast(words as bigint) as words, round(case when lev * w < lim then com * w else lim end, 6) as target
  from p left join c on true
), r as (
  select d.doc_id, d.size, t.words, t.target, cast(round(t.target) as bigint) as budget,
         sum(d.size) over (partition by d.source order by d.k, d.size rows between unbounded preceding and current row) - d.size as before
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, words as source_size, target,
       cast(case when words > 0 then (budget // words) * size + greatest(0, least(size, budget - (budget // words) * words - before)) else 0 end as bigint) as taken
from r
"""
