"""Exact deduplication in three stages of aggregates, full content compared in each.

Copies collapse inside each task (map-side combine), then per (digest, salt), then the winners of
the salts meet.  The digest only decides where rows go: the content is a grouping key throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.texts import SPACES, beside, own_names
from ledgerlight.session import materialise

SALTS = 32
MADE = ("keep_id", "group_size", "kept", "text_sha256")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


@own_names("id_col", "text")
def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256_hex,
) -> DataFrame:
    """All columns, and keep_id, group_size, kept, text_sha256 (a column of such a name is replaced).

    Texts are equal when identical after each run of white space becomes one space; null counts as
    empty.  The smallest id of a group stays.  Rows that repeat an id within a group share its
    decision; null ids lose against any other, and a group of null ids alone keeps them all.
    An empty table gives no rows.  ``digest`` may collide: contents of one digest are told apart.
    """
    content = F.regexp_replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), SPACES, " ")
    others = [F.col(f"`{c}`") for c in beside(docs, MADE)]
    ids = F.col(f"`{id_col}`")
    salt = F.pmod(F.xxhash64(ids), F.lit(salts))
    rows = docs.select(ids.alias("_id"), content.alias("_content")).withColumn("_digest", digest(F.col("_content")))
    salted = rows.groupBy("_digest", salt_of("_id", salts), "_content").agg(
        F.min("_id").alias("_keep"), F.count("*").alias("_n")
    )
    winners = salted.repartition("_digest").groupBy("_digest", "_content").agg(
        F.min("_keep").alias("_keep"), F.sum("_n").alias("_n")
    )
    # One row per digest; where it stands for several contents, they are told apart below.
    per_digest = materialise(
        winners.groupBy("_digest").agg(
            F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"), F.count("*").alias("_contents")
        ).where("_n > 1")
    )
    full = docs.select(*others, content.alias("_content"), salt.alias("_salt")).withColumn(
        "_digest", digest(F.col("_content"))
    ).withColumn("_sha", sha256_hex(F.col("_content")))      # before the join: the content stays behind
    shared = per_digest.where("_contents > 1").select("_digest")
    if shared.isEmpty():
        # A hot group is met in ``salts`` parts; its one row is repeated for each.
        side = per_digest.select("_digest", "_keep", "_n", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
        found = full.join(side.withColumn("_salt", F.col("_salt").cast("long")), ["_digest", "_salt"], "left")
    else:
        side = winners.where("_n > 1").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>"))
        )
        found = full.join(side, ["_digest", "_salt", "_content"], "left")
    keep = F.when(F.col("_n").isNull(), ids).otherwise(F.col("_keep"))
    return found.select(
        *others,
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1).cast("long")).alias("group_size"),
        ids.eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def salt_of(column: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(salts)).alias("_salt")


SQL = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as content from documents
), g as (select content, min(doc_id) as keep_id, count(*) as group_size from t group by content)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.content) as text_sha256
from t join g on t.content = g.content
"""
