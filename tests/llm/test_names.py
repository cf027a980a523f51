"""Columns of the input whose names clash with helper or result columns."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import exact, leaks, mixing, near, personal, secrets
from ledgerlight.llm.texts import own_names, text_results

HELPERS = (
    "rep", "_key", "_bucket", "_null", "_words", "_source", "_n", "_keep", "_content", "_digest", "_salt", "_sha", "_id", "_text", "_fixed",
    "_loose", "_text_in", "size", "component", "_before", "_offset", "_target", "_high", "_low", "_bands", "in0_", "in3_", "Task",
)
ROWS = [
    (1, "one two three four five six seven eight nine ten", "a"), (2, "one two  three four five six seven eight nine ten", "a"),
    (3, "write to me@x.org or +1 234 567 8901", "b"), (4, None, None), (5, "", "b"), (None, "api_key = abcdefgh1234", "a"), (3, "password: zzzzzzzz9", None),
]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


OPERATORS = {
    "near": (near.near_duplicates, near.MADE), "exact": (exact.exact_duplicates, exact.MADE), "mixing": (mixing.mix_sources, mixing.MADE),
    "personal": (personal.personal_spans, personal.MADE), "secrets": (secrets.secret_spans, [f.name for f in secrets.FIELDS]),
    "leaks": (lambda d: leaks.benchmark_hits(d, d.select(F.lit(1).alias("item_id"), "text").where("doc_id = 1")), [f.name for f in leaks.FIELDS]),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_clashing_names(plain, name):
    operator, made = OPERATORS[name]
    extra = [h for h in HELPERS if h not in made]
    full = plain.withColumns({h: F.lit(f"own {h}") for h in extra} | {m: F.lit("replaced") for m in made})
    key = lambda r: repr([r["doc_id"], *[r[m] for m in made]])
    got = operator(full)
    rows = got.collect()
    assert set(got.columns) == {"doc_id", "text", "source", *extra, *made} and len(got.columns) == len(set(got.columns))
    assert all(r[h] == f"own {h}" for r in rows for h in extra)
    assert sorted(map(key, rows)) == sorted(map(key, operator(plain).collect()))


def test_columns_under_other_names(spark, plain):
    renamed = plain.withColumnsRenamed({"doc_id": "rep", "text": "_content", "source": "_key"})
    got = exact.exact_duplicates(renamed, "rep", "_content")
    assert sorted((r["keep_id"] or 0, r["group_size"]) for r in got.collect()) == sorted((r["keep_id"] or 0, r["group_size"]) for r in exact.exact_duplicates(plain).collect())
    assert mixing.mix_sources(renamed, id_col="rep", text="_content", source="_key").columns[:3] == ["rep", "_content", "_key"]


def test_carried_columns_keep_their_names(plain):
    @own_names("text")
    def lengths(docs, text="text", carry=None):
        return text_results(docs, [T.StructField("n", T.LongType())], lambda: lambda c: [[len(t or "") for t in c.to_pylist()]], text, carry)

    df = plain.withColumn("_text_in", F.lit(1)).withColumn("N", F.lit(2)).withColumn("a.b", F.lit(3))
    assert lengths(df).columns == ["doc_id", "text", "source", "_text_in", "a.b", "n"]
    assert lengths(df, carry=["a.b", "doc_id"]).columns == ["a.b", "doc_id", "n"]
    assert sorted(r["n"] for r in lengths(df, "TEXT").collect()) == sorted(len(t or "") for _, t, _ in ROWS)
