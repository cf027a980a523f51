"""Whitening, ranked search and SimHash against plain restatements, with every odd case."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlight.llm import ranked, simhash, whitening
from tests.llm import brute

VECTORS = "vec_id long, embedding array<float>, label int"


# 11 whitening ---------------------------------------------------------------------------------------------------

def test_pivoted_cholesky_and_jacobi():
    rng = np.random.default_rng(1)
    for rank, size in ((1, 1), (3, 3), (4, 9), (16, 16)):
        base = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-3, 4, rank)
        a = base @ base.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (size, rank) and np.allclose(factor @ factor.T, a, rtol=1e-10, atol=1e-12 * a.max())
        order = [int(np.flatnonzero(factor[:, k])[np.argmax(np.abs(factor[np.flatnonzero(factor[:, k]), k]))]) for k in range(rank)]
        assert len(set(order)) == rank or rank < size    # every pivot has its own row
        vectors, values = whitening.one_sided_jacobi(factor)
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
        assert np.allclose((vectors * values) @ vectors.T, a, rtol=1e-9, atol=1e-11 * a.max())
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-11 * a.max()) and (np.diff(values) <= 0).all()
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    assert whitening.one_sided_jacobi(np.zeros((3, 0)))[1].shape == (0,)


def vectors(n=300, size=12, seed=5):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) * 0.3 + rng.normal(size=size)
    mixed[:, 3] = 0.25                                     # a constant dimension
    return mixed.astype(np.float32)


def test_whitening_equals_numpy(spark):
    all_rows = [(k, [float(c) for c in v], k % 3) for k, v in enumerate(vectors())]
    odd = [(900, None, 1), (901, [], 1), (902, [1.0] * 11 + [float("nan")], 1), (903, [1.0] * 11 + [float("inf")], 1),
           (904, [None] + [1.0] * 11, 1), (905, [1e30] * 12, 1), (906, [0.5] * 5, 1)]
    all_rows += [(None, all_rows[0][1], 7), (5, all_rows[5][1], None)]     # null id, repeated row
    df = spark.createDataFrame(all_rows + odd, VECTORS).repartition(5).withColumn("component", F.lit("old")).withColumn("row", F.lit(1)).withColumn("w", F.lit(2))
    got = whitening.whiten(df).toPandas()
    assert set(got.columns) == {"vec_id", "label", "row", "w", *whitening.MADE}
    x = np.floor(1024 * np.array([r[1] for r in all_rows], np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = x - s / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1][:8], basis[:, ::-1][:, :8]
    assert len(got) == 8 * n and (got.n == n).all() and sorted(got.component.unique()) == list(range(1, 9))
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    trace = np.square(y).sum() / n
    for c in range(8):
        own = got[got.component == c + 1]
        assert np.allclose(own.explained, values[c] / trace, rtol=1e-9)
        want = y @ basis[:, c] / math.sqrt(values[c])
        of = {r[0]: want[k] for k, r in enumerate(all_rows) if r[0] is not None}
        named = own[own.vec_id.notna()]
        found, there = named.whitened.to_numpy(), np.array([of[int(i)] for i in named.vec_id])
        assert np.allclose(found, there, atol=1e-9) or np.allclose(found, -there, atol=1e-9)
    deviation = {r[0]: int(((n * x[k] - s) ** 2).sum()) for k, r in enumerate(all_rows) if r[0] is not None}
    assert all(deviation[int(i)] == d for i, d in zip(got.vec_id, got.deviation) if not math.isnan(i))


def test_whitening_of_great_offsets_and_overflow(spark):
    big = float(1 << 40)
    rows = [(k, [big + 16.0 * (k % 7), float(k), big]) for k in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).toPandas()
    assert sorted(got.component.unique()) == [1, 2] and got.identity_error.iloc[0] < 1e-9
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert {r.vec_id: r.deviation for r in got.itertuples()} == {k: sum((40 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for k, v in enumerate(x)}
    far = spark.createDataFrame([(1, [big, 0.0]), (2, [-big, 1.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(far).where("deviation is null").count() == 2 and whitening.whiten(far).count() == 2


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)]):
        got = whitening.whiten(spark.createDataFrame(rows, VECTORS))
        assert got.columns == ["vec_id", "label", *whitening.MADE] and got.count() == 0


# 12 ranked search -----------------------------------------------------------------------------------------------

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected_ranks(docs, items, top):
    split = lambda t: TERMS.findall((t or "").translate(brute.LOWER))
    bags = [(i, collections.Counter(split(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, words = sum(1 for s in sizes if s), sum(sizes)
    df = collections.Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, collections.Counter()).update(split(t))
    out = set()
    for item, bag in asked.items():
        found = []
        for (i, b), size in zip(bags, sizes, strict=True):
            if size:
                m = 75 + (25 * size * n) // words
                total = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t, c in bag.items() if b[t])
                if total > 0:
                    found.append((-total, i is None, i or 0, i))
        out |= {(item, rank, i, -minus) for rank, (minus, _, _, i) in enumerate(sorted(found)[:top], 1)}
    return out


def text(rng, n):
    return rng.choice([" ", ", ", "\n"]).join(rng.choice(["Kind", "été", "x1", "zoo", "lamp", "漢字", "b"]) + rng.choice(["", "a", "B", "c7", "dd", str(rng.randrange(40))]) for _ in range(n))


def search_rows():
    rng = random.Random(3)
    docs = [(k, text(rng, rng.choice([1, 5, 30, 200]))) for k in range(300)]
    docs += [(300 + k, docs[7][1]) for k in range(40)]                                    # ties
    docs += [(400, None), (401, ""), (402, "-- !!"), (403, text(rng, 30_000)), (404, "y" * 60_000 + " lampdd"), (None, docs[7][1]), (5, docs[9][1]), (5, docs[5][1])]
    items = [(k, text(rng, rng.choice([1, 8, 40]))) for k in range(25)]
    items += [(30, docs[7][1]), (31, None), (32, ""), (33, "nowhere"), (None, docs[5][1]), (34, docs[7][1] + " " + docs[7][1]), (0, text(rng, 5)), (35, "y" * 60_000)]
    return docs, items


@pytest.mark.parametrize("items_at_a_time", [256, 6])
def test_ranked_search_equals_all_scores(spark, monkeypatch, items_at_a_time):
    monkeypatch.setattr(ranked, "ITEMS", items_at_a_time)
    docs, items = search_rows()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumns({c: F.lit("x") for c in ("id", "item", "bound", "score", "ids", "items")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("item", "term", "times", "doc_id")})
    got = [tuple(r) for r in ranked.ranked_search(d, q).select("item_id", "rank", "doc_id", "score").collect()]
    want = expected_ranks(docs, items, ranked.TOP)
    assert len(got) == len(set(got)) == len(want) and set(got) == want


def test_bounds_are_never_below_scores_and_prune(spark):
    docs, items = search_rows()
    d = spark.createDataFrame([r for r in docs if r[0] is not None], "id long, text string")
    asked = ranked.item_terms(spark.createDataFrame(items, "item_id long, text string")).collect()
    terms = sorted({r["term"] for r in asked if r["item"] == 30})
    of = ranked.collection(d, terms)
    weights = of.weights()
    batch = ranked.Batch(terms, [(np.arange(len(terms)), weights)], of)
    index = ranked.build_index(d)
    every = d.select(F.lit(0).alias("item"), "id")
    exact = {(r["id"], r["score"]) for r in ranked.score(d, every, batch, 10**6).collect()}
    bounds = ranked._bounds(index, batch, lambda found: (ranked._rows(np.full(len(i), n), i, k, b) for i, k, n, b in found), "item int, id long, bound double")
    best = {}
    for r in bounds.collect():
        best.setdefault(r["id"], []).append(r["bound"])
    assert all(max(best[i]) >= s for i, s in exact)
    last = sorted((-s, i) for i, s in exact)[19]
    left = ranked.open_documents(index, batch, {0: (-last[0], last[1])}).count()
    assert 20 <= left < len(exact) / 4            # provably excluded: most of those with a score
    assert ranked.open_documents(index, batch, {}).count() >= len(exact)


def test_hash_hits_are_compared_byte_by_byte():
    words = ranked.Vocabulary(["alpha", "beta", "été"])
    for _, w in ranked._terms(pa.array(["Alpha beta ÉTÉ été", None, "BETA betas"])):
        text_no, term = words.find(w)
        assert list(zip(text_no.tolist(), term.tolist(), strict=True)) == [(0, 0), (0, 1), (0, 2), (2, 1)]
        words.data = words.data.copy()
        words.data[0] = ord("b")                   # the hash still says alpha
        assert 0 not in words.find(w)[1].tolist()


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")
    full = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([("i", "b c")], "item_id string, text string")
    assert ranked.ranked_search(docs, full[1]).count() == 0 and ranked.ranked_search(full[0], items).count() == 0
    assert ranked.ranked_search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_sql_agrees(spark):
    rng = random.Random(9)
    docs, items = [(k, text(rng, 40)) for k in range(60)], [(k, text(rng, 12)) for k in range(9)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    assert set(con.execute(ranked.SQL).fetchall()) == expected_ranks(docs, items, 20)


# 13 simhash -----------------------------------------------------------------------------------------------------

def plain_fingerprint(t):
    w = brute.words(t)
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected_components(rows):
    """rows: (id, fingerprint); repeated ids are one node, null ids are left out."""
    rows = [r for r in rows if r[0] is not None]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, f in rows:
        for b, g in rows:
            if (f ^ g).bit_count() <= 2:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def test_simhash_of_texts(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["Alpha", "beta", "été", "漢字", "x"]) + str(rng.randrange(30))
    long = " ".join(word() for _ in range(9_000))
    texts = [None, "", " \t\n ", "one", "ONE", "one two", "One\n TWO  three", long, long + " tail", long.replace(" ", "\n\n"), "z" * 50_000, "\x0b\x0cé", *[" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(60)]]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "one", "x"), (3, long, "x"), (3, "one", "x"), (90, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3).withColumns({c: F.lit("x") for c in ("rep", "row", "salt", "copies", "component", "component_id")})
    got = simhash.simhash_duplicates(df)
    assert set(got.columns) == set(df.columns) | {"fingerprint"}
    prints = [(i, plain_fingerprint(t)) for i, t, _ in rows]
    components = expected_components(prints)
    assert sorted(map(repr, ((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()))) == sorted(
        map(repr, ((i, f"{f:016x}", components.get(i)) for i, f in prints))
    )
    assert simhash.simhash_duplicates(df.limit(0)).count() == 0


def test_fingerprints_across_chunks(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    texts = ["a b c d e f g h i j k l m", "", "p q", "a b c d e f g h i j k l", "r s t u v w x y z"]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("direct", [4096, 2])
def test_links_equal_all_pairs(spark, direct):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(150)]
    for f in list(prints):
        for _ in range(3):
            g = f
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                g ^= 1 << b
            prints.append(g)
    hot = rng.getrandbits(64)                                  # many that share every segment with many
    prints += [hot ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5)]
    prints = sorted(set(prints) | {0, 1, (1 << 64) - 1, (1 << 64) - 2})
    rng.shuffle(prints)
    rows = list(enumerate(prints))
    signed = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in rows], "fp long, rep long")
    links = [tuple(r) for r in simhash.links(signed, direct).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 2 for a, b in links)
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    assert {i: root(i) for i in up} == expected_components(rows)
