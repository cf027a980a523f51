"""Ranked lexical search over bit-sliced Bloom signatures.

The index is made of blocks of documents.  A block holds one bitmap over its documents for every place of
their signatures, and a signature holds a document's terms, each at every level of frequency it reaches.
The bitmaps of a term's places, ANDed, mark a superset of the documents that hold it so often; weighted
sums of these slices are upper bounds of the scores.  Documents that might be among the best are scored
on their whole texts.  The index needs no shuffle: each task packs the documents it reads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.texts import ALNUM, LOWER, Words, mix, slices
from ledgerlight.session import materialise

TOP = 20
LEVELS = (1, 2, 3, 5)          # a term is in the signature once for each level that its frequency reaches
PLACES = 4                     # bits of a signature entry
SPARE = 12                     # places of a signature for each entry, at least
LEAST_WIDTH = 64
BLOCK_DOCS, BLOCK_CELLS = 1024, 1 << 23
ITEMS, ITEM_TERMS = 256, 1 << 16   # about so many items, and distinct terms of items, are searched at a time
FEW = 200_000                  # candidate ids up to this many (some 10 MB) are broadcast
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INDEX = "ids array<long>, sizes array<long>, tops array<long>, width long, bits binary"
_LEVEL_KEYS = mix(np.arange(1, len(LEVELS) + 1, dtype=np.uint64))


# --- terms --------------------------------------------------------------------

class Vocabulary:
    """Sorted hashes of query terms; words of texts are found by hash and then compared byte by byte."""

    def __init__(self, terms: Sequence[str]):
        self.data, offsets = _flat(terms)
        hashes = Words(self.data, offsets, ALNUM).hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if len(hashes) > 1 and (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two query terms share a 64-bit hash")
        self.starts, self.lengths = offsets[:-1][self.order], np.diff(offsets)[self.order]

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, term) of every word that is a query term."""
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == h)
        term, start = at[hit], words.starts[hit]
        good = (words.ends[hit] - start) == self.lengths[term]
        for length in np.unique(self.lengths[term[good]]).tolist():
            own, step = np.flatnonzero(good & (self.lengths[term] == length)), max(1, (1 << 20) // length)
            span = np.arange(length)
            for k in range(0, len(own), step):
                some = own[k : k + step]
                good[some] = (words.data[start[some, None] + span] == self.data[self.starts[term[some], None] + span]).all(1)
        return words.text[hit[good]], self.order[term[good]]


def _terms(column: pa.Array) -> Iterator[tuple[int, Words]]:
    for first, _, data, offsets in slices(column):
        yield first, Words(LOWER[data], offsets, ALNUM)


def item_terms(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, times): rows that repeat an id are one item with all their terms."""
    lowered = F.translate(F.col(f"`{text}`").cast("string"), UPPER, SMALL)
    terms = F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))
    return items.select(F.col(f"`{id_col}`").alias("item"), terms.alias("term")).groupBy("item", "term").agg(F.count("*").alias("times"))


@dataclass
class Collection:
    """Documents with a term, all their terms with repeats, and of each query term the documents that hold it."""

    documents: int
    words: int
    holding: np.ndarray

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The length factor m of documents of n terms."""
        return 75 + (25 * n * self.documents) // max(1, self.words)

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(d) + 1))) for d in self.holding], np.int64)


def gains(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to a score; it rises with the frequency."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def collection(docs: DataFrame, terms: Sequence[str]) -> Collection:
    """One pass over all ``docs`` (text); tasks hand on their counts by term."""
    words = Vocabulary(terms)

    def run(batches):
        documents = total = 0
        holding = np.zeros(len(terms), np.int64)
        for b in batches:
            for _, w in _terms(b.column(0)):
                documents, total = documents + int((w.counts > 0).sum()), total + len(w)
                holding += np.bincount(np.unique(_pair_keys(words.find(w), len(terms))) % len(terms), minlength=len(terms))
        some = np.flatnonzero(holding)
        keys = np.concatenate([[-2, -1], some])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.concatenate([[documents, total], holding[some]]))], names=["k", "n"])

    counted = docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    by_key = {r["k"]: r["n"] for r in counted}
    return Collection(by_key.get(-2, 0), by_key.get(-1, 0), np.array([by_key.get(k, 0) for k in range(len(terms))], np.int64))


# --- index --------------------------------------------------------------------

def _places(entries: np.ndarray, width: int) -> np.ndarray:
    """(PLACES, entries) rows of the signature."""
    step = mix(entries) | np.uint64(1)
    turns = np.arange(1, PLACES + 1, dtype=np.uint64)[:, None]
    return ((entries + turns * step) % np.uint64(width)).astype(np.int64)


def _block(width: int, docs: list[tuple]) -> pa.RecordBatch:
    cells = np.zeros((width, len(docs)), bool)
    for k, doc in enumerate(docs):
        cells[_places(doc[3], width), k] = True
    lists = [pa.array([[doc[c] for doc in docs]], pa.list_(pa.int64())) for c in range(3)]
    bits = pa.array([np.packbits(cells, axis=1).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([*lists, pa.array([width], pa.int64()), bits], names=["ids", "sizes", "tops", "width", "bits"])


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks of signatures of ``docs`` (id, text); texts without a term are in none.

    Signatures of a block have one width, the power of two that gives each entry SPARE places or more.
    """

    def run(batches):
        waiting: dict[int, list] = {}
        for b in batches:
            ids = b.column(0).to_pylist()
            for first, w in _terms(b.column(1)):
                h = w.hashes()
                for k in np.flatnonzero(w.counts).tolist():
                    term, tf = np.unique(h[w.first[k] : w.first[k + 1]], return_counts=True)
                    entries = np.concatenate([mix(term[tf >= level] ^ key) for level, key in zip(LEVELS, _LEVEL_KEYS, strict=True)])
                    width = max(LEAST_WIDTH, 1 << (SPARE * len(entries) - 1).bit_length())
                    block = waiting.setdefault(width, [])
                    block.append((ids[first + k], int(w.counts[k]), int(tf.max()), entries))
                    if len(block) >= min(BLOCK_DOCS, max(8, BLOCK_CELLS // width)):
                        yield _block(width, waiting.pop(width))
        for width, block in waiting.items():
            yield _block(width, block)

    return docs.select("id", "text").mapInArrow(run, INDEX)


# --- search -------------------------------------------------------------------

@dataclass
class Batch:
    """Items of one search: terms and, per item, the places of its terms among them and weight times repeats."""

    terms: list[str]
    items: list[tuple[np.ndarray, np.ndarray]]
    of: Collection


def _bounds(index: DataFrame, batch: Batch, take, schema: str) -> DataFrame:
    """``take`` a task's blocks: an iterator of (ids, known ids, item number, upper bounds of its documents)."""
    hashes = Words(*_flat(batch.terms), ALNUM).hashes()

    def block_bounds(row):
        docs = len(row["ids"])
        ids = np.array([(1 << 63) - 1 if i is None else i for i in row["ids"]], np.int64)
        known = np.array([i is not None for i in row["ids"]])
        tops = np.array(row["tops"], np.int64)
        m = batch.of.lengths(np.array(row["sizes"], np.int64))
        rows = np.frombuffer(row["bits"], np.uint8).reshape(row["width"], -1)
        held, steps, before = [], [], np.zeros(docs, np.int64)
        for k, key in enumerate(_LEVEL_KEYS):
            marks = np.bitwise_and.reduce(rows[_places(mix(hashes ^ key), row["width"])], axis=0)
            held.append(marks & held[-1] if held else marks)
            most = LEVELS[k + 1] - 1 if k + 1 < len(LEVELS) else np.iinfo(np.int64).max
            now = gains(np.minimum(tops, most), m)
            steps.append(now - before)
            before = now
        held, steps = np.stack(held), np.stack(steps).astype(np.float64)
        for number, (terms, weights) in enumerate(batch.items):
            marks = np.unpackbits(held[:, terms], axis=2, count=docs).astype(np.float64)
            yield ids, known, number, (np.matmul(weights, marks) * steps).sum(0)

    def run(batches):
        def every():
            for b in batches:
                for row in b.to_pylist():
                    yield from block_bounds(row)

        yield from take(every())

    return index.mapInArrow(run, schema)


def _flat(terms: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in terms]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)


def _rows(item, ids, known, bound) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(item, np.int32)), pa.array(ids, pa.int64(), mask=~known), pa.array(bound, pa.float64())], names=["item", "id", "bound"]
    )


def likely(index: DataFrame, batch: Batch, top: int) -> DataFrame:
    """(item, id): of each item the ``top`` documents with the highest bounds."""

    def take(found):
        best: dict[int, tuple] = {}
        for ids, known, number, bound in found:
            some = np.flatnonzero(bound > 0)
            ids, known, bound = ids[some], known[some], bound[some]
            if number in best:
                ids, known, bound = (np.concatenate(p) for p in zip(best[number], (ids, known, bound), strict=True))
            if len(bound) > top:
                keep = np.argpartition(-bound, top - 1)[:top]
                ids, known, bound = ids[keep], known[keep], bound[keep]
            best[number] = ids, known, bound
        for number, (ids, known, bound) in best.items():
            yield _rows(np.full(len(ids), number), ids, known, bound)

    each = _bounds(index, batch, take, "item int, id long, bound double")
    first = Window.partitionBy("item").orderBy(F.desc("bound"), "id")
    return each.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= top).select("item", "id")


def open_documents(index: DataFrame, batch: Batch, last: dict[int, tuple[int, int | None]]) -> DataFrame:
    """(item, id) of all documents that may be among the best.

    ``last``: score and id of the last of ``top`` documents scored already; a document with a lower bound, or with
    that bound and a greater id, comes after all of them.  Items without an entry take all with a bound above 0.
    """

    def take(found):
        for ids, known, number, bound in found:
            score, own = last.get(number, (0, None))
            bound = bound * (1 + 1e-12)         # sums of great items are rounded
            keep = bound > score
            if number in last:
                keep |= (bound >= score) & (ids <= ((1 << 63) - 1 if own is None else own))
            some = np.flatnonzero(keep)
            if len(some):
                yield _rows(np.full(len(some), number), ids[some], known[some], bound[some])

    return _bounds(index, batch, take, "item int, id long, bound double").select("item", "id")


def score(docs: DataFrame, wanted: DataFrame, batch: Batch, top: int) -> DataFrame:
    """(item, id, score) above 0 of the pairs ``wanted`` (item, id), from whole texts; every row of an id is scored.

    A task hands on its ``top`` best rows of each item, ties by id, which no other row of the task can beat.
    """
    per_id = materialise(wanted.groupBy("id").agg(F.collect_set("item").alias("items")))
    few = per_id.limit(FEW + 1).count() <= FEW
    wanted_ids = per_id.withColumnRenamed("id", "wanted_id")
    wanted_ids = F.broadcast(wanted_ids) if few else wanted_ids
    rows = docs.select("id", "text").join(wanted_ids, F.col("id").eqNullSafe(F.col("wanted_id"))).select("id", "items", "text")
    words, size = Vocabulary(batch.terms), len(batch.terms)

    def run(batches):
        best: dict[int, list] = {}

        def keep(number: int) -> list:
            best[number] = sorted(best[number], key=lambda o: (-o[0], o[1] is None, o[1] or 0))[:top]
            return best[number]

        for b in batches:
            ids, items = b.column(0).to_pylist(), b.column(1).to_pylist()
            for first, w in _terms(b.column(2)):
                found, times = np.unique(_pair_keys(words.find(w), size), return_counts=True)
                cuts = np.searchsorted(found // size, np.arange(len(w.counts) + 1))
                m = batch.of.lengths(w.counts)
                for k in range(len(w.counts)):
                    tf = np.zeros(size, np.int64)
                    tf[found[cuts[k] : cuts[k + 1]] % size] = times[cuts[k] : cuts[k + 1]]
                    for number in items[first + k]:
                        terms, weights = batch.items[number]
                        points = int((weights * gains(tf[terms], m[k])).sum())
                        if points > 0:
                            best.setdefault(number, []).append((points, ids[first + k]))
                            if len(best[number]) >= 8 * top:
                                keep(number)
        out = [(number, i, points) for number in best for points, i in keep(number)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["item", "id", "score"])

    return rows.mapInArrow(run, "item int, id long, score long")


def _pair_keys(found: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    text, term = found
    return text * size + term


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search(docs: DataFrame, index: DataFrame, rows: list, top: int) -> tuple[list, DataFrame] | None:
    """Items in the order of their numbers, and (item number, rank, id, score) of one batch of item terms."""
    terms = sorted({r["term"] for r in rows})
    of = collection(docs, terms)
    weights = of.weights()
    number = {t: k for k, t in enumerate(t for t, n, w in zip(terms, of.holding, weights, strict=True) if n and w > 0)}
    weight = dict(zip(terms, weights.tolist(), strict=True))
    per_item: dict = {}
    for r in rows:
        if r["term"] in number:
            per_item.setdefault(r["item"], []).append((number[r["term"]], r["times"] * weight[r["term"]]))
    if not per_item:
        return None
    holding = dict(zip(terms, of.holding.tolist(), strict=True))
    of = Collection(of.documents, of.words, np.array([holding[t] for t in number], np.int64))
    items = [tuple(np.array(c, np.int64) for c in zip(*found, strict=True)) for found in per_item.values()]
    batch = Batch(list(number), items, of)
    known = materialise(_best(score(docs, materialise(likely(index, batch, top)), batch, top), top))
    last = {r["item"]: (r["score"], r["id"]) for r in known.where(F.col("rank") == top).collect()}
    found = _best(score(docs, materialise(open_documents(index, batch, last)), batch, top), top)
    return list(per_item), found


def ranked_search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
    item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item its ``top`` documents with a score above 0, ties by id.

    Terms are runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased; null and empty
    texts have none and are not found.  Every row is a document: rows that repeat an id are ranked each.  Null ids come
    last among ties.  Rows that repeat an item id (null too) are one item with all their terms.  Only ids
    and texts are read, so other columns cannot clash.  Without documents, items or common terms there are no rows.

    Items are searched in batches of about ITEMS items or ITEM_TERMS terms, which bounds what is broadcast; one longer item
    is a batch of its own size.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = items.schema[item_col].dataType.simpleString()
    asked = materialise(item_terms(items, item_col, item_text))
    size = asked.agg(F.count("*"), F.count_distinct(F.coalesce(F.col("item").cast("string"), F.lit("")))).first()
    batches = max(1, math.ceil(size[0] / ITEM_TERMS), math.ceil(size[1] / ITEMS))
    index, out = materialise(build_index(docs)), None
    for k in range(batches):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == k).collect()
        found = _search(docs, index, rows, top) if rows else None
        if found is None:
            continue
        names = F.broadcast(spark.createDataFrame([(n, i) for n, i in enumerate(found[0])], f"item int, item_id {kind}"))
        one = found[1].join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out


SQL = r"""
with d as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
), q as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), t as (select item_id, term, count(*) as times from q group by all),
tf as (select doc_id, term, count(*) as tf from d group by all),
n as (select doc_id, sum(tf)::bigint as n from tf group by 1),
total as (select count(*) as docs, sum(n)::bigint as words from n),
m as (select doc_id, 75 + (25 * n * docs) // words as m from n, total),
w as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, total group by term),
s as (
  select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from t join tf using (term) join w using (term) join m using (doc_id) group by all
), r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 20
"""
