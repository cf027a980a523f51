"""Benchmark decontamination: a broadcast hash set of normalised n-grams, scanned over every word window."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.texts import ALNUM, LOWER, Words, own_names, slices, text_results

WINDOW = 10
#: Bytes of one broadcast set as built (or one longer item).  A larger benchmark is met in several sets, each over all
#: documents; what they find is united, so nothing is left out.
SET_BYTES = 128 << 20
#: A byte of item text makes at most half a window of 24 bytes and one byte of normalised words.
BUILT = 13
FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    T.StructField("cleaned", T.StringType()),
]
EMPTY = hashlib.sha256(b"").hexdigest()


class NgramSet:
    """Windows of benchmark items by length: sorted hashes, a bit table before them, places of their words to verify.

    Everything is in arrays: 24 bytes a window beside the normalised words of the items.
    """

    def __init__(self, items: Sequence[tuple[str, str | None]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        said, table, done = [], {}, 0
        for first, _, raw, offsets in slices(pa.array([text for _, text in items], pa.large_string())):
            data = LOWER[raw]
            words = Words(data, offsets, ALNUM)
            size = words.ends - words.starts
            begin = np.cumsum(size + 1) - (size + 1)
            inside = np.flatnonzero(ALNUM[data])
            joined = np.full(int((size + 1).sum()), 32, np.uint8)
            joined[inside + np.repeat(begin - words.starts, size)] = data[inside]
            hashes = words.hashes()
            own = np.minimum(words.counts, window)
            for length in np.unique(own[own > 0]).tolist():
                at, value = words.runs(hashes, length)
                mine = own[words.text[at]] == length
                at, value = at[mine], value[mine]
                last = at + length - 1
                table.setdefault(length, []).append(
                    (value, begin[at] + done, (begin[last] + size[last] - begin[at]).astype(np.int32), (words.text[at] + first).astype(np.int32))
                )
            said.append(joined)
            done += len(joined)
        self.said = np.concatenate(said) if said else np.zeros(0, np.uint8)
        self.windows, self.bits = {}, {}
        for length in list(table):
            columns = [np.concatenate(c) for c in zip(*table.pop(length), strict=True)]
            order = np.argsort(columns[0], kind="stable")
            self.windows[length] = tuple(c[order] for c in columns)
            self.bits[length] = np.zeros(1 << 20, bool)
            self.bits[length][self.windows[length][0] >> np.uint64(44)] = True

    def found(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, words, items) of each verified occurrence."""
        for length, (values, begin, size, item) in self.windows.items():
            at, value = words.runs(hashes, length)
            maybe = np.flatnonzero(self.bits[length][value >> np.uint64(44)])
            low, high = (np.searchsorted(values, value[maybe], side) for side in ("left", "right"))
            for k in np.flatnonzero(low < high):
                first = int(at[maybe[k]])
                text = b" ".join(words.word(first + j) for j in range(length))
                same = [e for e in range(low[k], high[k]) if self.said[begin[e] : begin[e] + size[e]].tobytes() == text]
                if same:
                    yield first, length, {self.names[item[e]] for e in same}

    def tell(self, column: pa.Array) -> list:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for first, end, raw, offsets in slices(column):
            words = Words(LOWER[raw], offsets, ALNUM)
            hit = np.zeros(len(words) + 1, np.int64)
            items: dict[int, set[str]] = {}
            for at, length, names in self.found(words, words.hashes()):
                hit[at] += 1
                hit[at + length] -= 1
                items.setdefault(int(words.text[at]), set()).update(names)
            marked = np.cumsum(hit[:-1]) > 0
            before = np.concatenate([[0], np.cumsum(marked)])
            n_hit = before[words.first[1:]] - before[words.first[:-1]]
            for k in range(end - first):
                named = sorted(items.get(k, ()))
                out[2].append(len(named))
                out[3].append(hashlib.sha256(",".join(named).encode()).hexdigest() if named else EMPTY)
                out[5].append(self.cut(words, marked, k, raw) if n_hit[k] else None)
            out[0].extend(words.counts.tolist())
            out[1].extend(n_hit.tolist())
            out[4].extend((n_hit > 0).tolist())
        return [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()), strict=True)]

    @staticmethod
    def cut(words: Words, marked: np.ndarray, k: int, raw: np.ndarray) -> str:
        """Text ``k`` without the spans of hit words."""
        at, parts = words.offsets[k], []
        own = np.arange(words.first[k], words.first[k + 1])
        edges = np.diff(np.concatenate([[0], marked[own].astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            parts.append(raw[at : words.starts[own[a]]].tobytes())
            at = words.ends[own[b - 1]]
        parts.append(raw[at : words.offsets[k + 1]].tobytes())
        return b"".join(parts).decode()


def item_sets(benchmark: DataFrame, id_col: str, text: str, set_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Distinct items in blocks whose sets take at most ``set_bytes`` bytes, or one longer item; they come part by part."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text}`").cast("string").alias("t")
    ).where("t is not null").distinct()
    block, built = [], 0
    for r in items.select("i", "t", F.octet_length("t").alias("n")).toLocalIterator():
        if block and built + BUILT * (r.n + 1) > set_bytes:
            yield block
            block, built = [], 0
        block.append((r.i, r.t))
        built += BUILT * (r.n + 1)
    yield block


@own_names("text")
def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", carry: Sequence[str] | None = None, set_bytes: int = SET_BYTES,
) -> DataFrame:
    """The carried columns, n_words, n_hit, n_items, items_sha256, contaminated and the text without hit spans.

    ``cleaned`` is null for a text without hits.  Null and empty texts have no words; an item without
    words has no window; items with one id are one item, a null id counts as the empty one.  Rows stay
    as many as they are.  Windows found by hash are compared word by word before they count.
    """
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(NgramSet(part, window)) for part in item_sets(benchmark, item_id, item_text, set_bytes)]
    if len(shared) == 1:
        return text_results(docs, FIELDS, lambda: shared[0].value.tell, text, carry)
    return text_results(docs, FIELDS, lambda: _Blocks(shared).tell, text, carry)


class _Blocks(NgramSet):
    """Several sets over each batch in turn: a worker holds one at a time; spans and items are united."""

    def __init__(self, sets: list):
        self.sets, self.spans = sets, iter(())

    def found(self, words, hashes):
        return next(self.spans)

    def tell(self, column):
        spans: dict[int, list] = {}
        for one in self.sets:
            grams = one.value
            for k, (_, _, raw, offsets) in enumerate(slices(column)):
                words = Words(LOWER[raw], offsets, ALNUM)
                spans.setdefault(k, []).extend(grams.found(words, words.hashes()))
            one.__dict__.pop("_value", None)      # read again from the worker's copy for the next batch
        self.spans = iter(spans.values())
        return super().tell(column)


SQL = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), g as (
  select distinct item_id, least(10, len(ws)) as n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') as gram
  from (select item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) as i from b where len(ws) > 0)
), lengths as (select distinct n from g),
d as (
  select doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') as gram
  from (select doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) as i from w, lengths where len(ws) >= n)
), f as (select d.doc_id, d.i, d.n, g.item_id from d join g on d.n = g.n and d.gram = g.gram),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from f) group by doc_id),
k as (
  select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
  from (select distinct doc_id, cast(item_id as varchar) as item from f) group by doc_id
)
select w.doc_id, cast(len(w.ws) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(k.n_items, 0) as n_items,
       coalesce(k.items_sha256, sha256('')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from w left join h on w.doc_id = h.doc_id left join k on w.doc_id = k.doc_id
"""
