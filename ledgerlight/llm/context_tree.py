"""Language model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; each decision has a tree of contexts, the last 0 to DEPTH bytes.
A node holds a Krichevsky-Trofimov estimate, and mixes it half and half with what its children say:
P(s) = 1/2 KT(s) + 1/2 prod P(children of s).  Weights come from the counts of the training texts and
are then fixed; a context that training never saw has no node, so the mixture ends at its parent.

Counts are gathered per chunk of texts and added up; the tree is computed in groups that share their
last two bytes (the two levels above have at most 256 x 255 nodes).  Each chunk gets back what the
model says of the byte runs and words that occur in it, so a task holds the tables of its chunk and
nothing grows with the corpus but the number of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.texts import LOWER, NOT_SPACE, Words, remainder, slices
from ledgerlight.session import materialise

DEPTH = 5
CHUNK_BYTES = 48 << 20
FOLDS, HELD_OUT = 5, 1
EDGE = 255                    # stands before a text and ends it; no UTF-8 text has this byte
WORD, GRAM = 0, 1
END = np.uint64(0)            # key of the end of a text among the words
_LOG_HALF = np.log(0.5)
_BITS = np.arange(8, dtype=np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, carried back."""
    x = np.asarray(x, np.float64)
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a run with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """DEPTH + 1 bytes up to each position, the end included, as one number; positions per text are length + 1."""
    length = np.diff(offsets)
    texts = len(length)
    text = np.repeat(np.arange(texts), length)
    padded = np.full(len(data) + (DEPTH + 1) * texts, EDGE, np.uint64)
    padded[np.arange(len(data)) + (DEPTH + 1) * text + DEPTH] = LOWER[data]
    own = np.ones(len(padded), bool)
    starts = offsets[:-1] + (DEPTH + 1) * np.arange(texts)
    for k in range(DEPTH):
        own[starts + k] = False
    value = np.zeros(len(padded) - DEPTH, np.uint64)
    for k in range(DEPTH + 1):
        value = (value << np.uint64(8)) | padded[k : len(padded) - DEPTH + k]
    return value[own[DEPTH:]], np.concatenate([[0], np.cumsum(length + 1)])


class Tally:
    """Keys and counts, put together as they come."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > 1_000_000:
            self.parts = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys, sorted, and their counts; the tally is empty afterwards, so the parts are not held beside their sum."""
        parts, self.parts, self.waiting = self.parts, [], 0
        keys = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
        counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        parts.clear()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        counts = counts[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys = keys[first]
        return keys, np.add.reduceat(counts, first) if len(first) else counts


def _unpacked(column: pa.Array) -> pa.Array:
    open_ = zstandard.ZstdDecompressor()
    return pa.array([open_.decompress(x) for x in column.to_pylist()], pa.large_binary()).cast(pa.large_string())


def packed(docs: DataFrame, id_col: str, text: str, chunks: int) -> DataFrame:
    """(id, held_out, chunk, packed text): texts go through shuffles compressed."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), (remainder(id_col, FOLDS) == HELD_OUT).alias("held_out"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.lit("chunk")), F.lit(chunks)).cast("int").alias("chunk"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("packed"),
    )
    schema = rows.drop("packed").schema.add("packed", "binary")

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1, write_content_size=True)
        for b in _small(batches):
            small = [squeeze.compress(x) for x in b.column(3).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(small, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _word_keys(words: Words) -> np.ndarray:
    return np.maximum(words.hashes(), np.uint64(1))


def gathered(rows: DataFrame) -> DataFrame:
    """(chunk, kind, key, n): the words and byte runs of each chunk, with their counts in training texts."""

    def told(chunk: int, tallies: dict[int, Tally]):
        for kind, tally in tallies.items():
            keys, n = tally.total()           # which empties it
            for k in range(0, len(keys), 100_000):
                part = keys[k : k + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), chunk, np.int32)), pa.array(np.full(len(part), kind, np.int8)), pa.array(part.view(np.int64)), pa.array(n[k : k + 100_000])],
                    names=["chunk", "kind", "key", "n"],
                )

    def run(batches: Iterator[pa.RecordBatch]):
        now, tallies = -1, {WORD: Tally(), GRAM: Tally()}        # of one chunk at a time: rows come sorted by it
        for b in _small(batches):
            held, chunk = (np.array(b.column(k).to_pylist()) for k in (1, 2))
            for c in np.unique(chunk).tolist():
                if c != now:
                    yield from told(now, tallies)
                    now, tallies = c, {WORD: Tally(), GRAM: Tally()}
                for train in (True, False):
                    own = np.flatnonzero((chunk == c) & (held != train))
                    if not len(own):
                        continue
                    for first, end, raw, offsets in slices(_unpacked(b.column(3).take(pa.array(own)))):
                        keys = np.concatenate([_word_keys(Words(LOWER[raw], offsets, NOT_SPACE)), np.full(end - first, END)])
                        for kind, mine in ((WORD, keys), (GRAM, grams(raw, offsets)[0])):
                            key, n = np.unique(mine, return_counts=True)
                            tallies[kind].add(key, n if train else np.zeros_like(n))
        yield from told(now, tallies)

    sorted_rows = rows.repartition("chunk").sortWithinPartitions("chunk")
    return sorted_rows.mapInArrow(run, "chunk int, kind byte, key long, n long")


def _small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


class Branch:
    """The trees below one pair of last bytes: levels 2 to DEPTH, for all eight decisions."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        symbol = keys & 255
        self.bit = ((symbol[:, None] >> (7 - _BITS)) & 1).astype(np.int64)
        self.node = (np.int64(1) << _BITS) | (symbol[:, None] >> (8 - _BITS))
        context = keys >> 8
        self.levels = []
        for depth in range(2, DEPTH + 1):
            within = (context & ((np.int64(1) << (8 * depth)) - 1))[:, None] << 8 | self.node
            names, at = np.unique(within.ravel(), return_inverse=True)
            each = np.repeat(counts, 8)
            ones = np.bincount(at, each * self.bit.ravel(), len(names))
            zeros = np.bincount(at, each, len(names)) - ones
            self.levels.append((names, at, zeros, ones, log_kt(zeros, ones)))
        below = self.levels[-1][4]
        self.stop = [np.ones(len(below))]
        for depth in range(DEPTH - 1, 1, -1):
            names, _, _, _, kt = self.levels[depth - 2]
            child = self.levels[depth - 1][0]
            parent = ((child >> 8) & ((np.int64(1) << (8 * depth)) - 1)) << 8 | (child & 255)
            deeper = np.bincount(np.searchsorted(names, parent), below, len(names))
            below = np.logaddexp(_LOG_HALF + kt, _LOG_HALF + deeper)
            self.stop.insert(0, np.exp(_LOG_HALF + kt - below))
        self.weighted = below                 # of the nodes at level 2, by decision

    def logs(self, above: dict[str, np.ndarray], last: int) -> np.ndarray:
        """log10 of the probability of each key's byte; above: weights and counts of levels 0 and 1."""
        mixed = None
        for depth in range(DEPTH, 1, -1):
            _, at, zeros, ones, _ = self.levels[depth - 2]
            mixed = self._mix(mixed, at, zeros, ones, self.stop[depth - 2])
        for level, row in ((1, last), (0, 0)):
            at = self.node.ravel()
            mixed = self._mix(mixed, at, *(above[f"{k}{level}"][row] for k in ("zeros", "ones", "stop")))
        return np.log10(mixed[0].reshape(self.bit.shape)).sum(1)

    def _mix(self, deeper, at, zeros, ones, stop):
        n = (zeros + ones)[at]
        own = (np.where(self.bit.ravel() == 1, ones[at], zeros[at]) + 0.5) / (n + 1)
        if deeper is None:
            return own, n > 0
        value, seen = deeper
        keep = np.where(seen, stop[at], 1.0)
        return keep * own + (1 - keep) * value, n > 0


def upper_levels(nodes: Sequence[tuple]) -> dict[str, np.ndarray]:
    """Levels 1 and 0 from rows (last byte, decision, zeros, ones, log weight below), at most 256 x 255."""
    zeros, ones, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
    for last, node, z, o, p in nodes:
        zeros[last, node], ones[last, node], below[last, node] = z, o, p
    out = {"zeros1": zeros, "ones1": ones, "zeros0": zeros.sum(0, keepdims=True), "ones0": ones.sum(0, keepdims=True)}
    for level in (1, 0):
        kt = log_kt(out[f"zeros{level}"], out[f"ones{level}"])
        whole = np.logaddexp(_LOG_HALF + kt, _LOG_HALF + below)
        out[f"stop{level}"] = np.exp(_LOG_HALF + kt - whole)
        below = whole.sum(0, keepdims=True)
    return out


def gram_logs(counts: DataFrame) -> DataFrame:
    """(key, value, chunks): log10 probability of the last byte of each key after the others; counts (key, n, chunks)."""
    pairs = counts.withColumn("pair", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)).cast("int"))

    def up(_, table):
        branch = Branch(table.column("key").to_numpy(), table.column("n").to_numpy())
        names, _, zeros, ones, _ = branch.levels[0]
        last = (names >> 8) & 255
        return pa.table({"last": pa.array(last, pa.int32()), "node": pa.array(names & 255, pa.int32()), "zeros": zeros, "ones": ones, "below": branch.weighted})

    tops = pairs.select("pair", "key", "n").groupBy("pair").applyInArrow(up, "last int, node int, zeros double, ones double, below double")
    above = upper_levels([tuple(r) for r in tops.groupBy("last", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).collect()])
    shared = counts.sparkSession.sparkContext.broadcast(above)

    def down(_, table):
        keys = table.column("key").to_numpy()
        branch = Branch(keys, table.column("n").to_numpy())
        return pa.table({"key": keys, "value": branch.logs(shared.value, int((keys[0] >> 8) & 255)), "chunks": table.column("chunks")})

    return pairs.groupBy("pair").applyInArrow(down, "key long, value double, chunks array<int>")


def tree_scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Of each row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Texts are lower-cased (A-Z) and end with a mark, which is a token and a byte of its own.  Null
    counts as empty: the end alone.  Rows that repeat an id are scored and learned from as often as
    they come; a null id counts as the empty text where folds are made.  Without training texts all
    decisions are even and all tokens unknown.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).head()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    rows = packed(docs, id_col, text, chunks)
    # One row per key: its count, and the chunks that want to know it (a number for every CHUNK_BYTES of text at most).
    counts = materialise(gathered(rows).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.collect_list("chunk").alias("chunks")))
    totals = counts.where(F.col("kind") == WORD).agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1)), F.sum(F.when(F.col("key") == 0, F.col("n")))).head()
    tokens, distinct, ends = (int(t or 0) for t in totals)
    whole = max(0.5 * (distinct + 1), tokens + 0.5 * (distinct + 1))
    base = F.log10((F.col("n") + 0.5) / F.lit(whole))
    words = counts.where(F.col("kind") == WORD).select("kind", "key", base.alias("value"), (F.col("n") > 0).alias("known"), "chunks")
    runs = gram_logs(counts.where(F.col("kind") == GRAM).select("key", "n", "chunks"))
    values = words.unionByName(runs.select(F.lit(GRAM).cast("byte").alias("kind"), "key", "value", F.lit(True).alias("known"), "chunks"))
    tables = values.select(F.explode("chunks").alias("chunk"), "kind", "key", "value", "known")
    end = (float(np.log10((ends + 0.5) / whole)), ends > 0)

    def score(_, texts, table):
        kind = table.column("kind").to_numpy()
        key, value = table.column("key").to_numpy().view(np.uint64), table.column("value").to_numpy()
        known = table.column("known").to_numpy(zero_copy_only=False)
        looked = []
        for k in (WORD, GRAM):
            own = np.flatnonzero(kind == k)
            own = own[np.argsort(key[own])]
            looked.append((key[own], value[own], known[own]))
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for batch in texts.select(["packed"]).to_batches(max_chunksize=512):
            for _, _, raw, offsets in slices(_unpacked(batch.column(0))):
                words = Words(LOWER[raw], offsets, NOT_SPACE)
                at = np.searchsorted(looked[WORD][0], _word_keys(words))
                gram, cut = grams(raw, offsets)
                logs = looked[GRAM][1][np.searchsorted(looked[GRAM][0], gram)]
                out[0].append(words.counts + 1)
                out[1].append(_sums(looked[WORD][2][at], words.first).astype(np.int64) + end[1])
                out[2].append(_sums(looked[WORD][1][at], words.first) + end[0])
                out[3].append(_sums(logs, cut))
                out[4].append(np.diff(offsets) + 1)
        n_tokens, n_known, base_score, model, size = (np.concatenate(o) for o in out)
        return pa.table({
            "id": texts.column("id"), "held_out": texts.column("held_out"), "n_tokens": n_tokens, "n_known": n_known,
            "train_tokens": np.full(len(n_tokens), tokens), "base_score": base_score, "score": model,
            "n_bytes": size, "bits_per_byte": -model / np.log10(2) / size,
        })

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return rows.groupBy("chunk").cogroup(tables.groupBy("chunk")).applyInArrow(score, schema).withColumnRenamed("id", id_col)


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(cuts) - 1)
    some = np.flatnonzero(np.diff(cuts))
    if len(some):
        out[some] = np.add.reduceat(values.astype(np.float64), cuts[:-1][some])
    return out
