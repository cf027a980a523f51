"""SimHash near duplicates by pigeonring filtering.

Two fingerprints of 64 bits that differ in at most DISTANCE places, cut into SEGMENTS segments in a ring,
have a segment from which every chain of l segments differs in at most l * DISTANCE / SEGMENTS places.
With 2 and 4: the first segment is equal, and the first two and the first three differ in one place at
most.  Fingerprints meet by their first segment (exactly); chains prune what meets before the whole
comparison.  Where very many meet, they are dealt anew by the chain of three with one place left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.near import components
from ledgerlight.llm.texts import LOWER, NOT_SPACE, Words, beside, slices, text_results
from ledgerlight.session import materialise

SHINGLE, SEED = 3, 42
BITS, DISTANCE, SEGMENTS = 64, 2, 4
WIDTH = BITS // SEGMENTS
#: Differences allowed in a chain of 1, 2, ... segments.
BUDGETS = [length * DISTANCE // SEGMENTS for length in range(1, SEGMENTS + 1)]
CHAIN = 3                     # segments of the longest chain that allows one difference
DIRECT = 4096                 # fingerprints with one first segment that are compared in one task
CHUNK = 1 << 16               # shingles hashed at a time
SALTS = 16
MADE = ("fingerprint", "component_id")


def _joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The slice with one space between the words of a text, and where each word starts and ends in it."""
    text = words.data.copy()
    keep = NOT_SPACE[text]
    after = words.ends[words.ends < len(text)]
    text[after[~keep[after]]] = 32
    keep[after] = True
    place = np.cumsum(keep) - 1
    return text[keep].tobytes(), place[words.starts], place[words.ends - 1] + 1


def fingerprints(column: pa.Array) -> np.ndarray:
    """64-bit fingerprints of texts: each bit is 1 where it is set in over half of the shingle hashes."""
    found = []
    for _, _, data, offsets in slices(column):
        words = Words(LOWER[data], offsets, NOT_SPACE)
        counts = words.counts
        shingles = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
        text = np.repeat(np.arange(len(counts)), shingles)
        first = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + words.first[text]
        last = np.minimum(first + SHINGLE - 1, words.first[text + 1] - 1)
        raw, starts, ends = _joined(words) if len(words) else (b"", words.starts, words.ends)
        ones = np.zeros((len(counts), BITS), np.int64)
        for k in range(0, len(text), CHUNK):
            a, b, at = starts[first[k : k + CHUNK]], ends[last[k : k + CHUNK]], text[k : k + CHUNK]
            tell = xxhash.xxh64_intdigest
            h = np.fromiter((tell(raw[x:y], SEED) for x, y in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(at))
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cuts = np.flatnonzero(np.diff(at, prepend=-1))
            ones[at[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
        over = (2 * ones > shingles[:, None]).astype(np.uint8)
        found.append(np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel())
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _ring(start: int) -> Column:
    """The fingerprint turned so that segment ``start`` is the lowest."""
    f, turn = F.col("fp"), start * WIDTH
    return f if turn == 0 else F.shiftrightunsigned(f, turn).bitwiseOR(F.shiftleft(f, BITS - turn))


def _low(f: Column, bits: int) -> Column:
    return f.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


class _Joined:
    """Which fingerprints of a task are connected already: only links that join two parts leave it."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of batches sorted by the first one, cut so that no key is split."""
    rest = None
    for b in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        now = now if rest is None else [np.concatenate(p) for p in zip(rest, now, strict=True)]
        cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
        if cut:
            yield tuple(c[:cut] for c in now)
        rest = [c[cut:] for c in now]
    if rest is not None and len(rest[0]):
        yield tuple(rest)


def _pairs(key: np.ndarray, ring: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with one key at most DISTANCE apart; the chains from the lowest segment on are tried first."""
    masks = [np.uint64((1 << (WIDTH * length)) - 1) for length in range(2, SEGMENTS)]
    at, step = np.arange(len(key)), 0
    while len(at):
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        left, differ = at, ring[at] ^ ring[at + step]
        for mask, budget in zip(masks, BUDGETS[1:], strict=False):
            ok = np.bitwise_count(differ & mask) <= budget
            left, differ = left[ok], differ[ok]
        left = left[np.bitwise_count(differ) <= DISTANCE]
        yield left, left + step


def _compare(members: DataFrame) -> DataFrame:
    """Links (a, b) among the members (key, ring, rep) of each key."""

    def run(batches):
        joined = _Joined()
        for key, ring, rep in _whole_keys(batches):
            a, b = [], []
            for x, y in _pairs(key, ring.view(np.uint64)):
                for i, j in zip(rep[x].tolist(), rep[y].tolist(), strict=True):
                    if joined.join(i, j):
                        a.append(i)
                        b.append(j)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return members.select("key", "ring", "rep").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def links(classes: DataFrame, direct: int = DIRECT) -> DataFrame:
    """Links (a, b) that connect all classes (fp, rep) at most DISTANCE bits apart.

    ``direct`` moves work only: first segments with more fingerprints are split by chains of CHAIN segments
    with one place left out (at most 2 * 2^16 fingerprints share such a key), with the same links.
    """
    starts = F.array(*[F.struct(F.lit(s).alias("start"), _ring(s).alias("ring")) for s in range(SEGMENTS)])
    turned = classes.select("rep", F.explode(starts).alias("t")).select("rep", "t.start", "t.ring")
    turned = turned.withColumn("key", F.shiftleft(F.col("start").cast("long"), WIDTH).bitwiseOR(_low(F.col("ring"), WIDTH)))
    # SEGMENTS * 2^16 keys at most.
    sizes = materialise(turned.groupBy("key").count().where("count > 1"))
    met = turned.join(F.broadcast(sizes), "key")
    found = _compare(met.where(F.col("count") <= direct))
    if not sizes.where(F.col("count") > direct).isEmpty():
        rest = F.shiftrightunsigned(_low(F.col("ring"), CHAIN * WIDTH), WIDTH)
        # The place left out, the start, and what the chain holds besides, in 5 + 2 + 48 bits.
        places = F.array(*[
            F.struct(F.lit(p).cast("long").alias("p"), rest.bitwiseAND(F.lit(~(1 << p)).cast("long")).alias("rest"))
            for p in range((CHAIN - 1) * WIDTH)
        ])
        split = met.where(F.col("count") > direct).select("rep", "ring", "start", F.explode(places).alias("c"))
        own = F.shiftleft(F.col("c.p") * SEGMENTS + F.col("start"), CHAIN * WIDTH)
        chain = F.shiftleft(F.col("c.rest"), WIDTH).bitwiseOR(_low(F.col("ring"), WIDTH))
        found = found.unionByName(_compare(split.select("rep", "ring", own.bitwiseOR(chain).alias("key"))))
    return found


SIGNED = [T.StructField("fp", T.LongType())]


def simhash_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None, direct: int = DIRECT
) -> DataFrame:
    """The carried columns (all, if not named), fingerprint and component_id.

    Words are runs without white space, A-Z lower-cased; shingles are three words with one space between
    (fewer words: all of them).  Texts without words (null, empty) have fingerprint zero and are linked like
    others.  A row with a null id has a fingerprint, no component, and links nothing.  Rows that repeat an id are one
    node: their fingerprints belong to one component.  Columns with the name of a result column are replaced.
    """
    kept = beside(docs, MADE, carry)
    ids = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("_")).alias("row"), ids.alias("rep"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    signed = text_results(rows, SIGNED, lambda: lambda column: [fingerprints(column).view(np.int64)], carry=["row", "rep"])
    signed = materialise(signed)
    named = signed.where("rep is not null")
    classes = materialise(named.groupBy("fp").agg(F.min("rep").alias("rep"), F.count("*").alias("copies")))
    found = links(classes.select("fp", "rep"), direct)
    twice = named.groupBy("rep").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("rep")
    several = materialise(named.select("rep", "fp").distinct().join(twice, "rep"))
    bridges = several.withColumnRenamed("rep", "a").join(classes.select("fp", F.col("rep").alias("b")), "fp").where("a <> b")
    reached = components(found.unionByName(bridges.select("a", "b")))
    groups = classes.join(reached, "rep", "left").where("copies > 1 or component is not null")
    groups = materialise(groups.select("fp", F.least(F.coalesce("component", "rep"), "rep").alias("component_id")))
    # A hot fingerprint is met in parts; its one row is repeated for each.
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    whole = signed.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS))).join(salted, ["fp", "salt"], "left")
    return whole.select(
        *[F.col("row")[c].alias(c) for c in kept], F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("rep").isNotNull(), F.coalesce("component_id", "rep")).alias("component_id"),
    )
