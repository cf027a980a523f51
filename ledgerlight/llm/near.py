"""Near-duplicate groups: HyperMinHash bands, collision-corrected estimates, links confirmed on full shingle sets.

Documents with one shingle set are one class; only classes are compared.  Each bucket of a band first
links its members to its smallest one (linear in its size).  Where a bucket still holds several
components, its members are estimated against each other in blocks of registers; the few pairs that
may reach the threshold are confirmed on full texts in small tasks.  No pairs of copies are listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import sketch
from ledgerlight.llm.texts import beside, own_names, slices, text_results
from ledgerlight.session import materialise

THRESHOLD = (80, 100)         # 100 * intersection >= 80 * union
LOST = 1e-6                   # of the pairs at the threshold, so many at most are not confirmed
BLOCK = 2048                  # members of a bucket estimated against each other in one task
PART = 256                    # partners of a pivot in a task that confirms
PART_SHINGLES = 1 << 18       # shingles on either side of any other task that confirms, or one longer text
BROADCAST_IDS = 1_000_000     # ids up to this many (16 MB) are broadcast, beyond it a shuffle join is used
SIGNATURE = [
    T.StructField("n_shingles", T.LongType()), T.StructField("_high", T.LongType()), T.StructField("_low", T.LongType()),
    T.StructField("_bands", T.ArrayType(T.LongType(), False)),
]
MADE = ("n_shingles", "component_id", "kept")


def _registers(bands: pa.Array) -> np.ndarray:
    """(rows, BUCKETS) registers of a column of packed bands."""
    flat = bands.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.view(np.uint16).reshape(-1, sketch.BUCKETS)


def _least_equal(n: int) -> int:
    """The most equal registers of n that a pair at the threshold stays below with a probability of LOST at most."""
    t, below = Fraction(*THRESHOLD), Fraction(0)
    for k in range(n + 1):
        below += math.comb(n, k) * t**k * (1 - t) ** (n - k)
        if below > LOST:
            return k
    return n


#: By the number of filled registers.
LEAST_EQUAL = np.array([_least_equal(n) for n in range(sketch.BUCKETS + 1)])


def _may_reach(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    most, whole = THRESHOLD
    either = np.maximum(1, ((a != sketch.EMPTY) | (b != sketch.EMPTY)).sum(-1))
    sizes = np.minimum(n, m) * whole >= most * np.maximum(n, m)
    # The estimate is less the equal registers by chance, a small part of one.
    return sizes & (sketch.estimate(a, b, n, m) * either > LEAST_EQUAL[either] - 0.5)


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return THRESHOLD[1] * both >= THRESHOLD[0] * (len(a) + len(b) - both)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of one task, from batches sorted by the column ``task``."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if rest is not None:
            now = pa.concat_tables([rest, now])
        tasks = now.column("task").to_numpy()
        cuts = np.flatnonzero(tasks[1:] != tasks[:-1]) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield now.slice(a, b - a)
        rest = now.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        yield rest


class _Sets:
    """Union-find over the ids of one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


LINKS = "a long, b long"


def confirm(tasks: DataFrame, texts: DataFrame, shingle: int = sketch.SHINGLE) -> DataFrame:
    """Links (a, b) of tasks (task, rep, partners): each rep against its partners, on full shingle sets.

    All partners of a task are rows of it.  Pairs that links of the same task already connect are skipped.
    """

    def run(batches):
        for rows in _groups(batches):
            found: dict[int, list] = {}
            wanted: list[tuple[int, int]] = []
            text = rows.column("text").combine_chunks()
            text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
            sets = [s for _, _, data, offsets in slices(text) for s in sketch.shingle_sets(data, offsets, shingle)]
            for rep, partners, s in zip(rows.column("rep").to_pylist(), rows.column("partners").to_pylist(), sets, strict=True):
                found.setdefault(rep, []).append(s)
                wanted.extend((rep, p) for p in partners)
            joined, links = _Sets(), []
            for x, y in wanted:
                if joined.root(x) != joined.root(y) and any(_linked(a, b) for a in found.get(x, ()) for b in found.get(y, ())):
                    joined.join(x, y)
                    links.append((x, y))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    tasks = materialise(tasks)
    ids = tasks.select("rep").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    own = materialise(texts.join(ids, "rep"))
    together = tasks.join(own, "rep").select("task", "rep", "partners", "text")
    return materialise(together.repartition("task").sortWithinPartitions("task").mapInArrow(run, LINKS))


def near_pairs(members: DataFrame) -> DataFrame:
    """Tasks for pairs of members of one bucket, in different components, whose estimates may reach the threshold.

    members: task, side, rep, n, bands, component.  Sides 0 and 1 are compared with each other, side 2
    (a bucket of one block) within.  A pair is listed only in the first band in which it meets.
    """

    def run(batches):
        for rows in _groups(batches):
            task = rows.column("task")[0].as_py()
            band = rows.column("band")[0].as_py()
            rep, n, component, side = (rows.column(c).to_numpy() for c in ("rep", "n", "component", "side"))
            bands = rows.column("bands").combine_chunks()
            bands = bands.chunk(0) if isinstance(bands, pa.ChunkedArray) else bands
            regs = _registers(bands)
            packed = regs.view(np.int64)
            pairs = []
            for i in range(len(rep)):
                others = component != component[i]
                others &= (rep > rep[i]) if side[i] == 2 else (side == 1) if side[i] == 0 else False
                at = np.flatnonzero(others)
                if len(at):
                    own = np.broadcast_to(regs[i], (len(at), sketch.BUCKETS))
                    at = at[_may_reach(own, regs[at], n[i], n[at])]
                if len(at):
                    same = (packed[at] == packed[i]) & (packed[at] != -1)
                    at = at[same.argmax(1) == band]
                    pairs.extend((i, int(j)) for j in at)
            if not pairs:
                continue
            parts: dict[tuple[int, int], dict[int, list[int]]] = {}
            part = (np.cumsum(n) // PART_SHINGLES).tolist()      # parts of equal weight, so short texts meet in few tasks
            for i, j in pairs:
                one = parts.setdefault((part[i], part[j]), {})
                one.setdefault(i, []).append(int(rep[j]))
                one.setdefault(j, [])
            out = [(hash((task, *k)), int(rep[i]), p) for k, one in parts.items() for i, p in one.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int64()))],
                names=["task", "rep", "partners"],
            )

    return members.repartition("task").sortWithinPartitions("task").mapInArrow(run, "task long, rep long, partners array<long>")


def star_tasks(stars: DataFrame) -> DataFrame:
    """Of (pivot, rep, registers and sizes of both): the pairs whose estimate may reach the threshold."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                keep = _may_reach(
                    _registers(b.column(2)), _registers(b.column(3)), b.column(4).to_numpy(), b.column(5).to_numpy()
                )
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["pivot", "rep"]).filter(pa.array(keep))

    near = materialise(stars.mapInArrow(run, "pivot long, rep long"))
    # A pivot with many partners gets several tasks, each with the pivot's own text.
    parts = near.groupBy("pivot").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / PART).cast("long"))
    placed = near.join(materialise(parts), "pivot").select(
        "pivot", "rep", F.xxhash64("pivot", F.pmod(F.xxhash64("rep"), F.col("parts"))).alias("task")
    )
    members = placed.select("task", "rep", F.array().cast("array<long>").alias("partners"))
    pivots = placed.groupBy("task", "pivot").agg(F.collect_list("rep").alias("partners"))
    return members.unionByName(pivots.select("task", F.col("pivot").alias("rep"), "partners"))


def components(links: DataFrame) -> DataFrame:
    """(rep, component): the smallest id each linked id reaches.

    Every node points at the neighbour with the least hash (or itself), edges are contracted and the
    rest goes on; random priorities make that a logarithmic number of rounds.  Ids that no link names
    are not in the result.
    """
    edges = materialise(links.where("a <> b").select("a", "b").distinct())
    pointers: list[DataFrame] = []
    while not edges.isEmpty():
        seed = F.lit(len(pointers))
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), seed).alias("h"), F.col(c).alias("id"))  # noqa: E731, B023
        least = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        points = materialise(least.select(F.col("a").alias("x"), F.least(F.col("m"), rank("a"))["id"].alias("y")))
        pointers.append(points)
        edges = materialise(
            edges.join(points.toDF("a", "ya"), "a").join(points.toDF("b", "yb"), "b").where("ya <> yb")
            .select(F.col("ya").alias("a"), F.col("yb").alias("b")).distinct()
        )
    if not pointers:
        return links.sparkSession.createDataFrame([], "rep long, component long")
    roots = pointers[0].toDF("rep", "root")
    for points in pointers[1:]:
        roots = roots.join(points.toDF("root", "next"), "root", "left").select("rep", F.coalesce("next", "root").alias("root"))
    roots = materialise(roots)
    least = materialise(roots.groupBy("root").agg(F.min("rep").alias("component")))
    return materialise(roots.join(least, "root").select("rep", F.least("rep", "component").alias("component")))


def _links(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """Components over the class representatives (rep, n, bands) of ``docs`` (rep, text)."""
    rows = classes.select("rep", F.posexplode("bands").alias("band", "value")).where("value <> -1")
    rows = rows.select("rep", "band", F.xxhash64("band", "value").alias("key"))
    shared = materialise(
        rows.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    )
    members = materialise(rows.join(shared, "key"))
    stars = members.where("pivot <> rep").select("pivot", "rep").distinct()
    sides = classes.select("rep", "bands", "n")
    stars = stars.join(sides, "rep").join(sides.toDF("pivot", "bands_p", "n_p"), "pivot").select(
        "pivot", "rep", "bands_p", "bands", "n_p", "n"
    )
    first = confirm(star_tasks(stars), docs, shingle)

    known = components(first)
    members = members.where("size > 2 and pivot <> rep").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    members = materialise(members)
    mixed = materialise(
        members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    left = members.join(mixed, "key").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    one = left.where("blocks = 1").select("rep", "component", "band", F.col("key").alias("task"), F.lit(2).alias("side"))
    # Block x meets every block: with itself inside, with later ones as the first side.
    many = left.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "component", "band", F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    placed = one.unionByName(many).join(sides, "rep").select("task", "band", "side", "rep", "n", "bands", "component")
    second = confirm(near_pairs(placed), docs, shingle)
    return components(first.unionByName(second))


@own_names("id_col", "text")
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = sketch.SHINGLE) -> DataFrame:
    """All columns, and n_shingles, component_id, kept (a column of such a name is replaced).

    Words are runs without white space, A-Z lower-cased; a set is the distinct runs of ``shingle`` words, or
    all words as one run if there are fewer.  Documents whose sets have a Jaccard similarity of 0.8 or
    more are linked; component_id is the smallest id reached, kept marks it.  Texts without words
    (null, empty) have no set and stay alone.  A row with a null id stays alone, with a null component,
    and is kept.  Rows that repeat an id are one node and share its component.

    Two texts at exactly the threshold miss each other in all bands once in about 20 million, and fall
    below the cut of the estimate once in a million or less (exact binomial); above it both shrink fast.
    """
    ids = F.col(f"`{id_col}`")
    long_ids = docs.where(ids.isNotNull()).select(ids.cast("long").alias("rep"), F.col(f"`{text}`").cast("string").alias("text"))
    signed = materialise(text_results(long_ids, SIGNATURE, lambda: lambda column: sketch.signatures(column, shingle), carry=["rep"]))
    classes = signed.where("n_shingles > 0").groupBy("_high", "_low", F.col("n_shingles").alias("n")).agg(
        F.min("rep").alias("rep"), F.count("*").alias("copies"), F.first("_bands").alias("bands")
    )
    classes = materialise(classes)
    found = _links(long_ids, classes.select("rep", "n", "bands"), shingle)
    groups = classes.select("_high", "_low", "n", "copies", "rep").join(found, "rep", "left")
    groups = materialise(groups.where("copies > 1 or component is not null").select(
        "_high", "_low", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component")
    ))
    # A hot class is met in parts; its one row is repeated for each.
    salts = 16
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    named = signed.drop("_bands").withColumn("_salt", F.pmod(F.xxhash64("rep"), F.lit(salts))).join(
        salted, ["_high", "_low", "n_shingles", "_salt"], "left"
    ).select("rep", "n_shingles", F.least("rep", "component").alias("component_id"))
    per_id = named.groupBy("rep").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    others = [F.col(f"`{c}`") for c in beside(docs, MADE)]
    whole = docs.select(*others, ids.cast("long").alias("rep")).join(per_id, "rep", "left")
    return whole.select(
        *others, F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"), F.col("component_id").cast("long").alias("component_id"),
        F.col("rep").eqNullSafe(F.col("component_id")).alias("kept"),
    )


#: Every pair of sets that share a shingle; for small tables.
SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, hash(array_to_string(ws[i : i + 3], ' ')) as g
  from (select doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) as i from w where len(ws) > 0)
), n as (select doc_id, count(*) as n from s group by doc_id),
sets as (select doc_id, list_sort(list(g)) as gs from s group by doc_id),
cls as (select gs, min(doc_id) as rep from sets group by gs),
m as (select sets.doc_id, cls.rep from sets join cls on sets.gs = cls.gs),
r as (select s.* from s join (select distinct rep from m) k on s.doc_id = k.rep),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from r a join r b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from common join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)
), e as (select x, y from links union all select y, x from links),
reach as (select rep as v, rep as u from m union select e.y as v, reach.u from reach join e on reach.v = e.x),
comp as (select v, min(u) as c from reach group by v)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(comp.c, w.doc_id) as component_id, w.doc_id = coalesce(comp.c, w.doc_id) as kept
from w left join n on w.doc_id = n.doc_id left join m on w.doc_id = m.doc_id left join comp on comp.v = m.rep
"""
