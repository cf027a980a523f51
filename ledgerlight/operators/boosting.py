"""Gradient-boosted trees on binned features, with an L2 leaf term and a branch for missing values.

Features are cut into at most 255 bins.  A level of a tree needs one aggregate: per open node and bin the
sums of gradients, hessians and rows.  Tasks add up their own rows and only these sums move; of two
sisters the smaller one is measured, the other is the rest of their parent.  The sums decide the splits
by the same code wherever they were added:

* in one task, where there are at most ONE_TASK rows (some 140 bytes a row, and some 50 while they come): a job for
  each level, some 0.15 s whatever the rows, would take longer than the level.  What a row has is kept side by side
  as well (``side_by_side``), since the rows of a deep node lie far apart;
* by one job a level over the rows as partitions of arrays, kept by Spark (some 25 bytes a row, 8 of them scores, which
  are all that a tree writes anew), for any number of rows.  A task tells the sums of its rows, at most MOST_PARTS of
  which meet on the driver; the job that adds a finished tree to the scores tells the sums of the next root as well.

Where a node has many rows, several features are counted at once by one code (``Bins.codes``), and the sums of each
feature are the margins of that table.

A tree is grown level by level to its depth; its splits are then taken in order of gain until it has
``max_leaves`` leaves, which gives the tree that best-first growth gives, in fewer rounds.
"""

from __future__ import annotations

import copy
import heapq
import json
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.accumulators import AccumulatorParam
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.session import materialise, scratch_root

MAX_BINS = 255
ONE_TASK = 1_000_000
PART_ROWS = 50_000            # rows of a partition at least; one for each core, MOST_PARTS at most: a level is one wave of tasks
MOST_PARTS = 48
MOST_ROWS = 4_000_000         # rows of a partition above which a level is two waves of tasks or more, up to MOST_PARTS
KEEP_EVERY = 50               # trees between two checkpoints of the scores in the partitions
SCORED = 250                  # rows scored at a time: their bit sets stay in a core's cache
MOVED = 32                    # the same where features are moved: some 17 bit sets a row
CODES = 1 << 16               # numbers of a code of several features
CODED_ROWS = 30_000           # rows of a node that make the margins of codes worth it
BLOCK = 1 << 15               # rows of a partition that are placed in a tree at a time
CHUNK = 1 << 18               # rows of a partition whose slopes are added up at a time
PIECE = 1 << 20               # rows that travel between Spark and Python as one item, and so lie in one buffer


@dataclass(frozen=True)
class Settings:
    max_iter: int = 300
    max_depth: int = 6
    step: float = 0.05
    l2: float = 1.0
    max_leaves: int = 31
    min_rows: int = 20            # rows in a leaf
    min_hessian: float = 1e-3
    patience: int = 10            # rounds without a better validation loss before training stops; 0: never
    tolerance: float = 1e-7
    stop_from: int = 10_000       # training tables above this many rows hold a part back for the stop
    held_back: float = 0.1


# --- bins ---------------------------------------------------------------------

@dataclass
class Bins:
    """Upper ends of the bins of each feature, and the start of its bins in one flat array.

    A feature has one bin more for missing values, after its others.
    """

    edges: list[np.ndarray]
    start: np.ndarray = field(init=False)
    width: np.ndarray = field(init=False)

    def __post_init__(self):
        self.width = np.array([len(e) + 2 for e in self.edges], np.int64)
        self.start = np.cumsum(self.width) - self.width

    @property
    def total(self) -> int:
        return int(self.width.sum())

    @property
    def kind(self) -> type:
        """Of the bin numbers."""
        return np.uint8 if self.width.max(initial=0) <= 256 else np.int32

    def coded(self) -> list[list[int]]:
        """Features in groups, each feature in one, whose bins together have at most CODES numbers."""
        groups, sizes = [], []
        for f in np.argsort(-self.width, kind="stable").tolist():
            fits = [k for k, size in enumerate(sizes) if size * self.width[f] <= CODES]
            if fits:
                groups[fits[0]].append(f)
                sizes[fits[0]] *= int(self.width[f])
            else:
                groups.append([f])
                sizes.append(int(self.width[f]))
        return groups

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """(groups, rows): one number for the bins of all features of a group."""
        groups = self.coded()
        out = np.empty((len(groups), numbers.shape[1]), np.uint16 if self.width.max(initial=0) <= CODES else np.int32)
        for k, group in enumerate(groups):
            code = numbers[group[0]].astype(np.int64)
            for f in group[1:]:
                code = code * self.width[f] + numbers[f]
            out[k] = code
        return out

    def numbers(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """(features, rows) bin numbers; NaN is missing."""
        out = np.empty((len(self.edges), len(columns[0]) if columns else 0), self.kind)
        for k, (x, edges) in enumerate(zip(columns, self.edges, strict=True)):
            found = np.searchsorted(edges, x, "left")
            out[k] = np.where(np.isnan(x), len(edges) + 1, found)
        return out


def as_double(column: str) -> Column:
    c = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(c), c)


def find_bins(rows: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> Bins:
    """Bins between all values of features with few values, else between quantiles (rank error 1/10,000)."""
    # One sketch is some 400 columns of a plan, so one aggregate counts the features as groups.
    cells = rows.select(F.posexplode(F.array(*features)).alias("k", "v"))
    distinct = dict(cells.groupBy("k").agg(F.approx_count_distinct("v", 0.02)).collect())
    probs = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
    few = [distinct.get(k, 0) <= max_bins for k in range(len(features))]
    wanted = [F.collect_set(f) if small else F.percentile_approx(f, probs, 10_000) for f, small in zip(features, few, strict=True)]
    found = rows.agg(*[w.alias(f"v{k}") for k, w in enumerate(wanted)]).first()
    edges = []
    for values, small in zip(found, few, strict=True):
        ends = np.unique(np.array(values or [], np.float64))
        # Half-way between two values, so that new values go to the nearer one.
        edges.append((ends[:-1] + ends[1:]) / 2 if small else ends)
    return Bins(edges)


# --- one tree -----------------------------------------------------------------

class Tree:
    """A tree as it grows: node 1 is the root, 2k and 2k + 1 are the children of k."""

    def __init__(self, bins: Bins, settings: Settings):
        size = 2 << settings.max_depth
        self.bins, self.settings = bins, settings
        self.feature = np.full(size, -1)
        self.cut = np.zeros(size, np.int64)           # the last bin that goes left
        self.missing_left = np.zeros(size, bool)
        self.gain = np.zeros(size)
        self.sums = np.zeros((size, 3))               # gradients, hessians, rows
        self.value = np.zeros(size)                   # of the leaf in which a row of the node ends
        self.open: list[int] = [1]
        self.measured: list[int] = [1]
        self._before: dict[int, np.ndarray] = {}      # sums by bin of the nodes of the level above

    def absorb(self, measured: np.ndarray) -> None:
        """Split the open nodes by the sums (3, measured nodes, all bins) of one level."""
        level = {n: measured[:, k] for k, n in enumerate(self.measured)}
        for node in self.open:
            if node not in level:
                level[node] = self._before[node >> 1] - level[node ^ 1]
        splits = self._best(np.stack([level[n] for n in self.open], axis=1))
        self.open, self.measured, self._before = [n for n in self.open if n in splits], [], level
        children = []
        for node in self.open:
            self.feature[node], self.cut[node], self.missing_left[node], self.gain[node], left = splits[node]
            self.sums[2 * node], self.sums[2 * node + 1] = left, self.sums[node] - left
            largest = self.sums[2 * node : 2 * node + 2, 2].max()
            if node.bit_length() < self.settings.max_depth and largest >= 2 * self.settings.min_rows:
                children += [2 * node, 2 * node + 1]
                self.measured.append(2 * node + int(self.sums[2 * node + 1, 2] < self.sums[2 * node, 2]))
        self.open = children

    def _best(self, level: np.ndarray) -> dict[int, tuple]:
        """Of (3, open nodes, all bins): feature, last bin, way of missing values, gain, left sums of the best splits."""
        bins, s = self.bins, self.settings
        if self.open == [1]:
            self.sums[1] = level[:, 0, bins.start[0] : bins.start[0] + bins.width[0]].sum(1)
        whole = self.sums[self.open].T[:, :, None]
        upto = np.cumsum(level, axis=2)
        of = np.repeat(np.arange(len(bins.width)), bins.width)
        base = np.concatenate([np.zeros_like(upto[:, :, :1]), upto[:, :, bins.start[1:] - 1]], axis=2)
        absent = level[:, :, bins.start + bins.width - 1]
        left = upto - base[:, :, of]
        # The place of missing values is no last bin.
        cuts = np.ones(bins.total, bool)
        cuts[bins.start + bins.width - 1] = False
        weigh = lambda t: np.square(t[0]) / np.maximum(t[1] + s.l2, 1e-300)
        enough = lambda t: (t[2] >= s.min_rows - 0.5) & (t[1] >= s.min_hessian)
        best = np.full(len(self.open), 0.0)
        out = {}
        for missing_left in (False, True):
            own = left + absent[:, :, of] if missing_left else left
            rest = whole - own
            gains = np.where(enough(own) & enough(rest) & cuts, weigh(own) + weigh(rest), -np.inf) - weigh(whole)
            at = gains.argmax(1)
            for k, node in enumerate(self.open):
                place = int(at[k])
                if gains[k, place] > best[k]:
                    best[k], f = gains[k, place], of[place]
                    sums = own[:, k, place].copy()
                    seen = absent[2, k, f] > 0.5
                    # Without a missing value in the node they would go where more rows go.
                    way = missing_left if seen else bool(2 * sums[2] >= whole[2, k, 0])
                    out[node] = f, place - bins.start[f], way, best[k], sums
            if not absent[2].any():
                break
        return out

    def step_down(self, numbers: np.ndarray, rows: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """Rows by node, those of split nodes by its children."""
        out = {}
        for node, own in rows.items():
            f = self.feature[node]
            if f < 0:
                out[node] = own
                continue
            number = numbers[f] if len(own) == numbers.shape[1] else numbers[f].take(own)
            left = number <= self.cut[node]          # the bin of missing values is above every cut
            if self.missing_left[node]:
                left |= number == self.bins.width[f] - 1
            out[2 * node], out[2 * node + 1] = own.compress(left), own.compress(~left)
        return out

    def reached(self, numbers: np.ndarray, nodes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Rows that reach one of ``nodes`` (none of which is below another), rising, and the place of that node.

        A feature's number rules out the nodes on the other side of its splits; one look-up for each feature on the way
        and row, however deep the nodes are, BLOCK rows at a time.
        """
        if len(nodes) > 31:
            halves = [self.reached(numbers, nodes[k : k + 31]) for k in range(0, len(nodes), 31)]
            at, place = np.concatenate([h[0] for h in halves]), np.concatenate([h[1] + 31 * k for k, h in enumerate(halves)])
            order = np.argsort(at, kind="stable")
            return at[order], place[order]
        allowed: dict[int, np.ndarray] = {}
        for k, node in enumerate(nodes):
            while node > 1:
                f, up = int(self.feature[node >> 1]), node >> 1
                left = np.arange(self.bins.width[f]) <= self.cut[up]
                left[-1] = self.missing_left[up]
                table = allowed.setdefault(f, np.full(len(left), (1 << len(nodes)) - 1, np.int32))
                table[left if node & 1 else ~left] &= ~np.int32(1 << k)
                node = up
        if not allowed:
            return np.arange(numbers.shape[1]), np.zeros(numbers.shape[1], np.int64)
        found = []
        first, *others = allowed
        for k in range(0, max(1, numbers.shape[1]), BLOCK):
            sets = allowed[first].take(numbers[first, k : k + BLOCK])
            for f in others:
                sets &= allowed[f].take(numbers[f, k : k + BLOCK])
            at = np.flatnonzero(sets)
            found.append((at + k, first_leaf(sets.take(at))))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def finish(self) -> None:
        """Keep the splits of highest gain, parents first, up to the number of leaves, and value the leaves."""
        s = self.settings
        kept, heap = set(), [(-self.gain[1], 1)] if self.feature[1] >= 0 else []
        while heap and len(kept) + 1 < s.max_leaves:
            _, node = heapq.heappop(heap)
            kept.add(node)
            for child in (2 * node, 2 * node + 1):
                if self.feature[child] >= 0:
                    heapq.heappush(heap, (-self.gain[child], child))
        for node in range(1, len(self.feature)):
            if node not in kept:
                self.feature[node] = -1
            if node == 1 or node >> 1 in kept:
                self.value[node] = -s.step * self.sums[node, 0] / max(self.sums[node, 1] + s.l2, 1e-300)
            else:
                self.value[node] = self.value[node >> 1]

    def values(self, numbers: np.ndarray) -> np.ndarray:
        leaves = [n for n, f, *_ in self.plain() if f < 0]
        return self.value[leaves].take(self.reached(numbers, leaves)[1])

    def light(self) -> Tree:
        """A copy without sums and bins, for tasks that have the bins."""
        out = copy.copy(self)
        out._before, out.bins, out.sums = {}, None, None
        return out

    def plain(self) -> list[list]:
        """[node, feature, last bin of the left side, missing left, value] of the nodes in use, root first."""
        used = [1] + [n for n in range(2, len(self.feature)) if self.feature[n >> 1] >= 0]
        return [[n, int(self.feature[n]), int(self.cut[n]), bool(self.missing_left[n]), float(self.value[n])] for n in used]


def side_by_side(columns: np.ndarray) -> np.ndarray:
    """One item a row of (columns, rows), so that rows far apart are taken with one look into memory each."""
    return np.ascontiguousarray(columns.T).view(np.dtype((np.void, len(columns) * columns.itemsize))).ravel()


def level_sums(
    tree: Tree, numbers: np.ndarray, rows: dict[int, np.ndarray], gradient: np.ndarray, hessian: np.ndarray, codes: np.ndarray | None = None,
    beside: Sequence[np.ndarray] | None = None, seen: np.ndarray | None = None,
) -> np.ndarray:
    """(3, measured nodes, all bins) of some rows: gradients, hessians, rows.

    ``beside``: the numbers, slopes and codes ``side_by_side``.  ``seen``: the rows by bin of all rows, if known.
    """
    bins, out = tree.bins, np.zeros((3, len(tree.measured), tree.bins.total))
    whole = numbers.shape[1] if len(tree.measured) == 1 else -1      # only one node can have all rows, in their order

    def of(at: np.ndarray, k: int, columns: Sequence[np.ndarray]) -> Sequence[np.ndarray]:
        if len(at) == whole:
            return columns
        if beside is None:
            return [x.take(at) for x in columns]
        return beside[k].take(at).view(columns[0].dtype).reshape(len(at), len(columns)).T

    slopes_of = lambda at: [np.ascontiguousarray(x) for x in of(at, 1, (gradient, hessian))]
    many = [k for k, n in enumerate(tree.measured) if codes is not None and len(rows[n]) >= CODED_ROWS]
    for k in many:
        at = rows[tree.measured[k]]
        g, h = slopes_of(at)
        known = len(at) == whole and seen is not None
        if known:
            out[2, k] = seen
        for code, group in zip(of(at, 2, codes), bins.coded(), strict=True):
            own = code.astype(np.int64)
            for i, weights in enumerate((g, h) if known else (g, h, None)):
                table = np.bincount(own, weights, int(bins.width[group].prod()))
                for f in group:                    # the first feature of those left varies slowest
                    table = table.reshape(bins.width[f], -1)
                    out[i, k, bins.start[f] : bins.start[f] + bins.width[f]] = table.sum(1)
                    table = table.sum(0)
    few = [k for k in range(len(tree.measured)) if k not in many]
    if few:
        own_rows = [rows[tree.measured[k]] for k in few]
        at = own_rows[0] if len(few) == 1 else np.concatenate(own_rows)
        slot = np.repeat(np.arange(len(few)), [len(x) for x in own_rows])
        g, h = slopes_of(at)
        for own, start, width in zip(of(at, 0, numbers), bins.start, bins.width, strict=True):
            own = own + slot * width if len(few) > 1 else own.astype(np.int64)
            for i, weights in enumerate((g, h, None)):
                out[i, few, start : start + width] = np.bincount(own, weights, len(few) * width).reshape(len(few), width)
    return out


@dataclass
class Part:
    """Rows of a partition.  Label and weight are a table of the few pairs there are, and a place in it for each row."""

    numbers: np.ndarray
    pairs: np.ndarray            # (2, pairs)
    pair: np.ndarray
    raw: np.ndarray | float
    seen: np.ndarray | None = None    # rows by bin

    @staticmethod
    def of(numbers: np.ndarray, label: np.ndarray, weight: np.ndarray, raw: np.ndarray | float) -> Part:
        pairs, pair = np.unique(label + 1j * weight, return_inverse=True)
        small = np.uint8 if len(pairs) <= 256 else np.int32
        return Part(numbers, np.stack([pairs.real, pairs.imag]), pair.astype(small), raw)

    def pieces(self, count: int) -> list[Part]:
        ends = np.linspace(0, len(self.pair), count + 1).astype(np.int64).tolist()
        cut = [slice(a, b) for a, b in zip(ends, ends[1:])]
        return [replace(self, numbers=np.ascontiguousarray(self.numbers[:, c]), pair=self.pair[c], seen=self.seen if k == 0 else None) for k, c in enumerate(cut)]

    @staticmethod
    def joined(parts: Sequence[Part], raws: Sequence[np.ndarray]) -> Part:
        """The part of some pieces, with scores."""
        if len(parts) == 1:
            return replace(parts[0], raw=raws[0])
        numbers, pair = (np.concatenate(x, axis=-1) for x in ([p.numbers for p in parts], [p.pair for p in parts]))
        return replace(parts[0], numbers=numbers, pair=pair, raw=np.concatenate(raws))

    def slopes(self, at: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        label, weight = self.pairs
        pair = self.pair[at]
        return slopes(self.raw[at], label.take(pair), weight.take(pair))

    def losses(self) -> float:
        return losses(self.raw, self.pairs[0].take(self.pair), self.pairs[1].take(self.pair))

    def plus(self, tree: Tree) -> Part:
        return replace(self, raw=self.raw + tree.values(self.numbers))


def part_sums(tree: Tree, part: Part) -> np.ndarray:
    """``level_sums`` of the rows of a partition: slopes are taken for the rows of measured nodes only."""
    bins, nodes = tree.bins, tree.measured
    out = np.zeros((3, len(nodes), bins.total))
    if nodes == [1]:
        at, ends = None, np.array([part.numbers.shape[1]])
    else:
        at, place = tree.reached(part.numbers, nodes)
        at = at.take(np.argsort(place.astype(np.min_scalar_type(len(nodes))), kind="stable"))
        ends = np.cumsum(np.bincount(place, minlength=len(nodes)))
    sizes = np.diff(ends, prepend=0)
    known = at is None and part.seen is not None
    if known:
        out[2, 0] = part.seen

    def rows(first: int, end: int) -> tuple:
        own = slice(first, end) if at is None else at[first:end]
        return part.numbers[:, own] if at is None else [x.take(own) for x in part.numbers], *part.slopes(own)

    for k in np.flatnonzero(sizes >= CODED_ROWS):
        tables = [np.zeros((2 if known else 3, int(bins.width[group].prod()))) for group in bins.coded()]
        for first in range(ends[k] - sizes[k], ends[k], CHUNK):
            numbers, *weights = rows(first, min(first + CHUNK, ends[k]))
            for table, group in zip(tables, bins.coded(), strict=True):
                code = numbers[group[0]].astype(np.int64)
                for f in group[1:]:
                    code *= bins.width[f]
                    code += numbers[f]
                for own, w in zip(table, (*weights, None)):
                    own += np.bincount(code, w, len(own))
        for table, group in zip(tables, bins.coded(), strict=True):
            for i, own in enumerate(table):
                for f in group:                    # the first feature of those left varies slowest
                    own = own.reshape(bins.width[f], -1)
                    out[i, k, bins.start[f] : bins.start[f] + bins.width[f]] = own.sum(1)
                    own = own.sum(0)
    few = np.flatnonzero(sizes < CODED_ROWS)
    # Small nodes that lie side by side are counted together, up to CHUNK rows.
    while len(few):
        together = 1
        while together < len(few) and few[together] == few[0] + together and ends[few[together]] - ends[few[0]] + sizes[few[0]] <= CHUNK:
            together += 1
        own, few = few[:together], few[together:]
        numbers, *weights = rows(ends[own[0]] - sizes[own[0]], ends[own[-1]])
        slot = np.repeat(np.arange(len(own)), sizes[own])
        for x, start, width in zip(numbers, bins.start, bins.width, strict=True):
            code = slot * width + x
            for i, w in enumerate((*weights, None)):
                if not (known and i == 2):
                    out[i, own, start : start + width] = np.bincount(code, w, len(own) * width).reshape(len(own), width)
    return out


def slopes(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.exp(-raw)
    p += 1
    np.divide(1, p, out=p)
    gradient, hessian = p - label, weight * p
    gradient *= weight
    hessian *= np.subtract(1, p, out=p)
    return gradient, hessian


def losses(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * (np.logaddexp(0, raw) - label * raw)).sum())


class Patience:
    """Whether the validation loss has not improved for as many rounds as the settings allow."""

    def __init__(self, settings: Settings):
        self.settings, self.seen = settings, []

    def ends(self, loss: float) -> bool:
        self.seen.append(loss)
        rounds = self.settings.patience
        if not rounds or len(self.seen) <= rounds:
            return False
        return min(self.seen[-rounds:]) >= self.seen[-rounds - 1] - self.settings.tolerance


# --- model --------------------------------------------------------------------

def first_leaf(left: np.ndarray) -> np.ndarray:
    """Number of the lowest bit of each set: the exponent of that bit as a floating number."""
    lowest = np.negative(left)
    lowest &= left
    whole, bits, bias = (np.float32, 23, 127) if left.dtype == np.int32 else (np.float64, 52, 1023)
    out = lowest.astype(whole).view(np.int32 if left.dtype == np.int32 else np.int64)
    out >>= bits
    out -= bias
    return out


@dataclass
class BoostedTrees:
    """A fitted model: features, bins, log-odds of the training rows, trees as lists of nodes."""

    features: list[str]
    bins: Bins
    base: float
    trees: list[list[list]]

    def tables(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Per feature (bins, trees) bit sets, and (trees, leaves) values.

        Leaves are numbered from left to right, one bit each.  A split that sends a row right rules out the
        leaves on its left; the first leaf not ruled out by any split is the row's leaf.
        """
        few = all(sum(n[1] < 0 for n in nodes) <= 31 for nodes in self.trees)
        kind = np.int32 if few else np.uint64
        ruled = [np.full((w, len(self.trees)), -1 if few else np.iinfo(np.uint64).max, kind) for w in self.bins.width]
        values = np.zeros((len(self.trees), 64))
        for t, nodes in enumerate(self.trees):
            by_node, leaves = {n[0]: n for n in nodes}, []

            def walk(node, t=t, by_node=by_node, leaves=leaves):
                _, feature, cut, missing_left, value = by_node[node]
                if feature < 0:
                    values[t, len(leaves)] = value
                    leaves.append(node)
                    return
                first = len(leaves)
                walk(2 * node)
                left = kind(((1 << len(leaves)) - 1) ^ ((1 << first) - 1))
                right = np.arange(self.bins.width[feature]) > cut
                right[-1] = not missing_left
                ruled[feature][right, t] &= ~left
                walk(2 * node + 1)

            walk(1)
        return ruled, values

    def rounded(self, values: np.ndarray) -> tuple[np.ndarray, float]:
        """Values and base as multiples of the last bit of the largest possible sum, so that sums are exact in any order."""
        most = float(np.abs(values).max(1).sum()) + abs(self.base)
        unit = 2.0 ** (math.frexp(most)[1] - 52)
        return np.rint(values / unit) * unit, float(np.rint(self.base / unit) * unit)

    def scorer(self) -> Callable[[Sequence[np.ndarray]], np.ndarray]:
        """Function from feature columns to probabilities."""
        ruled, values = self.tables()
        values, base = self.rounded(values) if self.trees else (values, self.base)
        flat, first = values.ravel(), np.arange(len(self.trees), dtype=np.int32) * values.shape[1]

        def score(columns: Sequence[np.ndarray]) -> np.ndarray:
            numbers = self.bins.numbers(columns)
            out = np.full(numbers.shape[1], base)
            for k in range(0, len(out) if self.trees else 0, SCORED):
                own = numbers[:, k : k + SCORED]
                left = ruled[0].take(own[0], axis=0)
                for f in range(1, len(ruled)):
                    left &= ruled[f].take(own[f], axis=0)
                out[k : k + SCORED] += flat.take(first_leaf(left) + first).sum(1)
            return 1 / (1 + np.exp(-out))

        return score

    def moved_scorer(self) -> Callable[[np.ndarray, dict[int, np.ndarray]], tuple[np.ndarray, dict[int, np.ndarray]]]:
        """Function from (features, rows) bin numbers, and for some features (repeats, rows) numbers in place of their own,
        to the probabilities of the rows and, for each of those features, (repeats, rows) probabilities.

        The bit sets of all other features are ANDed once a row; only trees that split by the moved feature are read again,
        and only for rows whose number changes.  The sums are exact, so the results are those of ``scorer``.
        """
        ruled, values = self.tables()
        values, base = self.rounded(values) if self.trees else (values, self.base)
        flat, first = values.ravel(), np.arange(len(self.trees), dtype=np.int32) * values.shape[1]
        used = [np.flatnonzero((table != table.dtype.type(-1 if table.dtype == np.int32 else np.iinfo(np.uint64).max)).any(0)) for table in ruled]
        tight = [np.ascontiguousarray(table[:, t]) for table, t in zip(ruled, used, strict=True)]
        chance = lambda raw: 1 / (1 + np.exp(-raw))

        def score(numbers: np.ndarray, moved: dict[int, np.ndarray]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
            raw, out = np.full(numbers.shape[1], base), {f: np.full(to.shape, base) for f, to in moved.items()}
            for k in range(0, len(raw) if self.trees else 0, MOVED):
                own = numbers[:, k : k + MOVED]
                sets = [table.take(x, axis=0) for table, x in zip(ruled, own, strict=True)]
                after = sets[-1:]                     # of the last features, one more each time
                for x in reversed(sets[:-1]):
                    after.append(after[-1] & x)
                leaves = flat.take(first_leaf(after.pop()) + first)
                raw[k : k + MOVED] += leaves.sum(1)
                before = None
                for f, x in enumerate(sets):
                    behind = after.pop() if after else None
                    if f in moved:
                        to, now = moved[f][:, k : k + MOVED], raw[k : k + MOVED]
                        scores, t, (essay, row) = np.broadcast_to(now, to.shape).copy(), used[f], np.nonzero(to != own[f])
                        if len(t) and len(row):
                            left = tight[f].take(to[essay, row], axis=0)
                            others = before if behind is None else behind if before is None else before & behind
                            if others is not None:
                                left &= others.take(t, axis=1).take(row, axis=0)
                            kept = now - leaves[:, t].sum(1)
                            scores[essay, row] = kept.take(row) + flat.take(first_leaf(left) + first[t]).sum(1)
                        out[f][:, k : k + MOVED] = scores
                    before = x if before is None else before & x
            return chance(raw), {f: chance(x) for f, x in out.items()}

        return score

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of text; the model does not grow with the data."""
        text = json.dumps({"features": self.features, "edges": [e.tolist() for e in self.bins.edges], "base": self.base, "trees": self.trees})
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        given = json.loads(spark.read.parquet(path).first()["model"])
        return BoostedTrees(given["features"], Bins([np.array(e, np.float64) for e in given["edges"]]), given["base"], given["trees"])


def add_probability(df: DataFrame, model: BoostedTrees, score: str) -> DataFrame:
    """Probability of class 1; nulls and NaN are missing values.  Works on streams, row by row."""
    tell: list = []

    @F.pandas_udf("double")
    def probability(*columns: pd.Series) -> pd.Series:
        if not tell:
            tell.append(model.scorer())
        return pd.Series(tell[0]([c.to_numpy(np.float64, na_value=np.nan) for c in columns]))

    return df.withColumn(score, probability(*[F.col(f"`{f}`").cast("double") for f in model.features]))


# --- training -----------------------------------------------------------------

def _arrays(batch: pa.RecordBatch, bins: Bins) -> tuple[np.ndarray, ...]:
    """(bin numbers, label, weight, held back, raw) of a batch with the features first."""
    columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]
    n = len(bins.edges)
    return bins.numbers(columns[:n]), columns[n], columns[n + 1], columns[n + 2] > 0, columns[n + 3]


def grow(
    bins: Bins, settings: Settings, measure: Callable[[Tree], tuple[np.ndarray, float]], accept: Callable[[Tree], None]
) -> list[list[list]]:
    """Trees from sums: ``measure`` adds up all rows for the nodes a tree wants (and the loss of the rows held back
    before this tree), ``accept`` adds a finished tree to the scores of the rows."""
    stop, trees = Patience(settings), []
    while len(trees) < settings.max_iter:
        tree, first = Tree(bins, settings), True
        while tree.measured:
            sums, loss = measure(tree)
            if first and trees and stop.ends(loss):
                return trees
            first = False
            tree.absorb(sums)
        tree.finish()
        if tree.feature[1] < 0:
            break
        accept(tree)
        trees.append(tree.plain())
    return trees


def grow_in_one_task(rows: DataFrame, bins: Bins, settings: Settings) -> list[list[list]]:
    """Trees grown by one task that holds all (at most ONE_TASK) rows."""

    def run(batches: Iterator[pa.RecordBatch]):
        parts: list = [[], []]                   # rows held back are in no node
        for b in (b for b in batches if b.num_rows):
            numbers, label, weight, held, raw = _arrays(b, bins)
            for own, at in zip(parts, (~held, held)):
                own.append((numbers[:, at], label[at], weight[at], raw[at]))
        (numbers, *given, raw), (apart, *judged, raw_apart) = ([np.concatenate(p, axis=-1) for p in zip(*own, strict=True)] for own in parts)
        del parts
        codes = bins.codes(numbers) if len(raw) >= CODED_ROWS else None
        fixed = [side_by_side(x) for x in (numbers, codes) if x is not None]
        root = {1: np.arange(len(raw))}
        now = {"rows": root, "seen": None}

        def measure(tree: Tree) -> tuple[np.ndarray, float]:
            loss = 0.0
            if tree.open == [1]:
                now["slopes"], loss = slopes(raw, *given), losses(raw_apart, *judged)
                now["beside"] = [fixed[0], side_by_side(np.stack(now["slopes"])), *fixed[1:]]
            else:
                now["rows"] = tree.step_down(numbers, now["rows"])
            sums = level_sums(tree, numbers, now["rows"], *now["slopes"], codes, now["beside"], now["seen"])
            if now["seen"] is None:
                now["seen"] = sums[2, 0].copy()
            return sums, loss

        def accept(tree: Tree) -> None:
            # A node without a split in the end passes its value to all below it.
            more = np.empty(len(raw))
            for node, own in tree.step_down(numbers, now["rows"]).items():
                more[own] = tree.value[node]
            np.add(raw, more, out=raw)
            np.add(raw_apart, tree.values(apart), out=raw_apart)
            now["rows"] = root

        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(grow(bins, settings, measure, accept))])], names=["trees"])

    return json.loads(rows.coalesce(1).mapInArrow(run, "trees string").collect()[0]["trees"])


class Told(AccumulatorParam):
    """What each partition tells, once however often it is computed."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, value1: dict, value2: dict) -> dict:
        return value1 | value2


def grow_by_jobs(rows: DataFrame, bins: Bins, settings: Settings, parts: int) -> list[list[list]]:
    """Trees grown by one job a level over ``parts`` partitions of arrays; scores are checkpointed every KEEP_EVERY trees."""
    sc = rows.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(rows.sparkSession))
    shared = sc.broadcast(bins)

    def pack(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_arrays(b, shared.value))], pa.binary())], names=["part"])

    def together(packed):
        own = [pickle.loads(r[0]) for r in packed]
        if own:
            numbers, label, weight, held, raw = (np.concatenate(p, axis=-1) for p in zip(*own, strict=True))
            parts = [Part.of(np.ascontiguousarray(numbers[:, x]), label[x], weight[x], raw[:1].sum()) for x in (~held, held)]
            parts[0].seen = np.concatenate([np.bincount(x, minlength=w) for x, w in zip(parts[0].numbers, shared.value.width, strict=True)])
            yield from zip(*[p.pieces(-(-len(held) // PIECE)) for p in parts], strict=True)     # rows held back are in no node

    def kept(rdd: RDD) -> RDD:
        return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)    # one batch an item: ``zip`` adds no step

    def whole(items: Iterator[tuple]) -> list[Part]:
        """The rows that grow trees and those held back, of all pieces of a partition."""
        parts, raws = zip(*items, strict=True)
        return [Part.joined(p, r) for p, r in zip(zip(*parts, strict=True), zip(*raws, strict=True), strict=True)]

    def sums_of(tree: Tree, grown: Part, apart: Part) -> tuple[np.ndarray, np.ndarray, float]:
        sums = part_sums(tree, grown).reshape(3, -1)
        some = np.flatnonzero(sums[2])
        return some.astype(np.int32), sums[:, some], apart.losses() if tree.measured == [1] else 0.0

    # The rows never change, only their scores do.  Scores are in the order of the rows, so the order is fixed by a checkpoint
    # before there are any, and a lost partition is read from it.
    fixed = kept(rows.mapInArrow(pack, "part binary").repartition(parts).rdd.mapPartitions(together))
    fixed.checkpoint()
    filled = fixed.mapPartitions(lambda items: [1] if any(True for _ in items) else []).count()
    told = sc.accumulator({}, Told())
    state = {"scores": None, "trees": 0}

    def advance(tree: Tree | None) -> None:
        """Scores after one more tree, and by the way the sums of the root of the next one."""
        light, before, now = tree and tree.light(), state["scores"], state["trees"]

        def run(index, items):
            items = list(items)
            if not items:
                return
            own = whole(items)
            if light is not None:
                light.bins = shared.value
                own = [p.plus(light) for p in own]
            told.add({(now, index): sums_of(Tree(shared.value, settings), *own)})
            yield from zip(*[np.split(p.raw, np.cumsum([len(r[k]) for _, r in items])[:-1]) for k, p in enumerate(own)], strict=True)

        first = lambda parts: (parts, tuple(np.full(len(p.pair), p.raw) for p in parts))
        pairs = fixed.map(first) if before is None else fixed.zip(before)
        told.value.clear()
        state["scores"] = kept(pairs.mapPartitionsWithIndex(run, preservesPartitioning=True))
        if now and now % KEEP_EVERY == 0:
            state["scores"].checkpoint()
        state["scores"]._jrdd.count()
        if before is not None:
            before.unpersist()

    def measure(tree: Tree) -> tuple[np.ndarray, float]:
        light, found = tree.light(), [x for key, x in sorted(told.value.items()) if key[0] == state["trees"]]

        def run(items):
            light.bins = shared.value
            items = list(items)
            return [sums_of(light, *whole(items))] if items else []

        # A partition that was not computed by the task that counts it (after a lost one) has told nothing.
        if tree.measured != [1] or len(found) != filled:
            found = fixed.zip(state["scores"]).mapPartitions(run).collect()            # in the order of the partitions
        out, loss = np.zeros((3, len(tree.measured) * bins.total)), 0.0
        for some, sums, part_loss in found:
            out[:, some] += sums
            loss += part_loss
        return out.reshape(3, len(tree.measured), bins.total), loss

    def accept(tree: Tree) -> None:
        state["trees"] += 1
        advance(tree)

    try:
        advance(None)
        return grow(bins, settings, measure, accept)
    finally:
        for held in (fixed, state["scores"]):
            if held is not None:
                held.unpersist()
        shared.unpersist()


def fit_trees(
    rows: DataFrame, features: Sequence[str], label: str, weight: Column, settings: Settings = Settings(), seed: int = 42,
    max_bins: int = MAX_BINS, one_task: int = ONE_TASK,
) -> BoostedTrees:
    """Fit on all rows with a label (0 or 1).

    Of more than ``stop_from`` rows a part chosen by hash of the row is held back; training stops when its loss has
    not improved for ``patience`` rounds.  Up to ``one_task`` rows are kept in one task (see above), with the same trees.
    """
    if not 2 <= settings.max_leaves <= 64:
        raise ValueError("a tree has 2 to 64 leaves")
    names = [f"f{k}" for k in range(len(features))]
    table = rows.where(F.col(label).isNotNull()).select(
        *[as_double(f).alias(n) for f, n in zip(features, names, strict=True)], F.col(label).cast("double").alias("label"), weight.cast("double").alias("weight")
    )
    share = F.pmod(F.xxhash64(*names, "label", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    table = materialise(table.withColumn("share", share))
    n = table.count()
    if n == 0:
        raise ValueError("no labelled rows to train on")
    stops = settings.patience > 0 and n > settings.stop_from
    settings = settings if stops else Settings(**{**settings.__dict__, "patience": 0})
    held = (F.col("share") < (settings.held_back if stops else 0.0)).cast("double")
    table = table.withColumn("share", held).withColumnRenamed("share", "held")
    bins = find_bins(table.where("held = 0"), names, max_bins)
    ones, whole = table.where("held = 0").agg(F.sum(F.col("weight") * F.col("label")), F.sum("weight")).first()
    p = min(max(ones / whole, 1e-12), 1 - 1e-12)
    base = math.log(p / (1 - p))
    ready = table.withColumn("raw", F.lit(base))
    if n <= one_task:
        trees = grow_in_one_task(ready, bins, settings)
    else:
        cores = rows.sparkSession.sparkContext.defaultParallelism
        waves = -(-n // (cores * MOST_ROWS))
        trees = grow_by_jobs(ready, bins, settings, max(1, min(MOST_PARTS, cores * waves, n // PART_ROWS)))
    return BoostedTrees(list(features), bins, base, trees)
