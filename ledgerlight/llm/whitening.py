"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Three passes over the vectors: exact sums, the centred scatter, the whitened rows.  What tasks hand on is
added up by Spark, so the driver sees the sums of the dimensions and one scatter, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.texts import beside
from ledgerlight.session import materialise

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000      # entry c becomes floor(SCALE * c) + SHIFT
LARGEST = float(1 << 52)          # entries beyond it have no long
SWEEPS = 60
MADE = ("component", "n", "deviation", "whitened", "explained", "identity_error")
KINDS = (T.IntegerType(), T.LongType(), T.LongType(), *[T.DoubleType()] * 3)
_LOW = np.int64(0xFFFFFFFF)


@dataclass
class Whitening:
    """Of ``n`` fitted vectors: sums, unit components (dimensions x components), variances, sum of all variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole part goes first, in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of (n*x - sums)^2, and whether each fits a long.

        64-bit arithmetic is exact modulo 2^64, so a sum that fits comes out right whatever its terms did.
        """
        low = lambda v: np.int64((v + (1 << 63)) % (1 << 64) - (1 << 63))
        off = x * low(self.n) - np.array([low(s) for s in self.sums])
        size = np.square(self.centred(x) * float(self.n)).sum(1)
        return np.square(off).sum(1), size < float(1 << 63) * (1 - 1e-9)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Factor f (rows x rank) with f f' = a: lower triangular in the order of its pivots.

    The pivot is the largest remaining diagonal entry; the factor ends where that is lost in rounding.
    """
    size = len(a)
    rest = np.diag(a).astype(np.float64).copy()
    least = size * np.finfo(np.float64).eps * max(rest.max(initial=0.0), 0.0)
    factor = np.zeros((size, 0))
    open_rows = np.ones(size, bool)
    for _ in range(size):
        p = int(np.argmax(np.where(open_rows, rest, -1.0)))
        if not open_rows[p] or rest[p] <= least:
            break
        column = (a[:, p] - factor @ factor[p]) / np.sqrt(rest[p])
        column[~open_rows] = 0.0
        column[p] = np.sqrt(rest[p])
        factor = np.column_stack([factor, column])
        rest -= column**2
        open_rows[p] = False
    return factor


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit left singular vectors and squared singular values of ``factor``, largest first.

    Columns are rotated in pairs until all are orthogonal.  The pairs of a round have no column in common
    (a round-robin tournament), so a round is one array operation.
    """
    a = factor.copy()
    rank = a.shape[1]
    if rank == 0:
        return a, np.zeros(0)
    seats = np.arange(rank + rank % 2)
    half = len(seats) // 2
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(max(1, len(seats) - 1)):
            i, j = seats[:half], seats[half:][::-1]
            real = (i < rank) & (j < rank)
            i, j = i[real], j[real]
            x, y = a[:, i], a[:, j]
            p, q, g = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            angle = np.abs(g) / np.sqrt(np.maximum(p * q, np.finfo(np.float64).tiny))
            worst = max(worst, angle.max(initial=0.0))
            turn = angle > 1e-16
            z = (q - p) / np.where(turn, 2 * g, 1.0)
            t = np.where(turn, np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.sqrt(1 + z * z)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst < rank * np.finfo(np.float64).eps:
            break
    values = np.square(a).sum(0)
    order = np.argsort(-values, kind="stable")
    vectors = a[:, order] / np.sqrt(values[order])
    # Either sign is right; the largest entry is positive, so that reruns agree.
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(rank)])
    return vectors * sign, values[order]


def _longs(column: pa.Array, size: int) -> np.ndarray:
    """(rows, size) longs of a column of arrays of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(-1, size) * SCALE).astype(np.int64) + SHIFT


def _sound(vector: Column) -> Column:
    return F.forall(vector, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))   # NaN is above all numbers


def usable(vectors: DataFrame, vector: str, carry: Sequence[str]) -> tuple[DataFrame, int]:
    """(row, v) of the rows whose vector is sound and has the usual length; that length, 0 without any."""
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("_")).alias("row"), v.alias("v"))
    sound = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & _sound(F.col("v")))
    usual = sound.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = usual["size"] if usual else 0
    return sound.where(F.size("v") == size).select("row", F.col("v").cast("array<double>").alias("v")), size


def fit_whitening(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the column ``v`` of all ``rows`` (see ``usable``); None without rows."""
    if size == 0:
        return None

    def sums(batches):
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            x = _longs(b.column(0), size)
            n, high, low = n + len(x), high + (x >> np.int64(32)).sum(0), low + (x & _LOW).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(high), pa.array(low)], names=["k", "n", "high", "low"]
        )

    # Sums as decimals: no number of rows overflows them.
    per_task = rows.select("v").mapInArrow(sums, "k long, n long, high long, low long")
    added = per_task.groupBy("k").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")])
    totals = sorted(added.collect())
    n = int(totals[0]["n"])
    if n == 0:
        return None
    whole = lambda v: int(Decimal(v))
    model = Whitening(n, [(whole(t["high"]) << 32) + whole(t["low"]) for t in totals], np.zeros((size, 0)), np.zeros(0), 0.0)
    upper = np.triu_indices(size)

    def scatter(batches):
        total = np.zeros((size, size))
        for b in batches:
            y = model.centred(_longs(b.column(0), size))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["k", "s"])

    products = rows.select("v").mapInArrow(scatter, "k long, s double").groupBy("k").agg(F.sum("s").alias("s"))
    a = np.zeros((size, size))
    a[upper] = [r["s"] for r in sorted(products.collect())]
    a += np.triu(a, 1).T
    vectors, values = one_sided_jacobi(pivoted_cholesky(a))
    return Whitening(n, model.sums, vectors[:, :components], values[:components] / n, float(np.trace(a)) / n)


def whitened_rows(rows: DataFrame, model: Whitening) -> DataFrame:
    """(row, deviation, whitened array) of ``rows``, not yet written."""
    size, turned = len(model.sums), model.components / np.sqrt(model.variances)

    def run(batches):
        for b in batches:
            x = _longs(b.column(1), size)
            deviation, fits = model.deviations(x)
            flat = (model.centred(x) @ turned).ravel()
            each = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * turned.shape[1], pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviation, mask=~fits), each], names=["row", "deviation", "w"])

    schema = T.StructType([rows.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("w", T.ArrayType(T.DoubleType()))])
    return rows.select("row", "v").mapInArrow(run, schema)


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = white.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{k}") for k, (i, j) in enumerate(pairs)]).first()
    return max(abs(found[k] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(vectors: DataFrame, vector: str = "embedding", carry: Sequence[str] | None = None, components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: the carried columns (all but the vector, if not named) and ``MADE``.

    Rows go whose vector is null, empty, or holds a null, a non-finite entry or one of 2^52 and more.
    Vectors of several lengths have no common covariance: the commonest length stays (of equal counts the
    longest).  Components beyond the rank of the data are not there, so a table without rows, of one row or
    of equal rows returns none.  Repeated rows count each; ids may be null.  A deviation beyond a long is
    null.  A carried column with the name of a result column is replaced.
    """
    kept = [c for c in beside(vectors, MADE, carry) if carry is not None or c != vector]
    rows, size = usable(vectors, vector, kept)
    model = fit_whitening(rows, size, components)
    columns = [F.col("row")[c].alias(c) for c in kept]
    if model is None or len(model.variances) == 0:
        schema = vectors.select(*[F.col(f"`{c}`") for c in kept]).schema
        for name, kind in zip(MADE, KINDS, strict=True):
            schema = schema.add(name, kind)
        return vectors.sparkSession.createDataFrame([], schema)
    white = materialise(whitened_rows(rows, model))
    error = identity_error(white, len(model.variances))
    shares = F.array(*[F.lit(float(v / model.total)) for v in model.variances])
    each = white.select("row", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        *columns, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
