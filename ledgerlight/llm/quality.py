"""Quality classifier: a factorisation machine over hashed words, structure and size of a text.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): all pairs of
features, in time linear in the features a text has.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.texts import LOWER, NOT_SPACE, SPACE, Words, mix, own_names, remainder, slices, text_results

HASHED = 1 << 13
FACTORS = 8
SAMPLE_ROWS = 8_000          # labelled documents of the fit, by hash order
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
_KIND = np.zeros(256, np.uint8)          # 1 capital, 2 digit, 3 other visible ASCII, 4 beyond ASCII, 5 white space
_KIND[33:127] = 3
_KIND[65:91], _KIND[48:58], _KIND[97:123], _KIND[128:] = 1, 2, 0, 4
_KIND[SPACE] = 5
STRUCTURE = 14


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the hashed words, and the structure and size of each text."""
    words = Words(LOWER[data], offsets, NOT_SPACE)
    texts, n = len(offsets) - 1, np.maximum(words.counts, 1)
    slot = (words.hashes() & np.uint64(HASHED - 1)).astype(np.int64)
    pair, count = np.unique(words.text.astype(np.int64) * HASHED + slot, return_counts=True)
    text, feature = pair // HASHED, pair % HASHED
    value = np.sqrt(count / n[text])

    size = np.maximum(np.diff(offsets), 1)
    kinds = _KIND[data]
    share = [_sums(kinds == k, offsets) / size for k in range(1, 6)]
    lines = Words(data, offsets, _NOT_BREAK)
    line_hash = lines.hashes()
    known = np.unique(line_hash ^ mix(lines.text.astype(np.uint64)), return_index=True)[1]
    distinct_lines = np.bincount(lines.text[known], minlength=texts)
    length = (words.ends - words.starts).astype(np.float64)
    mean = _sums(length, words.first) / n
    shapes = _KIND[data[words.starts]] if len(words) else np.zeros(0, np.uint8)
    tails = _KIND[data[words.ends - 1]] if len(words) else np.zeros(0, np.uint8)
    structure = np.column_stack([
        *share,
        np.log1p(np.diff(offsets)) / 10, np.log1p(words.counts) / 8, mean / 10,
        np.bincount(text, minlength=texts) / n,                       # distinct words
        distinct_lines / np.maximum(lines.counts, 1),                 # distinct lines
        np.log1p(lines.counts) / 6,
        _sums(shapes == 1, words.first) / n,                          # words that begin with a capital
        _sums(tails == 3, words.first) / n,                           # words that end with a sign
        _sums((tails == 3) & (shapes == 3) & (length == 1), words.first) / n,    # signs that stand alone
    ])
    return text, feature, value, structure


_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[[10, 13]] = False


class FactorMachine:
    def __init__(self, seed: int = 7):
        self.rng = np.random.default_rng(seed)
        size = HASHED + STRUCTURE
        self.bias, self.linear = 0.0, np.zeros(size)
        self.factors = self.rng.normal(0, 0.05, (size, FACTORS))
        self.centre, self.scale = np.zeros(STRUCTURE), np.ones(STRUCTURE)

    def _sums(self, n: int, text, feature, value, dense):
        """Margin and the factor sums of each text."""
        weight = self.linear[feature] * value
        margin = self.bias + np.bincount(text, weight, n) + dense @ self.linear[HASHED:]
        one = self.factors[feature] * value[:, None]
        sums = dense @ self.factors[HASHED:]
        squares = (dense**2) @ (self.factors[HASHED:] ** 2)
        if len(text):
            have, at = np.unique(text, return_index=True)
            sums[have] += np.add.reduceat(one, at, axis=0)
            squares[have] += np.add.reduceat(one**2, at, axis=0)
        return margin + 0.5 * (sums**2 - squares).sum(1), sums

    def _dense(self, structure: np.ndarray) -> np.ndarray:
        return np.clip((structure - self.centre) / self.scale, -4, 4) / np.sqrt(STRUCTURE)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 30, batch: int = 256) -> FactorMachine:
        """rows: features, values and structure of each text.  Adam on the log loss, classes as they are."""
        if not len(rows):
            return self
        structure = np.stack([r[2] for r in rows])
        self.centre, self.scale = structure.mean(0), structure.std(0) + 1e-3
        rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(rate / (1 - rate)))
        state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("linear", self.linear), ("factors", self.factors), ("bias", np.zeros(1)))}
        step = 0
        for _ in range(epochs):
            order = self.rng.permutation(len(rows))
            for k in range(0, len(rows), batch):
                own = order[k : k + batch]
                n, y = len(own), labels[own]
                text = np.repeat(np.arange(n), [len(rows[i][0]) for i in own])
                feature = np.concatenate([rows[i][0] for i in own])
                value = np.concatenate([rows[i][1] for i in own])
                dense = self._dense(structure[own])
                margin, sums = self._sums(n, text, feature, value, dense)
                off = (1 / (1 + np.exp(-margin)) - y) / n
                push = off[text] * value
                linear = np.concatenate([np.bincount(feature, push, HASHED), off @ dense]) + 1e-5 * self.linear
                pull = push[:, None] * (sums[text] - self.factors[feature] * value[:, None])
                factors = np.empty_like(self.factors)
                for f in range(FACTORS):
                    factors[:HASHED, f] = np.bincount(feature, pull[:, f], HASHED)
                factors[HASHED:] = dense.T @ (off[:, None] * sums) - ((dense**2).T @ off)[:, None] * self.factors[HASHED:]
                factors += 1e-4 * self.factors
                step += 1
                bias = np.array([self.bias])
                for name, now, slope in (("linear", self.linear, linear), ("factors", self.factors, factors), ("bias", bias, np.array([off.sum()]))):
                    m, v = state[name]
                    m += 0.1 * (slope - m)
                    v += 0.01 * (slope**2 - v)
                    now -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
                self.bias = float(bias[0])
        return self

    def score(self, column: pa.Array, threshold: float) -> list:
        out = []
        for _, _, data, offsets in slices(column):
            text, feature, value, structure = features(data, offsets)
            margin, _ = self._sums(len(offsets) - 1, text, feature, value, self._dense(structure))
            out.append(1 / (1 + np.exp(-np.clip(margin, -40, 40))))
        score = np.concatenate(out) if out else np.zeros(0)
        return [score, (score >= threshold).astype(np.int32)]


_SAMPLE = [
    T.StructField("feature", T.ArrayType(T.IntegerType(), False)), T.StructField("value", T.ArrayType(T.FloatType(), False)),
    T.StructField("structure", T.ArrayType(T.DoubleType(), False)),
]


def _rows(column: pa.Array) -> list:
    out: tuple[list, list, list] = ([], [], [])
    for _, _, data, offsets in slices(column):
        text, feature, value, structure = features(data, offsets)
        cuts = np.searchsorted(text, np.arange(1, len(offsets) - 1))
        out[0].extend(np.split(feature.astype(np.int32), cuts))
        out[1].extend(np.split(value.astype(np.float32), cuts))
        out[2].extend(structure)
    return [pa.array(out[0], pa.list_(pa.int32())), pa.array(out[1], pa.list_(pa.float32())), pa.array(out[2], pa.list_(pa.float64()))]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, where, most: int, id_col: str, text: str) -> DataFrame:
    """(id, label, text) of at most ``most`` labelled ids that pass ``where``, in hash order.

    The chosen ids are bounded by the parameter, so they are broadcast and the corpus isn't shuffled.
    """
    ids = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("double").alias("_label"))
    ids = ids.where(F.col("_label").isNotNull() & F.col("_id").isNotNull() & where("_id"))
    ids = ids.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("text")).join(F.broadcast(ids), "_id")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", most: int = SAMPLE_ROWS) -> FactorMachine:
    """Fit on labelled rows outside of the held-out fold; ``most`` bounds them.  Without any, every score is 1/2."""
    train = labelled_sample(docs, labels, label, lambda c: remainder(c, FOLDS) != HELD_OUT, most, id_col, text)
    rows = text_results(train, _SAMPLE, lambda: _rows, carry=["_id", "_label"]).toArrow()
    order = np.argsort(rows.column("_id").to_numpy(), kind="stable")
    feature, value, structure = (_parts(rows.column(c)) for c in ("feature", "value", "structure"))
    sample = [(feature[i], value[i], structure[i]) for i in order]
    return FactorMachine().fit(sample, rows.column("_label").to_numpy()[order])


def _parts(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Arrays of the rows of a list column, as views of its buffers: no object per value."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        values, offsets = chunk.flatten().to_numpy(), chunk.offsets.to_numpy()
        out.extend(values[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:], strict=True))
    return out


@own_names("text")
def quality_scores(
    docs: DataFrame, model: FactorMachine, threshold: float = THRESHOLD, text: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """The carried columns, score (label 1 likelier when higher) and predicted.

    Only the text is read.  Null and empty texts have no words and the structure of an empty text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return text_results(docs, FIELDS, lambda: lambda column: shared.value.score(column, threshold), text, carry)
