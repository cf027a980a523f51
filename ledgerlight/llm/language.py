"""Language identification: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

Texts are read in segments of ``STEPS`` bytes, every one of them; each position gets the label
probabilities of both directions, and a text the mean over all its positions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm.texts import LOWER, own_names, remainder, slices, text_results

STEPS = 48
HIDDEN = 8
INPUTS = 8
BATCH = 192
ROUNDS = 500
SAMPLE_ROWS = 1_000          # documents of the fit, by hash order within each language, and at least one of each
PARTS = 64                   # of a language, in which its least hashes are found first
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True



class Network:
    """Weights by name; gates are stacked as update, reset, candidate; arrays are (units, columns)."""

    def __init__(self, labels: Sequence[str], seed: int = 5):
        self.labels = list(labels)
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-1]), shape).astype(np.float32)
        self.w = {"bytes": draw(INPUTS, 256) * 8, "out_bias": np.zeros((max(1, len(labels)), 1), np.float32)}
        for way in ("on", "back"):
            self.w |= {
                f"{way}_in": draw(3 * HIDDEN, INPUTS), f"{way}_bias": np.zeros((3 * HIDDEN, 1), np.float32),
                f"{way}_gates": draw(2 * HIDDEN, HIDDEN), f"{way}_next": draw(HIDDEN, HIDDEN),
                f"{way}_out": draw(max(1, len(labels)), HIDDEN),
            }

    def _walk(self, x: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden state at each position of x (steps, columns), in the order of the walk's direction."""
        w = self.w
        table = w[f"{way}_in"] @ w["bytes"] + w[f"{way}_bias"]
        gates, following = w[f"{way}_gates"], w[f"{way}_next"]
        h = np.zeros((HIDDEN, x.shape[1]), np.float32)
        out = np.empty((len(x), HIDDEN, x.shape[1]), np.float32)
        for t in range(len(x)) if way == "on" else range(len(x) - 1, -1, -1):
            given = np.take(table, x[t], axis=1)
            both = given[: 2 * HIDDEN]
            both += gates @ h
            both *= 0.5
            np.tanh(both, out=both)
            both *= 0.5
            both += 0.5
            update, reset = both[:HIDDEN], both[HIDDEN:]
            past = following @ h
            fresh = given[2 * HIDDEN :]
            fresh += reset * past
            np.tanh(fresh, out=fresh)
            if keep is not None:
                keep.append((t, h, update, reset, past, fresh))
            h = np.add(fresh, update * (h - fresh), out=out[t])
        return out

    def _probabilities(self, on: np.ndarray, back: np.ndarray) -> np.ndarray:
        """(steps, labels, columns)"""
        z = np.matmul(self.w["on_out"], on)
        z += np.matmul(self.w["back_out"], back)
        z += self.w["out_bias"]
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        return z

    def slopes(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss per position and its slopes; x, mask (steps, columns), label (columns)."""
        w, kept = self.w, {"on": [], "back": []}
        states = {way: self._walk(x, way, kept[way]) for way in kept}
        p = self._probabilities(states["on"], states["back"])
        columns, count = np.arange(x.shape[1]), mask.sum()
        loss = -float((np.log(p[:, label, columns] + 1e-9) * mask).sum() / count)
        p[:, label, columns] -= 1
        p *= (mask / count)[:, None, :]
        slope = {k: np.zeros_like(v) for k, v in w.items()}
        slope["out_bias"] += p.sum((0, 2))[:, None]
        for way in kept:
            slope[f"{way}_out"] += np.einsum("tkb,thb->kh", p, states[way])
            down = np.matmul(w[f"{way}_out"].T, p)
            carried = np.zeros((HIDDEN, x.shape[1]), np.float32)
            given = np.zeros((3 * HIDDEN, 256), np.float32)
            for t, h, update, reset, past, fresh in reversed(kept[way]):
                g = down[t] + carried
                d_fresh = g * (1 - update) * (1 - fresh**2)
                d_update = g * (h - fresh) * update * (1 - update)
                d_reset = d_fresh * past * reset * (1 - reset)
                d_past = d_fresh * reset
                d_gates = np.concatenate([d_update, d_reset])
                carried = g * update + w[f"{way}_gates"].T @ d_gates + w[f"{way}_next"].T @ d_past
                slope[f"{way}_gates"] += d_gates @ h.T
                slope[f"{way}_next"] += d_past @ h.T
                whole = np.concatenate([d_gates, d_fresh])
                slope[f"{way}_bias"] += whole.sum(1, keepdims=True)
                hot = np.zeros((x.shape[1], 256), np.float32)
                hot[columns, x[t]] = 1
                given += whole @ hot
            slope[f"{way}_in"] += given @ w["bytes"].T
            slope["bytes"] += w[f"{way}_in"].T @ given
        return loss, slope

    def fit(self, texts: Sequence[bytes], label: np.ndarray, rounds: int = ROUNDS, seed: int = 11) -> Network:
        """A batch draws every language equally often, of a language every text, of a text every segment."""
        if len(self.labels) < 2 or not len(texts):
            return self
        data = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        ends = np.cumsum([len(t) for t in texts])
        starts = np.concatenate([[0], ends[:-1]])
        rng = np.random.default_rng(seed)
        share = 1 / np.bincount(label, minlength=len(self.labels))[label]
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        for k in range(1, rounds + 1):
            own = rng.choice(len(texts), BATCH, p=share / share.sum())
            parts = -(-(ends[own] - starts[own]) // STEPS)
            at = starts[own] + STEPS * rng.integers(0, parts) + np.arange(STEPS)[:, None]
            inside = at < ends[own]
            x = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
            _, slope = self.slopes(x, inside.astype(np.float32), label[own])
            size = np.sqrt(sum(float((s**2).sum()) for s in slope.values()))
            rate = 0.02 * min(1, 2 * (1 - k / (rounds + 1)))
            for name, v in self.w.items():
                s = slope[name] * min(1, 1 / (size + 1e-9))
                first, second = state[name]
                first += 0.1 * (s - first)
                second += 0.001 * (s**2 - second)
                v -= rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        return self

    def tell(self, column: pa.Array) -> list:
        names: list[str] = []
        scores: list[float] = []
        for _, _, raw, offsets in slices(column):
            length = np.diff(offsets)
            if not self.labels:
                total = np.zeros((len(length), 1))
            else:
                total = self._totals(LOWER[raw], offsets, length)
            best = total.argmax(1)
            letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
            beyond = np.concatenate([[0], np.cumsum(raw >= 128)])
            for k in range(len(length)):
                a, b = offsets[k], offsets[k + 1]
                some = letters[b] > letters[a] or (beyond[b] > beyond[a] and any(map(str.isalpha, raw[a:b].tobytes().decode())))
                known = some and bool(self.labels)
                names.append(self.labels[best[k]] if known else UNKNOWN)
                scores.append(min(1.0, float(total[k, best[k]] / length[k])) if known else 0.0)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    def _totals(self, data: np.ndarray, offsets: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(texts, labels) sums of the probabilities of all positions."""
        parts = -(-length // STEPS)
        text = np.repeat(np.arange(len(length)), parts)
        starts = offsets[:-1][text] + STEPS * (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts))
        ends = offsets[1:][text]
        total = np.zeros((len(length), len(self.labels)))
        for k in range(0, len(text), 2048):
            at = starts[k : k + 2048] + np.arange(STEPS)[:, None]
            inside = at < ends[k : k + 2048]
            x = np.where(inside, data[np.minimum(at, max(0, len(data) - 1))], 0)
            p = self._probabilities(self._walk(x, "on"), self._walk(x, "back"))
            p *= inside[:, None, :]
            np.add.at(total, text[k : k + 2048], p.sum(0).T)
        return total


def fit_language(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", most: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Network:
    """Fit on documents with a language outside of the held-out fold; ``most`` rows bound the sample.

    The sample takes each language evenly, by hash order of id and text, and at least one row of each, so more
    languages than ``most`` make more rows.  Whole texts of these rows are drawn from; rows without
    text are not in it.  Rows that repeat id and text are one row of the fit.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang}`").cast("string").alias("_lang"), F.col(f"`{text}`").cast("string").alias("_text"))
    rows = rows.where(F.col("_lang").isNotNull() & (remainder("_id", FOLDS) != HELD_OUT) & (F.length("_text") > 0))
    rows = rows.withColumn("_hash", F.xxhash64("_id", "_text"))
    names = rows.select("_lang").distinct().count()
    share = max(1, most // max(1, names))
    # Ranks are cut in each task, then in parts of a language, then in the language: hashes only, texts stay where they are.
    least = rows.select("_lang", "_hash")
    for parts in (PARTS, 1):
        of_part = Window.partitionBy("_lang", F.pmod("_hash", F.lit(parts))).orderBy("_hash")
        least = least.withColumn("_place", F.row_number().over(of_part)).where(F.col("_place") <= share).drop("_place")
    last = least.groupBy("_lang").agg(F.max("_hash").alias("_last"))       # one row for each language
    chosen = rows.join(F.broadcast(last), "_lang").where("_hash <= _last").groupBy("_lang", "_hash").agg(F.min("_text").alias("_text"))
    got = chosen.toArrow().sort_by([("_lang", "ascending"), ("_hash", "ascending")])
    labels = sorted(set(got.column("_lang").to_pylist()))
    number = {name: k for k, name in enumerate(labels)}
    texts = [t.encode() for t in got.column("_text").to_pylist()]
    return Network(labels).fit(texts, np.array([number[name] for name in got.column("_lang").to_pylist()], np.int64), rounds)


@own_names("text")
def language_predictions(docs: DataFrame, network: Network, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns, lang_pred and score, the mean probability of the label over all positions.

    Null texts and texts without a letter are ``und`` with score 0, and all texts if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return text_results(docs, FIELDS, lambda: shared.value.tell, text, carry)
