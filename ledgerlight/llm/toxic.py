"""Toxicity: a support vector machine over a subsequence string kernel with Nystroem landmarks.

The kernel counts common subsequences of three letters, gaps weighing less, so letters that were
inserted or left out keep most of the similarity; it is divided by what words of those lengths have.  A text is a bag of units: words without signs at their ends,
words without the signs inside of them, and runs of single letters joined.  Its margin is that of its
worst unit; labels belong to whole texts, so the machine learns which unit speaks for a text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlight.llm.quality import labelled_sample
from ledgerlight.llm.texts import ALNUM, LOWER, NOT_SPACE, Words, own_names, remainder, slices, text_results

ORDER, DECAY = 3, 0.7        # letters of a subsequence; weight of each letter it spans
SPAN = 7                     # letters that a subsequence spans at most
BEGIN, END = b"\1", b"\2"
LANDMARKS = 64
ALIKE = 0.8                  # landmarks of one side are no closer to each other
SAMPLE_ROWS = 5_000          # labelled documents of the fit, by hash order
LONGEST, STRIDE = 32, 16     # longer units are cut into windows that overlap
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
MEMO = 1 << 20               # units whose margins a task remembers
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def places(n: int) -> Iterator[tuple[int, int, int]]:
    """Places of the subsequences of a word of ``n`` letters that span no more than SPAN of them."""
    for i in range(n - 2):
        for k in range(i + 2, min(n, i + SPAN)):
            for j in range(i + 1, k):
                yield i, j, k


@cache
def norm(n: int) -> float:
    """Length of the kernel's vector of a word of ``n`` different letters."""
    return float(np.sqrt(sum(DECAY ** (2 * (k - i + 1)) for i, _, k in places(n)))) or 1.0


class Features:
    """Kernel values against landmarks as weights of their subsequences of three letters."""

    def __init__(self, landmarks: Sequence[bytes]):
        marked = [BEGIN + w + END for w in landmarks]
        letters = sorted(set(b"".join(marked)))
        self.letter = np.zeros(256, np.int32)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.side = len(letters) + 1
        self.table = np.zeros((self.side**3, len(marked)), np.float32)
        for column, word in enumerate(marked):
            code = self.letter[np.frombuffer(word, np.uint8)].tolist()
            for i, j, k in places(len(code)):
                at = (code[i] * self.side + code[j]) * self.side + code[k]
                self.table[at, column] += DECAY ** (k - i + 1) / norm(len(code))

    def sums(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """(units, landmarks) kernel values, or their weighted sums (units,); units of one length at a time."""
        table = self.table if weights is None else (self.table @ weights).astype(np.float32)
        out = np.zeros((len(starts), *table.shape[1:]), np.float32)
        block = 4096 if weights is not None else 256
        for n in np.unique(size):
            every = np.flatnonzero(size == n) if n >= 3 else ()
            for k in range(0, len(every), block):
                at = every[k : k + block]
                words = np.empty((n + 2, len(at)), np.uint8)
                words[0], words[-1] = ord(BEGIN), ord(END)
                words[1:-1] = data[starts[at] + np.arange(n)[:, None]]
                code = self.letter[words]
                first, second = code * self.side**2, code * self.side
                total = np.zeros((len(at), *table.shape[1:]), np.float32)
                for i, j, m in places(n + 2):
                    total += np.float32(DECAY ** (m - i + 1)) * table[first[i] + second[j] + code[m]]
                out[at] = total / np.float32(norm(n + 2))
        return out


def similarity(words: Sequence[bytes], landmarks: Sequence[bytes]) -> np.ndarray:
    """(words, landmarks) kernel values; 0 where a word has fewer than three letters."""
    return Features(landmarks).sums(*_packed(words))


class Units:
    """Units of the texts of one slice: text, hash, and the bytes on demand."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        words = Words(LOWER[raw], offsets, NOT_SPACE)
        places = np.flatnonzero(ALNUM[words.data])
        extra: list[tuple[int, bytes]] = []
        if len(places) and len(words):
            low = np.searchsorted(places, words.starts)
            high = np.searchsorted(places, words.ends)
            some = high > low
            words.starts, words.ends, words.text = places[low[some]], places[high[some] - 1] + 1, words.text[some]
            length, letters = words.ends - words.starts, (high - low)[some]
            for i in np.flatnonzero(length > letters):                       # signs inside
                own = words.data[words.starts[i] : words.ends[i]]
                extra.append((int(words.text[i]), own[ALNUM[own]].tobytes()))
            single = np.concatenate([[False], length == 1, [False]])
            for a, b in zip(np.flatnonzero(single[1:] & ~single[:-1]), np.flatnonzero(~single[1:] & single[:-1]), strict=True):
                for k in range(a, b):                                        # runs of single letters, per text
                    if b - a >= ORDER and (k == a or words.text[k] != words.text[k - 1]):
                        end = a + int(np.searchsorted(words.text[a:b], words.text[k], "right"))
                        extra.append((int(words.text[k]), words.data[words.starts[k:end]].tobytes()))
            long = np.flatnonzero(length > LONGEST)
            extra += [(int(words.text[i]), words.word(i)) for i in long]
            fit = np.flatnonzero((length >= ORDER) & (length <= LONGEST))
            words.starts, words.ends, words.text = words.starts[fit], words.ends[fit], words.text[fit]
        else:
            words.starts = words.ends = words.text = np.zeros(0, np.int64)
        self.words = words
        self.extra = [(t, w[k : k + LONGEST]) for t, w in extra for k in range(0, max(1, len(w) - LONGEST + STRIDE), STRIDE) if len(w) >= ORDER]

    def distinct(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct units of the slice; text and unit number of every occurrence."""
        _, first, number = np.unique(self.words.hashes(), return_index=True, return_inverse=True)
        units = [self.words.word(i) for i in first]
        known = {}
        more = [known.setdefault(w, len(units) + len(known)) for _, w in self.extra]
        text = np.concatenate([self.words.text, np.array([t for t, _ in self.extra], np.int64)])
        return units + list(known), text, np.concatenate([number, np.array(more, np.int64)])


def _packed(units: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One array of bytes, first byte and length of each unit."""
    size = np.array([len(w) for w in units], np.int64)
    return np.frombuffer(b"".join(units), np.uint8), np.cumsum(size) - size, size


class StringMachine:
    """Landmarks, their weights, and the line that turns a margin into a probability.

    The weighted sum of kernel values against the landmarks is one linear function of a unit's
    subsequences, so a task sums the weights of subsequences instead of meeting every landmark.
    """

    def __init__(self):
        self.landmarks: list[bytes] = []
        self.bias = 0.0
        self.slope, self.shift = 1.0, -20.0          # of the logistic curve; without training every score is near 0
        self.features, self.weights = Features([]), np.zeros(0)

    def margins(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.features.sums(data, starts, size, self.weights).astype(np.float64) + self.bias if self.landmarks else np.full(len(starts), self.bias)

    def fit(self, bags: list[list[bytes]], labels: np.ndarray, seed: int = 3) -> StringMachine:
        toxic = [b for b, y in zip(bags, labels, strict=True) if y > 0]
        clean = [b for b, y in zip(bags, labels, strict=True) if y <= 0]
        rate = len(toxic) / max(1, len(bags))
        if not toxic or not clean:
            self.shift = 20.0 if toxic else -20.0
            return self
        bad, good = Counter(w for b in toxic for w in b), Counter(w for b in clean for w in b)

        def lean(w: bytes) -> float:
            """How far the share of toxic texts among those with the unit exceeds its mean, in deviations."""
            n = bad[w] + good[w]
            return (bad[w] - n * rate) / np.sqrt(n * rate * (1 - rate) + 1)

        order = sorted(bad, key=lambda w: (-lean(w), w))
        common = sorted(good, key=lambda w: (-good[w], w))
        self.landmarks = _apart(order[: 40 * LANDMARKS], LANDMARKS * 3 // 4)
        self.landmarks += [w for w in _apart(common[: 4 * LANDMARKS], LANDMARKS // 4) if w not in self.landmarks]
        if not self.landmarks:
            return self
        rng = np.random.default_rng(seed)
        witness = [max(b, key=lambda w: (lean(w), w)) for b in toxic if b]
        pool = sorted(good)
        against = {pool[i] for i in rng.choice(len(pool), min(len(pool), 4000), replace=False)} if pool else set()
        self.features = Features(self.landmarks)
        inner = similarity(self.landmarks, self.landmarks).astype(np.float64)
        inner = (inner + inner.T) / 2
        values, vectors = np.linalg.eigh(inner + 1e-6 * np.eye(len(inner)))
        root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T       # of the inverse: the Nystroem map
        seen = sorted(bad.keys() | good.keys())
        place = {w: i for i, w in enumerate(seen)}
        packed = _packed(seen)
        for _ in range(4):
            speaks = witness + [_inserted(w, rng) for w in witness for _ in range(2)]
            rows = speaks + sorted(against)
            sides = np.concatenate([np.ones(len(speaks)), -np.ones(len(against))])
            weights, self.bias = _machine(self.features.sums(*_packed(rows)) @ root, sides)
            self.weights = root @ weights
            margin = self.margins(*packed)
            # Of each toxic text the unit that speaks most for it, of clean texts the worst units.
            witness = [max(b, key=lambda w: (margin[place[w]], w)) for b in toxic if b]
            against |= set(sorted(pool, key=lambda w: (-margin[place[w]], w))[:1000])
        top = np.array([max((margin[place[w]] for w in b), default=self.bias) for b in bags])
        self.slope, self.shift = _curve(top, np.asarray(labels) > 0)
        return self

    def scorer(self, threshold: float):
        known, value = np.zeros(0, np.uint64), np.zeros(0)

        def tell(column: pa.Array) -> list:
            nonlocal known, value
            out = []
            for _, _, raw, offsets in slices(column):
                units = Units(raw, offsets)
                texts = len(offsets) - 1
                most = np.full(texts, self.bias)
                hashes, first, number = np.unique(units.words.hashes(), return_index=True, return_inverse=True)
                at = np.searchsorted(known, hashes)
                old = (at < len(known)) & (known[np.minimum(at, max(0, len(known) - 1))] == hashes) if len(known) else np.zeros(len(hashes), bool)
                margin = np.empty(len(hashes))
                margin[old] = value[at[old]]
                new = first[~old]
                margin[~old] = self.margins(units.words.data, units.words.starts[new], (units.words.ends - units.words.starts)[new])
                if len(known) > MEMO:
                    known, value = known[:0], value[:0]
                merged, where = np.unique(np.concatenate([known, hashes]), return_index=True)
                known, value = merged, np.concatenate([value, margin])[where]
                np.maximum.at(most, units.words.text, margin[number])
                if units.extra:
                    more = self.margins(*_packed([w for _, w in units.extra]))
                    np.maximum.at(most, [t for t, _ in units.extra], more)
                out.append(1 / (1 + np.exp(-np.clip(self.slope * most + self.shift, -40, 40))))
            score = np.concatenate(out) if out else np.zeros(0)
            return [score, (score >= threshold).astype(np.int32)]

        return tell


def _apart(words: list[bytes], most: int) -> list[bytes]:
    """The first of the words, each no closer than ALIKE to one taken before."""
    taken: list[bytes] = []
    nearest = np.zeros(len(words))
    packed = _packed(words)
    for i, w in enumerate(words):
        if nearest[i] < ALIKE and len(taken) < most:
            taken.append(w)
            nearest = np.maximum(nearest, Features([w]).sums(*packed)[:, 0])
    return taken


def _inserted(word: bytes, rng: np.random.Generator) -> bytes:
    """The word with a letter put into it, half of the time one that stands beside it."""
    at = int(rng.integers(1, max(2, len(word))))
    letter = word[at - 1 : at] if rng.random() < 0.5 else bytes([int(rng.integers(97, 123))])
    return word[:at] + letter + word[at:]


def _machine(rows: np.ndarray, sides: np.ndarray, keep: float = 1e-3, steps: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine on the squared hinge loss by Newton steps, both classes of equal weight."""
    x = np.column_stack([rows, np.ones(len(rows))])
    weight = np.where(sides > 0, 0.5 / max(1, (sides > 0).sum()), 0.5 / max(1, (sides < 0).sum()))
    w = np.zeros(x.shape[1])
    ridge = np.append(np.full(rows.shape[1], keep), 1e-6)
    for _ in range(steps):
        short = 1 - sides * (x @ w)
        on = short > 0
        slope = ridge * w - x[on].T @ (weight[on] * sides[on] * short[on])
        step = np.linalg.solve(x[on].T @ (weight[on, None] * x[on]) + np.diag(ridge), slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def _curve(margin: np.ndarray, label: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Logistic curve through margins, with targets a little inside of 0 and 1."""
    up, down = label.sum(), (~label).sum()
    target = np.where(label, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


_BAG = [T.StructField("units", T.ArrayType(T.BinaryType(), False))]


def _bags(column: pa.Array) -> list:
    out: list[list[bytes]] = []
    for first, end, raw, offsets in slices(column):
        units, text, number = Units(raw, offsets).distinct()
        own: list[set[bytes]] = [set() for _ in range(end - first)]
        for t, n in zip(text.tolist(), number.tolist(), strict=True):
            own[t].add(units[n])
        out.extend(sorted(o) for o in own)
    return [pa.array(out, pa.list_(pa.binary()))]


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text", most: int = SAMPLE_ROWS) -> StringMachine:
    """Fit on labelled rows outside of the held-out fold; ``most`` bounds them.  Without toxic ones scores are near 0."""
    train = labelled_sample(docs, labels, label, lambda c: remainder(c, FOLDS) != HELD_OUT, most, id_col, text)
    rows = text_results(train, _BAG, lambda: _bags, carry=["_id", "_label"]).toArrow().sort_by("_id")
    return StringMachine().fit(rows.column("units").to_pylist(), rows.column("_label").to_numpy())


@own_names("text")
def toxicity_scores(
    docs: DataFrame, machine: StringMachine, threshold: float = THRESHOLD, text: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """The carried columns, score (label 1 likelier when higher) and predicted.

    Only the text is read.  A text without units of three letters (null, empty, signs only) has the
    margin of a unit without any similarity.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return text_results(docs, FIELDS, lambda: shared.value.scorer(threshold), text, carry)
