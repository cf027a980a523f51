"""Texts of an Arrow column as byte arrays: slices of bounded size, word bounds and word hashes.

Words are found on UTF-8 bytes with numpy, so a task never loops over characters.  Arrays per
slice take about 40 bytes for each byte of text; a slice holds ``SLICE_BYTES`` or one longer text.
"""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)          # digits, small letters and everything beyond ASCII
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind][:n]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; a null counts as empty."""
    a = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(a):
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(a))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class Words:
    """Words of the texts of one slice: byte bounds, text number, words per text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        member = inside[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = member[:-1]
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = member[1:]
        self.starts = np.flatnonzero(member & (~before | cut[:-1]))
        self.ends = np.flatnonzero(member & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)      # first word of each text
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial by prefix sums, its bits spread."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * _power("down", _INVERSE, n + 1)[self.starts]
        return mix(raw ^ (self.ends - self.starts).astype(np.uint64))

    def runs(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``length`` words inside one text."""
        total = len(self) - length + 1
        if total <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:total] == self.text[length - 1 :])
        value = np.zeros(len(at), np.uint64)
        for k in range(length):
            value = value * _BASE + hashes[at + k]
        return at, mix(value)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def beside(docs: DataFrame, made: Sequence[str], carry: Sequence[str] | None = None) -> list[str]:
    """Columns to hand on: ``carry`` or all, without those whose name a result column takes."""
    taken = {m.lower() for m in made}
    return [c for c in (docs.columns if carry is None else carry) if c.lower() not in taken]


def own_names(*parameters: str):
    """For operators on a table: its columns carry neutral names inside, so no name of a helper column can clash.

    ``parameters`` name the arguments that hold column names; ``carry`` is one as well.  Afterwards the columns have
    their names again, but for those that a result column replaces.
    """

    def wrap(operator):
        signature = inspect.signature(operator)

        @functools.wraps(operator)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            given = signature.bind(docs, *args, **kwargs)
            given.apply_defaults()
            inner = {c: f"in{k}_" for k, c in enumerate(docs.columns)}
            folded = {c.lower(): i for c, i in inner.items()} | inner
            name = lambda c: folded.get(c, folded.get(c.lower(), c))
            for p in parameters:
                given.arguments[p] = name(given.arguments[p])
            if given.arguments.get("carry") is not None:
                given.arguments["carry"] = [name(c) for c in given.arguments["carry"]]
            first = next(iter(signature.parameters))
            given.arguments[first] = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in inner.items()])
            out = operator(*given.args, **given.kwargs)
            outer = {i: c for c, i in inner.items()}
            made = {c.lower() for c in out.columns if c not in outer}
            return out.select(*[F.col(f"`{c}`").alias(outer.get(c, c)) for c in out.columns if c not in outer or outer[c].lower() not in made])

        return run

    return wrap


def text_results(
    docs: DataFrame,
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[pa.Array], list]],
    text: str = "text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The carried columns and, per row, what the function built by ``make`` says of its text.

    ``make`` runs once per task.  A carried column with the name of a result column is dropped.
    """
    kept = beside(docs, [f.name for f in fields], carry)
    columns = [F.col(f"`{c}`") for c in kept]
    frame = docs.select(*columns, F.col(f"`{text}`").cast("string").alias("_text_in"))
    schema = T.StructType([*frame.schema.fields[:-1], *fields])

    def run(batches):
        tell = make()
        for batch in batches:
            if batch.num_rows:
                values = tell(batch.column(batch.num_columns - 1))
                values = [v if isinstance(v, pa.Array) else pa.array(v) for v in values]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(len(kept))] + values, names=[f.name for f in schema]
                )

    return frame.mapInArrow(run, schema)


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor
