"""HyperMinHash of word shingles: per bucket the leading zeros of the least hash and bits after its first one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerlight.llm.texts import LOWER, NOT_SPACE, Words, mix, slices

SHINGLE = 4                   # words, where nothing else is asked for
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND = 4                      # registers of 16 bits to a band: a band is one 64-bit value
BANDS = BUCKETS // BAND
EMPTY = 0xFFFF
#: Of the expected number of equal registers by chance, from the HyperMinHash paper.  Fixed value.
CHANCE = 0.169919487159739093975315012348
_LOW = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; texts of fewer words have one shingle of all of them."""
    words = Words(LOWER[data], offsets, NOT_SPACE)
    hashes = words.hashes()
    at, value = words.runs(hashes, shingle)
    cuts = np.searchsorted(words.text[at], np.arange(len(offsets)))
    sets = []
    for k in range(len(offsets) - 1):
        if words.counts[k] >= shingle:
            sets.append(np.unique(value[cuts[k] : cuts[k + 1]]))
        else:
            whole = np.uint64(words.counts[k])
            for h in hashes[words.first[k] : words.first[k + 1]]:
                whole = mix(np.array([whole ^ h]))[0]
            sets.append(np.array([whole][: min(1, words.counts[k])], np.uint64))
    return sets


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, BUCKETS) registers: leading zeros above the mantissa bits, EMPTY where a bucket has no hash."""
    least = np.zeros((len(sets), BUCKETS), np.uint64)
    some = np.zeros((len(sets), BUCKETS), bool)
    for k, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, _LOW)
            some[k] = np.diff(np.append(at, len(s))) > 0
            least[k] = s[np.minimum(at, len(s) - 1)]
    rest = ((least << np.uint64(BUCKET_BITS)) >> np.uint64(11)).astype(np.float64)      # 53 bits, exact as double
    part, exponent = np.frexp(rest)
    zeros = 53 - exponent
    mantissa = np.where(rest > 0, np.floor((2 * part - 1) * (1 << MANTISSA_BITS)), 0)
    value = (zeros.astype(np.int64) << MANTISSA_BITS) + mantissa.astype(np.int64)
    return np.where(some, value, EMPTY).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, less the equal registers that chance explains."""
    either = ((a != EMPTY) | (b != EMPTY)).sum(1)
    equal = ((a == b) & (a != EMPTY)).sum(1)
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    chance = CHANCE * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0, equal - chance) / np.maximum(1, either)


def signatures(column: pa.Array, shingle: int = SHINGLE) -> list:
    """n_shingles, two digest words of the set, registers packed into one 64-bit value per band."""
    counts, high, low, packed = [], [], [], []
    for _, _, data, offsets in slices(column):
        sets = shingle_sets(data, offsets, shingle)
        for s in sets:
            counts.append(len(s))
            high.append(int(np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))).view(np.int64)) if len(s) else 0)
            low.append(int(np.add.reduce(mix(s)).view(np.int64)) if len(s) else 0)
        packed.append(registers(sets).view(np.int64))
    flat = np.concatenate(packed).ravel() if packed else np.zeros(0, np.int64)
    bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), pa.array(flat))
    return [pa.array(counts, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), bands]
