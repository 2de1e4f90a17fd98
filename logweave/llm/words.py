"""Words and shingles of UTF-8 texts as 64-bit hashes, for whole Arrow columns at a time.

The hash of a word is a polynomial over its bytes modulo 2^64, read off prefix
sums, so no word becomes a Python object.  Bytes are mapped to fixed random
64-bit values first; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Texts are worked through in groups of about this many bytes; a longer text is
# cut at white space, so working memory does not grow with it.
GROUP_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII_LETTERS = np.zeros(256, bool)
_ASCII_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# Where words end: at white space, or at whatever is no ASCII letter, digit or part of a longer character.
WHITE_SPACE = _SPACE
PUNCTUATION = ~_ASCII_LETTERS


def _byte_values(seed: int) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=_U)
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


_VALUES = _byte_values(20)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, GROUP_BYTES * 2), base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=_U)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and where each value starts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, data = column.buffers()
    if len(column) == 0 or starts is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at.astype(np.int64) - int(at[0])


def byte_groups(at: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes together, one text at least."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def _hashed(data: np.ndarray, at: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    word = ~ends_word[data]
    before = np.zeros(n, bool)
    before[1:] = word[:-1]
    firsts = at[:-1]
    before[firsts[firsts < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    lasts = at[1:]
    after[lasts[lasts > 0] - 1] = False
    starts, stops = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_VALUES[data] * up[:n], dtype=_U, out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts]), starts, stops


def word_hashes(
    data: np.ndarray, at: np.ndarray, ends_word: np.ndarray = WHITE_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words start."""
    if len(at) == 2 and len(data) > 4 * GROUP_BYTES:
        parts, first = [], 0
        while first < len(data):
            last = min(len(data), first + GROUP_BYTES)
            if last < len(data):
                spaces = np.flatnonzero(ends_word[data[first:last]])
                while not len(spaces) and last < len(data):
                    last = min(len(data), last + GROUP_BYTES)
                    spaces = np.flatnonzero(ends_word[data[first:last]])
                if len(spaces):
                    last = first + int(spaces[-1]) + 1
            piece = data[first:last]
            parts.append(_hashed(piece, np.array([0, len(piece)]), ends_word)[0])
            first = last
        found = np.concatenate(parts)
        return found, np.array([0, len(found)])
    if len(data) == 0:
        return np.zeros(0, _U), np.zeros(len(at), np.int64)
    hashes, starts, _ = _hashed(data, at, ends_word)
    return hashes, np.searchsorted(starts, at)


def shingle_sets(data: np.ndarray, at: np.ndarray, length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and where each text's set starts.

    A shingle is ``length`` words in a row; a text with fewer words has its whole
    sequence as the only one, and a text without words has none.
    """
    words, bounds = word_hashes(data, at)
    factors = mix(np.arange(1, length + 1, dtype=_U)) | _U(1)
    counts = np.diff(bounds)
    sums = np.zeros(len(words), _U)
    for k in range(min(length, len(words))):
        sums[: len(words) - k] += words[k:] * factors[k]
    sums = mix(sums)
    sets: list[np.ndarray] = []
    for first, n in zip(bounds[:-1].tolist(), counts.tolist(), strict=True):
        if n >= length:
            sets.append(np.unique(sums[first : first + n - length + 1]))
        elif n:
            short = (words[first : first + n] * factors[:n]).sum(dtype=_U) + _U(n)
            sets.append(mix(np.array([short], _U)))
        else:
            sets.append(np.zeros(0, _U))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, _U)), np.concatenate([[0], np.cumsum(sizes)])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in each Arrow batch than by default: rows here hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
