"""Suffix arrays by induced sorting and permuted common prefixes, in whole-array steps.

The scans that induce one suffix from another go bucket by bucket: all entries of a
bucket are looked at together, and what they induce into the same bucket is the
next wave, as long as the longest run of that symbol.
"""

from __future__ import annotations

import numpy as np

from logweave.llm.words import _power_tables, mix

_U = np.uint64
_SYMBOL_VALUES = mix(np.arange(1, 514, dtype=_U))


def classify(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next one, and the leftmost such positions."""
    n = len(symbols)
    after = np.empty(n, symbols.dtype)
    after[:-1], after[-1] = symbols[1:], -1
    differs = np.where(symbols != after, np.arange(n), n)
    decided = np.minimum.accumulate(differs[::-1])[::-1]
    smaller = symbols[decided] < after[decided]
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    return smaller, leftmost


def _deal(positions: np.ndarray, symbols: np.ndarray, parts: list[list[np.ndarray]]) -> None:
    """Append positions to the parts of their symbols, in the order given."""
    own = symbols[positions]
    order = np.argsort(own, kind="stable")
    own, positions = own[order], positions[order]
    cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
    for symbol, part in zip(own[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts), strict=True):
        parts[symbol].append(part)


def induce(symbols: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """The order of all suffixes that follows from that of the leftmost-smaller ones."""
    none = np.zeros(0, np.int64)
    seeds: list[list[np.ndarray]] = [[] for _ in range(size)]
    if len(leftmost):
        _deal(leftmost, symbols, seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    larger[int(symbols[-1])].append(np.array([len(symbols) - 1]))

    def spread(wave: np.ndarray, kind: bool, symbol: int, parts: list[list[np.ndarray]]) -> np.ndarray:
        before = wave[wave > 0] - 1
        before = before[smaller[before] == kind]
        if not len(before):
            return none
        here = symbols[before] == symbol
        rest = before[~here]
        if len(rest):
            _deal(rest, symbols, parts)
        return before[here]

    for symbol in range(size):
        wave = np.concatenate(larger[symbol]) if larger[symbol] else none
        larger[symbol] = []
        while len(wave):
            larger[symbol].append(wave)
            wave = spread(wave, False, symbol, larger)
        if seeds[symbol]:
            spread(np.concatenate(seeds[symbol]), False, symbol, larger)
    less: list[list[np.ndarray]] = [[] for _ in range(size)]
    buckets: list[np.ndarray] = []
    for symbol in range(size - 1, -1, -1):
        wave = np.concatenate(less[symbol]) if less[symbol] else none
        waves = []
        while len(wave):
            waves.append(wave)
            wave = spread(wave, True, symbol, less)
        high = np.concatenate(waves)[::-1] if waves else none
        low = np.concatenate(larger[symbol]) if larger[symbol] else none
        if len(low):
            spread(low[::-1], True, symbol, less)
        buckets += [high, low]
    return np.concatenate(buckets[::-1])


def suffix_array(symbols: np.ndarray, size: int, depth: int) -> np.ndarray:
    """The suffixes of ``symbols`` (0 to ``size - 1``), sorted by their first ``depth`` symbols at least.

    Leftmost-smaller substrings are sorted by one induction and named; their suffixes
    are sorted through pairs of names, of pairs, and so on, until the names are all
    different or reach over ``depth`` symbols; a second induction sorts the rest.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    smaller, leftmost = classify(symbols)
    if len(leftmost) > 1:
        order = induce(symbols, smaller, leftmost, size)
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        order = order[is_leftmost[order]]
        place = np.zeros(n, np.int64)
        place[leftmost] = np.arange(len(leftmost))
        ends = np.append(leftmost[1:] + 1, n)
        up, down = _power_tables(n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum(_SYMBOL_VALUES[symbols] * up[:n], dtype=_U, out=sums[1:])
        hashes = (sums[ends] - sums[leftmost]) * down[leftmost] + ends.astype(_U) - leftmost.astype(_U)
        k = place[order]
        fresh = np.ones(len(k), np.int64)
        fresh[1:] = hashes[k[1:]] != hashes[k[:-1]]
        names = np.empty(len(k), np.int64)
        names[k] = np.cumsum(fresh)
        reach, most = 1, int(names.max())
        while most < len(names) and 2 * reach <= depth + 2:
            second = np.zeros(len(names), np.int64)
            second[:-reach] = names[reach:]
            pairs, names = np.unique(names * (most + 1) + second, return_inverse=True)
            names = names + 1
            most = len(pairs)
            reach *= 2
        leftmost = leftmost[np.argsort(names, kind="stable")]
    return induce(symbols, smaller, leftmost, size)


def permuted_prefixes(symbols: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Per position the common prefix with the suffix sorted before it.

    Symbol 0 ends strings of at most ``most`` symbols; a prefix that goes on beyond
    such an end may be told too short.

    Where both suffixes are preceded by the same symbol the value is one less than at
    the position before, so only the others are compared, eight symbols at a time.
    Symbols 0 and 256 count as one here; UTF-8 has no byte that would be 256.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    whole = np.arange(n)
    reducible = (whole > 0) & (before > 0)
    reducible[1:] &= symbols[:-1] != 0
    at = np.flatnonzero(reducible)
    reducible[at] = (symbols[at - 1] == symbols[before[at] - 1]) & (before[at - 1] == before[at] - 1)
    head = np.flatnonzero(~reducible)
    padded = np.zeros(n + 8 + 8 * (most // 8 + 2), _U)
    padded[:n] = symbols.astype(_U) & _U(0xFF)
    packed = padded[:-8].copy()
    for k in range(1, 8):
        packed[: len(padded) - 8] |= padded[k : k + len(packed)] << _U(8 * k)
    common = np.zeros(len(head), np.int64)
    live = np.flatnonzero(before[head] >= 0)
    step = 0
    while len(live) and step <= most:
        a, b = head[live] + step, before[head[live]] + step
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        apart = packed[a] ^ packed[b]
        same = apart == 0
        low = apart & (~apart + _U(1))
        low[same] = _U(1)
        bits = np.frexp(low.astype(np.float64))[1] - 1
        common[live] = step + np.where(same, 8, bits // 8)
        live = live[same]
        step += 8
    last = np.maximum.accumulate(np.where(reducible, 0, whole))
    values = np.zeros(n, np.int64)
    values[head] = np.minimum(common, n - np.maximum(head, before[head]))
    return np.maximum(values[last] - (whole - last), 0)
