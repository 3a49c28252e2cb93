"""Shingle sets of texts as sorted arrays of 64-bit hashes, a whole Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)
_M_INVERSE = _U(pow(int(_M), -1, 2**64))
_K = _U(0xD6E8FEB86659FD93)
#: Bytes of text handled at a time; a longer text is handled alone.
PIECE = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0 to n and their inverses; kept for the next call."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_M, _M_INVERSE)):
            steps = np.full(n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of runs of rows of about PIECE bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, side="right")) - 1)
        yield lo, hi, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def shingle_sets(column: pa.Array, width: int = 4) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, hashes, bounds): row first + k has the distinct shingles
    ``hashes[bounds[k]:bounds[k + 1]]`` in ascending order.

    Words are maximal runs without ASCII white space, A-Z lower-cased; a text with fewer
    than ``width`` words has its whole sequence as one shingle, one without words none.
    """
    for lo, hi, raw, at in _pieces(column):
        size = len(raw)
        raw = _LOWER[raw]
        solid = ~_SPACE[raw]
        cut = np.zeros(size + 1, dtype=bool)
        cut[at] = True
        before = np.concatenate(([False], solid[:-1])) if size else solid
        starts = np.flatnonzero(solid & (~before | cut[:size]))
        after = np.concatenate((solid[1:], [False])) if size else solid
        ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
        power, inverse = _power(size)
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((raw.astype(np.uint64) + _U(1)) * power[:size])))
        words = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _K)

        first = np.searchsorted(starts, at)  # of each row's words
        count = np.diff(first)
        row = np.repeat(np.arange(hi - lo), count)
        n = len(words)
        if n >= width:
            grams = words[:n - width + 1].copy()
            for k in range(1, width):
                grams = grams * _K + words[k:n - width + 1 + k]
            whole = row[:n - width + 1] == row[width - 1:]
            grams, owner = mix(grams[whole]), row[:n - width + 1][whole]
        else:
            grams, owner = words[:0], row[:0]
        short = np.flatnonzero((count > 0) & (count < width))
        if len(short):
            folded = np.zeros(len(short), dtype=np.uint64)
            for i, r in enumerate(short):
                h = _U(count[r])
                with np.errstate(over="ignore"):
                    for w in words[first[r]:first[r + 1]]:
                        h = h * _M + w
                folded[i] = h
            where = np.searchsorted(owner, short)
            grams, owner = np.insert(grams, where, mix(folded)), np.insert(owner, where, short)
        bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            grams[a:b].sort()
        if len(grams):
            new = np.ones(len(grams), dtype=bool)
            new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            grams, owner = grams[new], owner[new]
            bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
        yield lo, hi, grams, bounds


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each set; equal sets have equal keys."""
    keys = []
    for salt in (_U(0x632BE59BD9B4E019), _U(0x2545F4914F6CDD1D)):
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes * salt + salt))))
        sums = total[bounds[1:]] - total[bounds[:-1]]
        keys.append(mix(sums + np.diff(bounds).astype(np.uint64) * _K).view(np.int64))
    return keys[0], keys[1]
