"""Suffix naming by doubling in numpy: ranks of suffixes and their common prefixes.

Sequences lie one after another in one array; ``ends[i]`` is the end of the sequence that holds
position i. A name of level k stands for the 2^k symbols from a position on, cut at the sequence's
end; names sort like what they stand for, a shorter one before its extensions.
"""

from __future__ import annotations

import numpy as np


def dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the distinct values."""
    return np.unique(values, return_inverse=True)[1].astype(np.int32) + 1


def name_levels(symbols: np.ndarray, ends: np.ndarray, depth: int | None = None, span: int = 1
                ) -> list[np.ndarray]:
    """Names of levels 0, 1, ... until all differ or a level covers ``depth`` symbols. With a
    ``span``, a position's entry of ``symbols`` already stands for so many symbols from it on."""
    n = len(symbols)
    at = np.arange(n)
    levels = [dense(symbols)]
    depth = n if depth is None else depth
    while span < depth and levels[-1].max() < n:
        last = levels[-1]
        pair = last.astype(np.int64) * (n + 1)
        more = np.flatnonzero(at + span < ends)
        pair[more] += last[more + span]
        levels.append(dense(pair))
        span *= 2
    return levels


def common_prefix(levels: list[np.ndarray], ends: np.ndarray, i: np.ndarray, j: np.ndarray
                  ) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``i`` and ``j``, pair by pair (i <> j)."""
    length = np.zeros(len(i), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i + length, j + length
        fit = np.flatnonzero((a + (1 << k) <= ends[i]) & (b + (1 << k) <= ends[j]))
        same = fit[levels[k][a[fit]] == levels[k][b[fit]]]
        length[same] += 1 << k
    return length


def range_minimum(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: entry k holds the least of every 2^k consecutive values."""
    table = [values]
    while 2 * (1 << (len(table) - 1)) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def least_between(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least value of every non-empty range [lo, hi)."""
    out = np.empty(len(lo), dtype=table[0].dtype)
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][lo[at]], table[k][hi[at] - (1 << int(k))])
    return out
