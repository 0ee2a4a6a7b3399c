"""Prediction by partial matching over byte contexts, for all symbols of a set of contexts at once.

A code is a symbol with the ``ORDER`` before it: the nearest in the highest bits, the symbol itself in the lowest. So
sorted codes are a trie of contexts from near to far. An escape from a context takes the share of its number of
distinct symbols, and the symbols of the longer context are excluded from the totals of the shorter one.
"""

from __future__ import annotations

import numpy as np

ORDER, WIDTH = 5, 9
END, START = 256, 257
SYMBOLS = 257
MASK = (1 << WIDTH) - 1


def codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, cuts): one code for each byte of each text and for its end; text i has those from cut i to i + 1."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    x = np.full(len(data) + (ORDER + 1) * n, START, np.int64)
    x[np.arange(len(data)) + text * (ORDER + 1) + ORDER] = data
    ends = offsets[1:] + np.arange(n) * (ORDER + 1) + ORDER
    x[ends] = END
    at = np.flatnonzero(x != START)
    code = x[at]
    for back in range(1, ORDER + 1):
        code |= x[at - back] << (WIDTH * (ORDER + 1 - back))
    return code, offsets + np.arange(n + 1)


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(keys, return_inverse=True)
    return unique, np.bincount(inverse, counts, len(unique)).astype(np.int64)


def _look(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked key, 0 if it isn't there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def log_probabilities(code: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray) -> np.ndarray:
    """log10 of the probability of each code's symbol in its context.

    ``counts`` are training counts, and ``code`` has all training codes whose nearest two symbols are among its own.
    ``pairs`` (nearest symbol and symbol, sorted) are the counts of the whole corpus.
    """
    symbol, trained = code & MASK, counts > 0
    tables = {ORDER: (code[trained], counts[trained])}
    for k in range(ORDER - 1, 1, -1):
        keys, values = tables[k + 1]
        tables[k] = _sums(((keys >> 2 * WIDTH) << WIDTH) | (keys & MASK), values)
    tables[1] = (pairs, pair_counts)
    tables[0] = _sums(pairs & MASK, pair_counts)
    contexts = {}
    for k, (keys, values) in tables.items():
        owner = keys >> WIDTH
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        if not len(first):
            contexts[k] = (owner, owner, owner, owner)
            continue
        total, distinct = np.add.reduceat(values, first), np.diff(np.append(first, len(owner)))
        below = np.zeros(len(first), np.int64)
        if k:
            lower = tables[k - 1]
            below = np.add.reduceat(_look(*lower, ((owner >> WIDTH) << WIDTH) | (keys & MASK)), first)
        contexts[k] = (owner[first], total, distinct, below)
    out, open_ = np.zeros(len(code)), np.ones(len(code), bool)
    taken_total, taken_distinct = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    for k in range(ORDER, -1, -1):
        context = code >> (WIDTH * (ORDER + 1 - k))
        owner, total, distinct, below = contexts[k]
        whole, many, under = (_look(owner, v, context) for v in (total, distinct, below))
        room, new = whole - taken_total, many - taken_distinct
        count = _look(*tables[k], (context << WIDTH) | symbol)
        able = open_ & (room + new > 0)
        hit, miss = able & (count > 0), able & (count == 0)
        out[hit] += np.log10(count[hit] / (room[hit] + new[hit]))
        out[miss] += np.log10(new[miss] / (room[miss] + new[miss]))
        open_ &= ~hit
        taken_total, taken_distinct = under, many
    seen = len(tables[0][0])
    if open_.any():
        out[open_] -= np.log10(SYMBOLS - seen)
    return out
