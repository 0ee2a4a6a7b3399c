"""Suffix arrays of shards of short texts by induced sorting, a character bucket at a time.

A shard is texts with a separator after each; separators differ from each other, so no comparison crosses one.
Suffixes are classified as smaller or larger than their successor, the leftmost smaller ones are sorted as
substrings, then as suffixes by their names, and all others are induced from them in one pass up and one pass
down the buckets. A bucket is induced as whole arrays; a run of one byte takes a step per byte.
"""

from __future__ import annotations

import numpy as np

from tallywell.llm.common import running_hash, span_hash


class Shard:
    """``symbols`` are bytes + 1, and 0 for separators; it must end with a separator and hold no empty text."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.t = symbols
        n = len(symbols)
        later = np.arange(n - 1, dtype=np.int32)
        later[symbols[1:] == symbols[:-1]] = n - 1
        later = np.minimum.accumulate(later[::-1])[::-1]
        self.small = np.ones(n, bool)
        inner = later < n - 1
        self.small[:-1][inner] = symbols[:-1][inner] < symbols[later[inner] + 1]
        self.leftmost = np.flatnonzero(self.small[1:] & ~self.small[:-1]).astype(np.int32) + 1
        self.separators = np.flatnonzero(symbols == 0).astype(np.int32)
        self.alphabet = int(symbols.max(initial=0)) + 1

    def _deal(self, places: np.ndarray, into: list[list[np.ndarray]]) -> None:
        """Append places to the buckets of their symbols, in their order."""
        if not len(places):
            return
        symbols = self.t[places]
        order = np.argsort(symbols, kind="stable")
        places, symbols = places[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for part, symbol in zip(np.split(places, cuts), symbols[np.append(0, cuts)].tolist(), strict=True):
            into[symbol].append(part)

    def _induce(self, leftmost: np.ndarray) -> list[np.ndarray]:
        """All suffixes by bucket, first the larger and then the smaller, from an order of the leftmost smaller ones."""
        none = np.zeros(0, np.int32)
        seeds: list[list[np.ndarray]] = [[] for _ in range(self.alphabet)]
        large: list[list[np.ndarray]] = [[] for _ in range(self.alphabet)]
        self._deal(leftmost, seeds)
        seeds[0] = [self.separators]
        for symbol in range(self.alphabet):
            onward, rounds = [], []
            todo = np.concatenate(large[symbol]) if large[symbol] else none
            while len(todo):
                rounds.append(todo)
                before = todo[todo > 0] - 1
                before = before[~self.small[before]]
                same = self.t[before] == symbol
                onward.append(before[~same])
                todo = before[same]
            large[symbol] = rounds
            for seed in seeds[symbol]:
                before = seed[seed > 0] - 1
                onward.append(before[~self.small[before]])
            self._deal(np.concatenate(onward) if onward else none, large)
        small: list[list[np.ndarray]] = [[] for _ in range(self.alphabet)]
        out: list[np.ndarray] = [none] * (2 * self.alphabet)
        for symbol in range(self.alphabet - 1, -1, -1):
            onward, rounds = [], []
            todo = np.concatenate(small[symbol]) if small[symbol] else none
            if symbol == 0:
                todo = self.separators[::-1]
            while len(todo):
                rounds.append(todo)
                if symbol == 0:
                    break
                before = todo[todo > 0] - 1
                before = before[self.small[before]]
                same = self.t[before] == symbol
                onward.append(before[~same])
                todo = before[same]
            own = np.concatenate(large[symbol]) if large[symbol] else none
            before = own[::-1]
            before = before[before > 0] - 1
            onward.append(before[self.small[before]])
            self._deal(np.concatenate(onward), small)
            out[2 * symbol] = own
            out[2 * symbol + 1] = np.concatenate(rounds)[::-1] if rounds else none
        return out

    def order(self) -> np.ndarray:
        """The suffix array."""
        if not len(self.leftmost):
            return np.concatenate(self._induce(self.leftmost))
        # Substrings from one leftmost smaller place to the next, in order.
        is_leftmost = np.zeros(len(self.t), bool)
        is_leftmost[self.leftmost] = True
        ordered = np.concatenate(self._induce(self.leftmost))
        ordered = ordered[is_leftmost[ordered]]
        rank = np.zeros(len(self.t), np.int32)
        rank[self.leftmost] = np.arange(len(self.leftmost))
        ends = np.minimum(np.append(self.leftmost[1:], len(self.t) - 1) + 1, len(self.t))
        code = span_hash(running_hash(self.t), self.leftmost, ends)
        # A substring that holds a separator is like no other.
        alone = (self.t[self.leftmost] == 0) | (self.t[ends - 1] == 0)
        at = rank[ordered]
        new = np.ones(len(at), bool)
        new[1:] = (code[at[1:]] != code[at[:-1]]) | alone[at[1:]] | alone[at[:-1]]
        name = np.empty(len(at), np.int64)
        name[at] = np.cumsum(new)
        # The suffixes of the string of names: ranks of 3, 9, 27 ... names until all differ.
        step = 1
        while not new.all():
            base = len(name) + 2
            second, third = np.zeros_like(name), np.zeros_like(name)
            second[:-step] = name[step:] if step < len(name) else 0
            if 2 * step < len(name):
                third[: -2 * step] = name[2 * step:]
            if base < 1 << 21:
                key = (name * base + second) * base + third
                step *= 3
            else:
                key = name * base + second
                step *= 2
            at = np.argsort(key, kind="stable")
            new = np.ones(len(at), bool)
            new[1:] = key[at[1:]] != key[at[:-1]]
            name[at] = np.cumsum(new)
        return np.concatenate(self._induce(self.leftmost[at]))

    def common(self, order: np.ndarray) -> np.ndarray:
        """The common prefix of each suffix and the one before it in ``order``, by permuted common prefixes.

        In text order a common prefix is one less than that of the place before, unless the bytes to the left
        differ; only those are compared byte by byte.
        """
        t, n = self.t, len(self.t)
        before = np.empty(n, np.int64)
        before[order[1:]] = order[:-1]
        before[order[0]] = -1
        place = np.arange(n)
        start = np.ones(n, bool)
        inner = np.flatnonzero(before[1:] > 0) + 1
        start[inner] = (t[inner - 1] != t[before[inner] - 1]) | (t[inner - 1] == 0)
        at = np.flatnonzero(start & (before >= 0))
        permuted = np.zeros(n, np.int64)
        far = np.zeros(n + 8, t.dtype)
        far[:n] = t
        eight = np.lib.stride_tricks.sliding_window_view(far, 8)
        left, right, length = at, before[at], np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        while len(live):
            a, b = eight[left[live] + length[live]], eight[right[live] + length[live]]
            stop = (a != b) | (a == 0)
            same = np.where(stop.any(1), stop.argmax(1), 8)
            length[live] += same
            live = live[same == 8]
        permuted[at] = length
        last = np.maximum.accumulate(np.where(start, place, 0))
        permuted = permuted[last] - (place - last)
        return np.maximum(permuted, 0)[order]
