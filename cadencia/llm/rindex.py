"""Run-length index: a run-compressed Burrows-Wheeler transform with suffix positions sampled at run ends.

``matching_statistics`` streams patterns through it from right to left and gives, for every position of a pattern, the length of
the longest match that begins there, up to what a match has to reach, and a place of it in the text. All patterns
advance together, one character a step, as array operations. ``first`` leads from a place to the earliest one with the
same ``length`` symbols.
"""

from __future__ import annotations

import numpy as np


def concatenated(texts: list[np.ndarray]) -> np.ndarray:
    """One text with a separator after each: -1, -2, ..., all different and smaller than any symbol."""
    out = np.empty(sum(map(len, texts)) + len(texts), np.int64)
    at = 0
    for i, text in enumerate(texts):
        out[at : at + len(text)] = text
        out[at + len(text)] = -1 - i
        at += len(text) + 1
    return out


def suffix_array(symbols: np.ndarray, length: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and which suffixes share ``length`` symbols (at least 3) with the one before them in it.

    The last symbol must occur once. Ranks are places in the order, so suffixes that are told apart keep theirs, and a
    round only sorts those that are not.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    letters = int(rank.max()) + 2
    step = 3 if letters < 1 << 20 else 2
    key = np.zeros(n, np.int64)
    for i in range(step):
        key *= letters
        key[: n - i] += rank[i:] + 1
    order = np.argsort(key)
    key = key[order]
    places = np.arange(n)
    suffixes = order
    shared, alike, known = np.zeros(n, bool), None, 0
    while True:
        # `suffixes` stand at `places` of the order; equal neighbours in `key` are not told apart yet.
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        first = places[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]
        rank[suffixes] = first
        alone = fresh & np.append(fresh[1:], True)
        if step <= length < 2 * step:
            alike = rank.copy()  # equal where `step` symbols are
            known = step
        if alone.all():
            break
        places, suffixes, first = places[~alone], suffixes[~alone], first[~alone]
        key = first * n + rank[suffixes + step]
        by_key = np.argsort(key)
        key, suffixes = key[by_key], suffixes[by_key]
        order[places] = suffixes
        step *= 2
    if length and alike is not None:
        rest = length - known
        # Next to each other in the order; a suffix too short for the second comparison differs in its separator already.
        here, before = np.minimum(order[1:] + rest, n - 1), np.minimum(order[:-1] + rest, n - 1)
        shared[1:] = (alike[order[1:]] == alike[order[:-1]]) & (alike[here] == alike[before])
    return order, shared


class RunIndex:
    def __init__(self, texts: list[np.ndarray], length: int = 0):
        self.text = concatenated(texts)
        suffixes, shared = suffix_array(self.text, length)
        begins = np.flatnonzero(~shared)
        self.first = np.empty(len(suffixes), np.int64)
        self.first[suffixes] = np.repeat(np.minimum.reduceat(suffixes, begins), np.diff(np.append(begins, len(suffixes))))
        bwt = self.text[suffixes - 1]
        self.starts = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))
        ends = np.append(self.starts[1:], len(bwt)) - 1
        heads, lengths = bwt[self.starts], ends - self.starts + 1
        self.at_start, self.at_end, self.ends = suffixes[self.starts], suffixes[ends], ends
        self.symbols, self.head = np.unique(heads, return_inverse=True)
        # Runs by symbol, in order: a run's rows map to consecutive rows after those of all runs before it.
        by_symbol = np.argsort(self.head, kind="stable")
        self.to = np.empty(len(heads), np.int64)
        self.to[by_symbol] = np.cumsum(lengths[by_symbol]) - lengths[by_symbol]
        self.runs = len(heads)
        self.sorted_runs = by_symbol
        self.keys = self.head[by_symbol].astype(np.int64) * self.runs + by_symbol

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the text at a and at b, at most ``most``."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        size, width = len(self.text), 8
        while len(open_):
            offsets = out[open_, None] + np.arange(width)
            x = np.minimum(a[open_, None] + offsets, size - 1)
            y = np.minimum(b[open_, None] + offsets, size - 1)
            same = (self.text[x] == self.text[y]) & (offsets < most[open_, None])
            run = np.where(same.all(1), width, same.argmin(1))
            out[open_] += run
            open_ = open_[run == width]
            width = min(width * 2, 64)
        return out

    def matching_statistics(self, patterns: list[np.ndarray], enough: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Lengths of the longest matches, and where each is in the text; from ``enough`` on lengths may be too low, but never
        fall below it."""
        longest_first = sorted(range(len(patterns)), key=lambda i: -len(patterns[i]))
        sizes = np.array([len(patterns[i]) for i in longest_first])
        joined = np.concatenate([patterns[i] for i in longest_first])
        base = np.cumsum(sizes) - sizes
        symbol = np.searchsorted(self.symbols, joined)
        symbol[symbol == len(self.symbols)] = 0
        symbol = np.where(self.symbols[symbol] == joined, symbol, -1)
        out, where = np.zeros(len(joined), np.int64), np.zeros(len(joined), np.int64)
        run = np.zeros(len(sizes), np.int64)
        row = np.zeros(len(sizes), np.int64)
        place = np.full(len(sizes), self.at_start[0])
        length = np.zeros(len(sizes), np.int64)
        for back in range(1, int(sizes[0]) + 1):
            live = int(np.searchsorted(-sizes, -back, side="right"))
            at = base[:live] + sizes[:live] - back
            c = symbol[at]
            run[:live] = np.searchsorted(self.starts, row[:live], side="right") - 1
            differs = np.flatnonzero(self.head[run[:live]] != c)
            if len(differs):
                self._jump(differs, c[differs], run, row, place, length, enough)
            known = c >= 0
            r = run[:live]
            row[:live] = np.where(known, self.to[r] + row[:live] - self.starts[r], 0)
            place[:live] = np.where(known, place[:live] - 1, self.at_start[0])
            length[:live] = np.where(known, length[:live] + 1, 0)
            out[at], where[at] = length[:live], place[:live]
        result: list[tuple[np.ndarray, np.ndarray]] = [None] * len(patterns)  # type: ignore[list-item]
        for i, b, n in zip(longest_first, base.tolist(), sizes.tolist()):
            result[i] = out[b : b + n], where[b : b + n]
        return result

    def _jump(self, which, c, run, row, place, length, enough) -> None:
        """Where the next symbol does not precede the match: to the nearest run of it above or below that keeps more of the match."""
        which, c = which[c >= 0], c[c >= 0]
        if not len(which):
            return
        below = np.searchsorted(self.keys, c * self.runs + run[which])
        above = below - 1
        best, best_run, best_row, best_place = np.full(len(which), -1), np.zeros(len(which), np.int64), np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        most = np.minimum(length[which], enough)
        for key, rows, samples in ((above, self.ends, self.at_end), (below, self.starts, self.at_start)):
            inside = np.clip(key, 0, self.runs - 1)
            there = self.sorted_runs[inside]
            fits = np.flatnonzero((key >= 0) & (key < self.runs) & (self.head[there] == c))
            if len(fits):
                shared = self._common(place[which[fits]], samples[there[fits]], most[fits])
                better = shared > best[fits]
                f = fits[better]
                best[f], best_run[f], best_row[f], best_place[f] = shared[better], there[f], rows[there[f]], samples[there[f]]
        run[which], row[which], place[which], length[which] = best_run, best_row, best_place, best
