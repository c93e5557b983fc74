"""A compressed full-text index over a sequence of integers: the
Burrows-Wheeler transform in a wavelet matrix of packed bit vectors with rank
counts, searched backward, many patterns in lockstep. Small and local: one
index covers one bounded shard of segments."""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate(
            [packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int32)])

    def rank(self, at):
        """Ones before each position of ``at``."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low).astype(np.int64)


class WaveletMatrix:
    def __init__(self, symbols, sigma: int):
        self.levels, order = [], np.asarray(symbols, np.int64)
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (order >> shift) & 1
            self.levels.append((shift, Bits(bit.astype(np.uint8)), int(len(bit) - bit.sum())))
            order = np.concatenate([order[bit == 0], order[bit == 1]])
        self.first = self._trace(np.arange(sigma), np.zeros(sigma, np.int64))

    def _trace(self, symbols, at):
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbols >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols, at):
        """Occurrences of each symbol before each position."""
        return self._trace(symbols, at) - self.first[symbols]


def suffix_order(text, depth: int):
    """Suffixes in the order of their first ``depth`` (or more) symbols."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, length = rank.astype(np.int64), 1
    while length < depth:
        ahead = np.zeros(n, np.int64)
        ahead[:max(0, n - length)] = rank[length:] + 1
        _, rank = np.unique(rank * np.int64(n + 1) + ahead, return_inverse=True)
        rank, length = rank.astype(np.int64), 2 * length
        if rank.max() == n - 1:
            break
    return np.argsort(rank, kind="stable")


class Least:
    """Minimum over ranges, from a table of doubling spans."""

    def __init__(self, values):
        self.rows = [np.asarray(values, np.int32)]
        span = 1
        while 2 * span <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-span], last[span:]))
            span *= 2
        self.flat = np.concatenate(self.rows)
        self.start = np.concatenate([[0], np.cumsum([len(r) for r in self.rows])])

    def over(self, left, right):
        """Minimum of [left, right); the ranges are not empty."""
        level = np.frexp((right - left).astype(np.float64))[1].astype(np.int64) - 1
        base = self.start[level]
        return np.minimum(self.flat[base + left], self.flat[base + right - (1 << level)])


class SegmentIndex:
    """FM-index over segments (arrays of codes), each with an owner number.

    ``reach(which, ends)`` streams segments backward from the given ends and
    returns how far left each stays equal to a place in a segment of a
    smaller owner: the matching statistics under that condition."""

    def __init__(self, segments: list, owners):
        longest = max(map(len, segments))
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        _, codes = np.unique(np.concatenate(segments), return_inverse=True)
        inside = np.ones(len(text), bool)
        inside[self.starts + lengths] = False  # 0 ends a segment
        text[inside] = codes + 1
        self.text, self.owners = text, np.asarray(owners, np.int64)
        order = suffix_order(text, longest + 1)
        before = text[order - 1]
        sigma = int(text.max()) + 1
        self.wavelet = WaveletMatrix(before, sigma)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        at = np.repeat(np.arange(len(segments)), lengths + 1)
        self.least = Least(self.owners[at][order])

    def reach(self, which, ends):
        which, ends = np.asarray(which, np.int64), np.asarray(ends, np.int64)
        out = ends.copy()
        active = np.arange(len(which))
        left = np.zeros(len(which), np.int64)
        right = np.full(len(which), len(self.text), np.int64)
        while len(active):
            active = active[out[active] > 0]
            seg = which[active]
            symbol = self.text[self.starts[seg] + out[active] - 1]
            lo = self.smaller[symbol] + self.wavelet.rank(symbol, left[active])
            hi = self.smaller[symbol] + self.wavelet.rank(symbol, right[active])
            good = hi > lo
            good[good] = self.least.over(lo[good], hi[good]) < self.owners[seg[good]]
            active = active[good]
            left[active], right[active] = lo[good], hi[good]
            out[active] -= 1
        return out


def shared_spans(segments: list, owners, window: int) -> list[list[tuple[int, int]]]:
    """Per segment the intervals covered by its ``window``-long parts that also
    occur in a segment of a smaller owner.

    With b(e) the leftmost start of such a match that ends at e (it never
    falls as e grows), a range of ends (lo, hi) is halved only while it could
    add something: not if hi - 1 - b(lo) < window, and not if what it can
    reach, [b(lo), hi - 1), is covered already."""
    index = SegmentIndex(segments, owners)
    spans: list[list[tuple[int, int]]] = [[] for _ in segments]
    covered = [np.zeros(len(s), bool) for s in segments]

    def search(jobs):
        found = index.reach([s for s, _ in jobs], [e for _, e in jobs])
        for (s, e), b in zip(jobs, found):
            if e - b >= window:
                spans[s].append((int(b), int(e)))
                covered[s][b:e] = True
        return found.tolist()

    jobs = [(s, len(x)) for s, x in enumerate(segments)]
    tops = search(jobs)
    rest = [(s, len(x)) for s, x in enumerate(segments) if len(x) > window and tops[s] > 0]
    lows = search([(s, window) for s, _ in rest])
    ranges = [(s, window, hi, b) for (s, hi), b in zip(rest, lows)]
    while ranges:
        ranges = [(s, lo, hi, b) for s, lo, hi, b in ranges
                  if hi - lo > 1 and hi - 1 - b >= window and not covered[s][b:hi - 1].all()]
        mids = [(s, (lo + hi) // 2) for s, lo, hi, _ in ranges]
        found = search(mids)
        ranges = [r for (s, lo, hi, b), (_, mid), c in zip(ranges, mids, found)
                  for r in ((s, lo, mid, b), (s, mid, hi, c))]
    return spans
