"""Suffix order and common prefixes of a shard by induced sorting, in bulk.

The shard is a row of strings, each ended by a sentinel (0) that is smaller than
any character and different from every other sentinel. Left-most S suffixes
(LMS) are put in order first: an induction over unordered ones sorts the LMS
substrings, these get names, and the shorter string of names is put in order by
doubling. Then the induction proper: the bucket of each first character is taken
up in order, its suffixes' left neighbours go to the queues of their own first
characters, first all L suffixes upwards, then all S suffixes downwards. Every
bucket is handled in whole arrays.

A queue holds tuples (place, common prefix with the tuple before it). What comes
into a queue comes in order, so the set of queues is a priority queue over first
characters; beyond ``MEMORY`` tuples its fullest parts go to a scratch file. The
common prefix of two neighbours in a queue is one more than the least common
prefix between the places that they came from.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 8_000_000
NONE = np.uint16(65535)


class Queues:
    """First-in-first-out queues by character, parts of which lie on disk."""

    def __init__(self, n: int, memory: int = MEMORY):
        self.parts = [[] for _ in range(n)]
        self.held, self.memory, self.file = 0, memory, None

    def put(self, c: int, place: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[c].append((place, lcp))
        self.held += len(place)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # gone when the task ends or dies
        for parts in self.parts:
            for k, p in enumerate(parts):
                if isinstance(p[0], np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(p[0].tobytes())
                    self.file.write(p[1].tobytes())
                    parts[k] = (at, len(p[0]))
        self.held = 0

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for p in self.parts[c]:
            if not isinstance(p[0], np.ndarray):
                self.file.seek(p[0])
                p = (np.frombuffer(self.file.read(4 * p[1]), np.int32), np.frombuffer(self.file.read(2 * p[1]), np.uint16))
            else:
                self.held -= len(p[0])
            out.append(p)
        self.parts[c] = []
        if not out:
            return np.zeros(0, np.int32), np.zeros(0, np.uint16)
        return np.concatenate([p[0] for p in out]), np.concatenate([p[1] for p in out])


class Minima:
    """Least value of any range of an array (table of powers of two)."""

    def __init__(self, v: np.ndarray):
        self.levels = [v]
        w = 1
        while 2 * w <= len(v):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-w], last[w:]))
            w *= 2

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Over [lo, hi), NONE if empty."""
        out = np.full(len(lo), NONE, np.uint16)
        size = hi - lo
        level = np.frexp(size.astype(np.float64))[1] - 1
        for k in range(len(self.levels)):
            at = np.flatnonzero(level == k)
            if len(at):
                t = self.levels[k]
                out[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << k)])
        return out


class Shard:
    def __init__(self, text: np.ndarray, memory: int = MEMORY):
        """``text``: int16, characters 1 to 256, sentinels 0, the first and the last a sentinel."""
        self.text, self.memory = text, memory
        n = len(text)
        step = np.sign(np.diff(text.astype(np.int32), append=1))  # > 0: smaller than its right neighbour
        step[text == 0] = 1
        # A run of one character has the type of its end.
        same = step == 0
        ends = np.where(same, n, np.arange(n))
        ends = np.minimum.accumulate(ends[::-1])[::-1]
        self.is_s = step[np.minimum(ends, n - 1)] > 0
        self.lms = np.flatnonzero(self.is_s & ~np.concatenate([[True], self.is_s[:-1]])).astype(np.int32)
        edge = np.flatnonzero(text == 0)
        self.first = edge[0]
        if 0 not in self.lms:
            self.lms = np.concatenate([[0], self.lms]).astype(np.int32)
        self.run_end = np.minimum.accumulate(np.where(np.diff(text, append=-1) != 0, np.arange(n), n)[::-1])[::-1]

    def run(self, i) -> int:
        """Length of the run of one character from place ``i``."""
        return int(self.run_end[i]) - int(i) + 1

    # ---- induction
    def _push(self, queues, x, lcp, since, keep):
        """Left neighbours of the suffixes ``x`` (with their common prefixes) to
        their queues; ``keep`` says by character which are of the type sought."""
        left = x - 1
        ch = self.text[left]
        at = np.flatnonzero(keep(ch))
        track = lcp is not None
        if track and len(lcp):
            low = Minima(lcp)
            total = lcp.min()
        if len(at):
            order = at[np.argsort(ch[at], kind="stable")]
            kind = ch[order]
            new = np.flatnonzero(np.diff(kind, prepend=-1))
            stop = np.append(new[1:], len(order))
            if track:
                lo = np.empty(len(order), np.int64)
                lo[1:] = order[:-1] + 1
                lo[new] = 0
                least = low.least(lo, order + 1)
                least[new] = np.minimum(least[new], since[kind[new]])
                least = np.minimum(least, NONE - 1) + np.uint16(1)
                tail = low.least(order[stop - 1] + 1, np.full(len(new), len(x)))
                np.minimum(since, total, out=since)
                since[kind[new]] = tail
            for b, e in zip(new, stop):
                queues.put(int(kind[b]), left[order[b:e]], least[b:e] if track else np.zeros(e - b, np.uint16))
        elif track and len(lcp):
            np.minimum(since, total, out=since)

    def induce(self, lms: np.ndarray, lms_lcp: np.ndarray | None):
        """Yields, characters falling, (L places, L lcp, S places, S lcp, gap): the
        L part upwards, the S part downwards, and the common prefix between both."""
        track, text = lms_lcp is not None, self.text
        top = int(text.max()) + 1
        first = np.searchsorted(text[lms], np.arange(top + 1))
        up, done = Queues(top, self.memory), Queues(top, self.memory)
        for c in range(top):
            since = np.zeros(top, np.uint16)
            x, lcp = up.take(c)
            last = None
            head = True
            while len(x):
                if track and head:
                    lcp = lcp.copy()
                    lcp[0] = 0
                head = False
                done.put(c, x, lcp)
                last = x[-1]
                self._push(up, x, lcp if track else None, since, lambda ch: ch >= c)
                x, lcp = up.take(c)
            own = slice(first[c], first[c + 1])
            x = lms[own]
            if len(x):
                lcp = None
                if track:
                    lcp = lms_lcp[own].copy()
                    lcp[0] = 0 if last is None else min(self.run(last), self.run(x[0]))
                if c == 0:
                    x, lcp = x[x > 0], lcp[x > 0] if track else None
                if len(x):
                    self._push(up, x, lcp, since, lambda ch: ch > c)
        down = Queues(top, self.memory)
        for c in range(top - 1, 0, -1):
            since = np.zeros(top, np.uint16)
            places, lcps, head = [], [], True
            x, lcp = down.take(c)
            while len(x):
                if track and head:
                    lcp = lcp.copy()
                    lcp[0] = 0
                head = False
                places.append(x)
                lcps.append(lcp)
                self._push(down, x, lcp if track else None, since, lambda ch: (ch <= c) & (ch > 0))
                x, lcp = down.take(c)
            s = np.concatenate(places) if places else np.zeros(0, np.int32)
            s_lcp = np.concatenate(lcps) if lcps else np.zeros(0, np.uint16)
            low, low_lcp = done.take(c)
            gap = min(self.run(low[-1]), self.run(s[-1])) if len(low) and len(s) else 0
            if len(low):
                back = low[::-1]
                back_lcp = None
                if track:
                    back_lcp = np.empty(len(low), np.uint16)
                    back_lcp[0] = gap
                    back_lcp[1:] = low_lcp[:0:-1]
                self._push(down, back, back_lcp, since, lambda ch: (ch < c) & (ch > 0))
            yield low, low_lcp, s, s_lcp, gap

    # ---- order of the LMS suffixes
    def ordered_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS places in suffix order and the common prefix of each with the one before."""
        text, lms = self.text, self.lms
        n, m = len(text), len(lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        by_char = lms[np.argsort(text[lms], kind="stable")]
        zeros = by_char[text[by_char] == 0]
        parts = [s[::-1] for _, _, s, _, _ in self.induce(by_char, None)]
        order = np.concatenate([p[is_lms[p]] for p in parts[::-1]] + [np.zeros(0, np.int32)])
        # Names: LMS substrings (up to and with the next LMS character) that are equal share one.
        nxt = np.full(n, n - 1, np.int32)
        nxt[lms[:-1]] = lms[1:]
        hashes = Hashes(text)
        length = nxt[order] - order + 1
        code = hashes.of(order, length)
        differ = (np.diff(length, prepend=-1) != 0) | (np.diff(code.view(np.int64), prepend=0) != 0) if m else np.zeros(0, bool)
        if len(differ):
            differ[0] = True
        name = np.empty(n, np.int64)
        name[zeros] = np.arange(len(zeros))
        name[order] = len(zeros) + np.cumsum(differ) - 1
        rank = name[lms]
        # Doubling over the names; every string ends in a sentinel of its own.
        width = 1
        while True:
            other = np.concatenate([rank[width:], np.full(min(width, m), -1)])[:m] + 1
            pair = rank * np.int64(m + 1) + other
            by = np.argsort(pair, kind="stable")
            new = np.empty(m, np.int64)
            new[by] = np.cumsum(np.diff(pair[by], prepend=-1) != 0) - 1
            rank, width = new, 2 * width
            if rank[by[-1]] == m - 1 or width > 2 * m:
                break
        lms_sorted = lms[by]
        # Common prefixes of neighbours, up to the nearer sentinel, by halving steps.
        edges = np.flatnonzero(text == 0)
        rest = edges[np.searchsorted(edges, lms_sorted)] - lms_sorted
        lcp = np.zeros(m, np.int64)
        a, b = lms_sorted[:-1].astype(np.int64), lms_sorted[1:].astype(np.int64)
        bound = np.minimum(rest[:-1], rest[1:])
        size, got = 1 << int(bound.max()).bit_length() if m > 1 else 0, np.zeros(max(m - 1, 0), np.int64)
        while size:
            ok = got + size <= bound
            at = np.flatnonzero(ok)
            same = hashes.of(a[at] + got[at], size) == hashes.of(b[at] + got[at], size)
            got[at[same]] += size
            size >>= 1
        lcp[1:] = got
        return lms_sorted, np.minimum(lcp, int(NONE) - 1).astype(np.uint16)

    def repeated(self, length: int) -> np.ndarray:
        """Marks the places whose next ``length`` characters occur at another place as well."""
        mark = np.zeros(len(self.text), bool)
        for low, low_lcp, s, s_lcp, gap in self.induce(*self.ordered_lms()):
            for x, lcp in ((low, low_lcp), (s, s_lcp)):
                if len(x) > 1:
                    hit = np.flatnonzero(lcp[1:] >= length)
                    mark[x[hit]] = True
                    mark[x[hit + 1]] = True
            if gap >= length:
                mark[low[-1]] = mark[s[-1]] = True
        return mark


class Hashes:
    """Polynomial hashes of all substrings, modulo 2^64, of randomly coded characters."""

    BASE = 0xD1342543DE82EF95
    CODES = np.random.default_rng(77).integers(0, 2**64, 257, dtype=np.uint64)

    def __init__(self, text: np.ndarray):
        n = len(text)
        power = np.full(n + 1, self.BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        inverse = np.full(n + 1, pow(self.BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.CODES[text] * power[:n], dtype=np.uint64)])

    def of(self, start, length):
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]
