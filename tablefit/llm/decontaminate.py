"""Benchmark decontamination by the q-gram lemma.

Texts are normalised byte by byte (A-Z to lower case, runs of other ASCII than
letters and digits to one space). A region of a document within ``k`` edits of an
item of ``m`` bytes shares at least ``m - q + 1 - k q`` of the item's q-grams with
it, all on diagonals (document place less item place) that lie within ``k`` of
each other. Shared q-grams are counted in diagonal bands of width ``2 (k + 1)``
that overlap by half, so one band holds them all; bands that reach the bound are
verified by an alignment confined to the band and ``k`` diagonals on either side.
An item counts as leaked when all of it occurs within ``k`` edits, ``k`` being
``EDIT_SHARE`` of its length (less for items too short for the bound).

Shared q-grams are never listed all at once: places are taken in slices of at most
``PAIRS`` pairs, and where both a text and an item repeat a q-gram very often (runs
of one letter, repeated lines) the bands are counted from the sorted places without
listing pairs. Documents longer than ``CHUNK_BYTES`` are searched in windows that
overlap by the longest region. So a task's memory depends on neither.

The benchmark is the query set: it is broadcast in blocks of at most
``BLOCK_BYTES``, each block against all documents; no text is shuffled.

Defined results: null or empty documents and items match nothing, nor do items
of fewer than q normalised bytes; repeated rows and items are reported each;
null IDs are carried; one row per (document row, item) pair that matches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import drop_rows, ship, table, text_key, text_or_empty

Q = 8
EDIT_SHARE = 0.1
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 2 << 20
#: Candidates aligned at the same time, and at most so many cells of their bands.
ALIGN = 256
ALIGN_CELLS = 1 << 16
#: Shared q-grams listed at the same time, and from how many on those of one q-gram and item are counted instead.
PAIRS = 1 << 21
HEAVY = 1 << 16

_MAP = np.full(256, 32, np.uint8)
_MAP[0] = 0
_MAP[48:58] = np.arange(48, 58)
_MAP[65:91] = np.arange(97, 123)
_MAP[97:123] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def normalise(raw: np.ndarray) -> np.ndarray:
    """NUL bytes stay (they part texts); a space next to a space or NUL goes."""
    x = _MAP[raw]
    space = x == 32
    before = np.concatenate([[True], (x[:-1] == 32) | (x[:-1] == 0)])
    x = x[~(space & before)]
    last = np.concatenate([x[1:] == 0, [True]])
    return x[~((x == 32) & last)]


def grams(x: np.ndarray) -> np.ndarray:
    """The q bytes from each place as one integer."""
    n = len(x) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for o in range(min(Q, n)):
        m = (len(x) - o) // Q
        out[o::Q] = x[o:o + m * Q].view(np.uint64)[:len(out[o::Q])]
    return out


def budget(m: int, share: float = EDIT_SHARE) -> int:
    return max(0, min(int(share * m), (m - Q) // Q))


def _mix(x):
    return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)


class Items:
    """The q-gram index of a block of benchmark items."""

    def __init__(self, texts: list[str], share: float):
        self.items = [normalise(np.frombuffer(t.encode("utf-8", "surrogatepass").replace(b"\0", b" "), np.uint8)) for t in texts]
        self.k = np.array([budget(len(x), share) for x in self.items], np.int64)
        self.need = np.array([len(x) - Q + 1 - k * Q for x, k in zip(self.items, self.k)], np.int64)
        parts = [(grams(x), i) for i, x in enumerate(self.items) if len(x) >= Q]
        code = np.concatenate([g for g, _ in parts] or [np.zeros(0, np.uint64)])
        item = np.concatenate([np.full(len(g), i) for g, i in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        place = np.concatenate([np.arange(len(g)) for g, _ in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        self.code, first = np.unique(code[order], return_index=True)
        self.ptr = np.append(first, len(code))
        self.item, self.place = item[order], place[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[_mix(self.code)] = True

    def _counted(self, at, item: int, places, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells of one q-gram and item from the sorted places of both."""
        step = int(self.k[item]) + 1
        low = (int(at[0]) - int(places[-1]) + size) // step
        edges = np.arange(low, (int(at[-1]) - int(places[0]) + size) // step + 2) * step - size
        # How many of the text's places lie below each place of the window.
        below = np.concatenate([[0], np.cumsum(np.bincount(at - at[0]))])
        n = np.zeros(len(edges) - 1, np.int64)
        for p in places:
            n += np.diff(below[np.clip(edges + p - at[0], 0, len(below) - 1)])
        some = np.flatnonzero(n)
        return item * np.int64(2 * size + 2) + low + some, n[some]

    def _cells(self, at, where, size: int):
        """``(cell, count)`` pieces; a cell is an item and a stretch of k + 1 diagonals."""
        wide = np.int64(2 * size + 2)

        def listed(at, start, width):
            stop = np.cumsum(width)
            first = 0
            while first < len(at):
                done = stop[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(stop, done + PAIRS, "right")))
                w = width[first:last]
                src = np.repeat(start[first:last] - np.concatenate([[0], np.cumsum(w)[:-1]]), w) + np.arange(w.sum())
                item = self.item[src]
                diag = np.repeat(at[first:last], w) - self.place[src] + size  # counted from a place below any
                yield np.unique(item * wide + diag // (self.k[item] + 1), return_counts=True)
                first = last

        width = self.ptr[where + 1] - self.ptr[where]
        often = np.flatnonzero(np.bincount(where, minlength=len(self.code)) * (self.ptr[1:] - self.ptr[:-1]) > HEAVY)
        heavy = np.isin(where, often)
        yield from listed(at[~heavy], self.ptr[where[~heavy]], width[~heavy])
        for gram in often:
            here = at[where == gram]
            start, stop = self.ptr[gram], self.ptr[gram + 1]
            items, first, n = np.unique(self.item[start:stop], return_index=True, return_counts=True)
            for i, f, m in zip(items, first + start, n):
                if len(here) * m > HEAVY and m >= 8:
                    yield self._counted(here, int(i), self.place[f:f + m], size)
                else:
                    yield from listed(here, np.full(len(here), f), np.full(len(here), m))

    def search(self, x: np.ndarray, doc_start: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, item, edits, end place in the normalised document) of
        the leaked items; ``x`` holds normalised texts parted by NULs."""
        longest = max((len(t) + int(k) for t, k in zip(self.items, self.k)), default=0) + Q
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for s in range(0, len(x), CHUNK_BYTES):
            if s and s + longest >= len(x) + Q:
                break  # the window before reached the end
            self._search(x[s:s + CHUNK_BYTES + longest], s, doc_start, best)
        return [(d, i, e, end) for (d, i), (e, end) in sorted(best.items())]

    def _search(self, x, shift: int, doc_start, best: dict) -> None:
        """Adds the matches of a window that begins at ``shift`` to ``best``."""
        g = grams(x)
        at = np.flatnonzero(self.seen[_mix(g)])
        where = np.searchsorted(self.code, g[at])
        ok = where < len(self.code)
        at, where = at[ok], where[ok]
        ok = self.code[where] == g[at]
        at, where = at[ok], where[ok]
        if not len(at):
            return
        key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, waiting = [], 0

        def merged():
            cell, back = np.unique(np.concatenate([key, *[c for c, _ in held]]), return_inverse=True)
            return cell, np.bincount(back, np.concatenate([n, *[m for _, m in held]]), minlength=len(cell)).astype(np.int64)

        for piece in self._cells(at, where, len(x)):
            held.append(piece)
            waiting += len(piece[0])
            if waiting > PAIRS:
                key, n = merged()
                held, waiting = [], 0
        key, n = merged()
        # Bands of two neighbouring cells: each diagonal lies in two.
        wide = np.int64(2 * len(x) + 2)
        inner = key % wide > 0
        cell, back = np.unique(np.concatenate([key, key[inner] - 1]), return_inverse=True)
        n = np.bincount(back, np.concatenate([n, n[inner]]), minlength=len(cell)).astype(np.int64)
        item, band = cell // wide, cell % wide
        full = n >= self.need[item]
        item, low = item[full], band[full] * (self.k[item[full]] + 1) - len(x)
        for i in np.unique(item):
            lows = low[item == i]
            rows = max(1, min(ALIGN, ALIGN_CELLS // (4 * int(self.k[i]) + 2)))
            while len(lows):
                exact = []
                for doc, edits, end in self.align(x, shift, doc_start, int(i), lows[:rows]):
                    if edits < best.get((doc, int(i)), (1 << 30, 0))[0]:
                        best[doc, int(i)] = (edits, end)
                        exact += [doc] * (edits == 0)
                lows = lows[rows:]
                if exact:  # no band that lies whole in such a document can better it
                    first, last = (np.searchsorted(doc_start, np.maximum(lows + shift + o, 0), "right") - 1
                                   for o in (-int(self.k[i]), 3 * int(self.k[i]) + 2 + len(self.items[i])))
                    lows = lows[(first != last) | ~np.isin(first, exact)]

    def align(self, x, shift, doc_start, i, lows):
        """Banded alignment of item ``i`` near the diagonals from ``lows`` on:
        all of the item, anywhere in the document. Yields matches in budget."""
        k, item = int(self.k[i]), self.items[i]
        m, width = len(item), 2 * (k + 1) + 2 * k
        start = lows - k
        place = start[:, None] + np.arange(width + m)[None, :]
        text = np.where((place >= 0) & (place < len(x)), x[np.clip(place, 0, len(x) - 1)], 0)
        far = np.int32(m + width)
        cost = np.zeros((len(lows), width), np.int32)
        for r in range(m):
            seen = text[:, r:r + width]
            # A NUL parts two texts: no alignment passes it.
            new = cost + np.where(seen == 0, far, (seen != item[r]).astype(np.int32))
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            # Document bytes that the item lacks: carry the cheapest on the left along.
            skip = np.cumsum(np.where(text[:, r:r + width] == 0, far, 1), axis=1, dtype=np.int64)
            cost = np.minimum(np.minimum.accumulate(new - skip, axis=1) + skip, far).astype(np.int32)
        end = cost.argmin(axis=1)
        edits = cost[np.arange(len(lows)), end]
        last = start + end + m - 1 + shift  # the last byte of the match
        for j in np.flatnonzero(edits <= k):
            doc = int(np.searchsorted(doc_start, last[j], "right")) - 1
            yield doc, int(edits[j]), int(last[j] - doc_start[doc] + 1)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", share: float = EDIT_SHARE) -> DataFrame:
    """``id, key, item_id, edits, budget, match_end``: items found in documents.

    ``match_end`` counts bytes of the normalised document."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), text_key(text_col).alias("key"))
    id_type = src.schema["id"].dataType.simpleString()
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    item_type = items.schema["item_id"].dataType.simpleString()
    schema = f"id {id_type}, key long, item_id {item_type}, edits int, budget int, match_end long"
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])
        got = src.mapInArrow(_searcher(sent, share, src.schema["id"].dataType, items.schema["item_id"].dataType), schema)
        out = got if out is None else out.union(got)
    return out


def _searcher(sent, share, id_type, item_type):
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        from tablefit.llm.decontaminate import Items

        names = [r[0] for r in sent.value]
        index = Items([r[1] for r in sent.value], share)
        item_arrow = to_arrow_type(item_type)

        def search(b):
            raw = b"\0".join(t.as_py().encode("utf-8", "surrogatepass").replace(b"\0", b" ") for t in b.column("text"))
            x = normalise(np.frombuffer(raw, np.uint8))
            starts = np.concatenate([[0], np.flatnonzero(x == 0) + 1])
            found = index.search(x, starts) if len(index.code) else []
            row = pa.array([f[0] for f in found], pa.int64())
            return pa.record_batch([b.column("id").take(row), b.column("key").take(row),
                                    pa.array([names[f[1]] for f in found], item_arrow),
                                    pa.array([f[2] for f in found], pa.int32()),
                                    pa.array([int(index.k[f[1]]) for f in found], pa.int32()),
                                    pa.array([f[3] for f in found], pa.int64())],
                                   ["id", "key", "item_id", "edits", "budget", "match_end"])

        for b in batches:
            size = np.cumsum([len(t) if t else 0 for t in map(lambda v: v.as_py(), b.column("text"))])
            first = 0
            while first < b.num_rows:
                done = size[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(size, done + CHUNK_BYTES, "right")))
                yield search(b.slice(first, last - first))
                first = last

    return run


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    return drop_rows(docs, leaks(docs, benchmark, id_col, text_col), id_col, text_col)


def query(spark, sf_dir) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        F.col("id").alias("doc_id"), "item_id", "edits", "budget", "match_end")
