"""Packing by best-fit decreasing.

A document's ids end with ``end_id``. Overlong documents are first cut into full
windows, each a sequence of its own; the remainders are packed: by falling
length, each goes into the open window with the least remaining capacity that
holds it, found in a segment tree indexed by remaining capacity. Remainders are
dealt evenly (whatever their IDs) over tasks of about ``ITEMS`` each; a task
leaves at most a few windows badly filled.

Only (id, start, length, checksum) rows are shuffled; ``sequences`` assembles
the padded id arrays from pieces that carry their ids.

Defined results: a null or empty text is the end id alone; null IDs and repeated
rows are packed like others; an empty table packs to nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import keep_table, table, text_or_empty
from tablefit.llm.tokens import id_encoder, vocabulary

WINDOW = 2048
END_ID = 1
ITEMS = 50_000


def cut(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
        end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens`` per piece (and ``ids`` if asked for)."""
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    spec = vocabulary(docs.sparkSession, vocab_path)

    def run(batches):
        import zlib

        import pyarrow as pa

        encode = id_encoder(spec.value)
        for b in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for k, t in enumerate(b.column(1)):
                x = np.append(encode(t.as_py()), np.uint32(end_id)).astype("<u4")
                for s in range(0, len(x), window):
                    piece = x[s:s + window]
                    row.append(k)
                    start.append(s)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(x))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            cols = [b.column(0).take(pa.array(row, pa.int64()))] + [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(cols, names)

    return src.mapInArrow(run, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
                          + (", ids array<int>" if with_ids else ""))


class CapacityTree:
    """Segment tree over remaining capacities 0 to window: how many open windows
    have each; finds the least capacity of at least ``need`` in log steps."""

    def __init__(self, window: int):
        self.base = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, name: int) -> None:
        self.open[capacity].append(name)
        i = self.base + capacity
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        count, i = self.count, self.base + need
        if not count[i]:
            # Up to the first ancestor with something open to the right, then down its left edge.
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.base
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths, window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each item; ``lengths`` fall."""
    tree, where, offset, n = CapacityTree(window), [], [], 0
    for size in lengths:
        found = tree.take(size)
        if found is None:
            found = (window, n)
            n += 1
        capacity, name = found
        where.append(name)
        offset.append(window - capacity)
        if capacity > size:
            tree.add(capacity - size, name)
    return where, offset


def pack(pieces: DataFrame, window: int = WINDOW, items: int = ITEMS) -> DataFrame:
    """``pieces`` (with ``start``, ``length``) plus ``sequence_id`` and ``offset``."""
    narrow = keep_table(pieces, "pieces")
    parts = max(1, -(-narrow.count() // items))
    names = narrow.columns
    schema = narrow.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        t = pa.Table.from_batches(rows)
        # Falling lengths; ties by the other columns, so that a task run again packs alike.
        t = t.sort_by([("length", "descending")] + [(c, "ascending") for c in ("id", "start", "ids_crc32") if c in names])
        where, offset = best_fit_decreasing(t["length"].to_pylist(), window)
        first = TaskContext.get().partitionId() << 36
        t = t.append_column("sequence_id", pa.array([first + w for w in where], pa.int64()))
        t = t.append_column("offset", pa.array(offset, pa.int64()))
        yield from t.to_batches()

    return narrow.repartition(parts).mapInArrow(run, schema)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Padded id arrays from packed pieces that carry ``ids``: ``sequence_id, input_ids, n_ids``."""
    one = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    return (one.select("sequence_id", ids.alias("ids")).withColumn("n_ids", F.size("ids"))
            .select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(window) - F.col("n_ids"))).alias("input_ids"), "n_ids"))


def pack_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(cut(docs, vocab_path, id_col, text_col)).withColumnRenamed("id", "doc_id")


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
