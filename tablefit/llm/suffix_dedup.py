"""Removal of repeated byte strings by suffix sorting in shards.

Every byte covered by a ``WINDOW``-byte string that also starts elsewhere (in
any document, judged on the input) goes. Shards are made so that equal windows
meet: a window belongs to the least hashed ``GRAM``-byte string in it, and equal
windows have the same one. Windows of a document that share it are a run; the run
with its bytes is a segment. Runs whose string occurs once in the corpus hold no
repeat. Equal segments are folded, with their count, before anything is shuffled
with its bytes; a string whose segments are all equal is settled by that. The
other segments are dealt to shards by their string, and each shard is put in
suffix order by external induced sorting with common prefixes (``induced.py``).
Windows with a neighbour that shares ``WINDOW`` bytes are repeated.

A string that stands in very many different segments (a line that many documents
hold) is dealt further: each group of ``NARROW`` neighbouring windows by the bytes
common to all of them, which again equal windows share. Equal groups are folded,
with their count, before the shuffle; where more than ``HOT`` different ones still
share those bytes, windows meet one by one, as a whole.

Defined results: a null text is empty, texts below ``WINDOW`` bytes lose nothing;
null IDs and repeated rows are judged like others (copies repeat each other; rows
equal in ID and text share one number and one read of it); an empty table gives an empty result. Rows: one per input row.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import discard, keep_table, table, text_key, text_or_empty

WINDOW = 200
GRAM = 32
SPAN = WINDOW - GRAM + 1  # places of a gram in a window
SLICE = 1 << 20  # bytes hashed at a time
SHARD = 2 << 20  # bytes of segments sorted together, about (raise it where tasks have more memory)
HOT = 2048  # different segments of one string
NARROW = 16
SPANS = "array<struct<start:long,end:long>>"

_TABLES: dict = {}


def _powers(n: int):
    if _TABLES.get("n", 0) < n:
        rng = np.random.default_rng(4242)
        base = int(rng.integers(0, 1 << 62)) * 2 + 1
        power, inverse = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        power[0] = inverse[0] = 1
        _TABLES.update(n=n, power=np.multiply.accumulate(power), inverse=np.multiply.accumulate(inverse),
                       codes=rng.integers(0, 2**64, 256, dtype=np.uint64))
    return _TABLES["power"], _TABLES["inverse"], _TABLES["codes"]


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours (blockwise running minima both ways)."""
    n = len(v) - width + 1
    pad = np.full(-len(v) % width, np.iinfo(v.dtype).max, v.dtype)
    blocks = np.concatenate([v, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def runs(raw: np.ndarray, first: np.ndarray, size: np.ndarray):
    """Runs of the windows of the parts ``[first, first + size)`` of ``raw``:
    (part, key of the least gram, hash of the segment, start in the part, windows, gram place less last start)."""
    from tablefit.llm.shingles import mix

    power, inverse, codes = _powers(max(SLICE + WINDOW + 1, len(raw) + 1))
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes[raw] * power[:n], out=sums[1:])
    key = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[:n - GRAM + 1])
    low = np.uint64((1 << 24) - 1)
    place = np.arange(len(key), dtype=np.uint64)
    at = (sliding_least((key & ~low) | place, SPAN) & low).astype(np.int64)
    long = np.flatnonzero(size >= WINDOW)
    starts = np.concatenate([np.arange(first[i], first[i] + size[i] - WINDOW + 1) for i in long])
    gram = at[starts]
    new = np.flatnonzero(np.diff(gram, prepend=-1))
    s = starts[new]
    e = starts[np.append(new[1:], len(starts)) - 1]
    p = gram[new]
    segment = mix((sums[e + WINDOW] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
    part = np.searchsorted(first, s, "right") - 1
    return part, key[p].view(np.int64), segment.view(np.int64), s - first[part], e - s + 1, p - e


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cid, id, tkey, n_bytes, sha`` and the runs of each row (``keys, segs, packs``)."""
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), text_key(text_col).alias("tkey"))
    id_type = src.schema["id"].dataType.simpleString()

    def flush(parts):
        raw = np.concatenate([np.frombuffer(b, np.uint8) for _, _, b in parts])
        size = np.array([len(b) for _, _, b in parts])
        if size.max(initial=0) < WINDOW:
            return []
        first = np.cumsum(size) - size
        part, key, seg, s, n, rel = runs(raw, first, size)
        row = np.array([p[0] for p in parts])[part]
        s = s + np.array([p[1] for p in parts])[part]
        return [(row, key, seg, (s << 16) | (n << 8) | rel)]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n_bytes, sha, out, parts, held = [], [], [], [], 0
            for row, t in enumerate(b.column("text")):
                raw = t.as_py().encode("utf-8", "surrogatepass")
                n_bytes.append(len(raw))
                sha.append(hashlib.sha256(raw).hexdigest())
                for at in range(0, max(len(raw) - WINDOW + 1, 0), SLICE):
                    piece = raw[at:at + SLICE + WINDOW - 1]
                    parts.append((row, at, piece))
                    held += len(piece)
                    if held >= SLICE:
                        out += flush(parts)
                        parts, held = [], 0
            if parts:
                out += flush(parts)
            row, key, seg, pack = (np.concatenate([o[k] for o in out] or [np.zeros(0, np.int64)]) for k in range(4))
            ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int64))) for v in (key, seg, pack)]
            yield pa.record_batch([b.column("id"), b.column("tkey"), pa.array(n_bytes, pa.int64()), pa.array(sha), *lists],
                                  ["id", "tkey", "n_bytes", "sha", "keys", "segs", "packs"])

    out = src.mapInArrow(run, f"id {id_type}, tkey long, n_bytes long, sha string, keys array<long>, segs array<long>, packs array<long>")
    return out.withColumn("cid", F.monotonically_increasing_id())


def cut(raw: bytes, key: int, pack: int, hot: bool):
    """(shard key, offset in the segment, bytes) of a segment's parts."""
    s, n, rel = pack >> 16, (pack >> 8) & 255, pack & 255
    if not hot:
        return [(key, 0, raw[s:s + n - 1 + WINDOW])]
    p, out, t = s + n - 1 + rel, [], s
    while t < s + n:
        j = (p - t) // NARROW  # windows that start NARROW j to NARROW (j + 1) - 1 before the gram
        last = min(p - NARROW * j, s + n - 1)
        core = raw[p - NARROW * j:p - NARROW * j - NARROW + 1 + WINDOW]
        own = hashlib.blake2b(core, digest_size=8, salt=j.to_bytes(2, "little"), key=key.to_bytes(8, "little", signed=True)).digest()
        out.append((int.from_bytes(own, "little", signed=True), t - s, raw[t:last + WINDOW]))
        t = last + 1
    return out


def sorted_marks(strings: list[bytes], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """For each string the ranges [from, to) of bytes in repeated windows that suffix sorting finds."""
    from tablefit.llm.induced import Shard

    size = np.array([len(x) for x in strings])
    first = np.cumsum(size + 1) - size
    text = np.zeros(int(size.sum()) + len(strings) + 1, np.int16)
    body = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
    text[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(body))] = body
    mark = Shard(text).repeated(window)
    edge = np.flatnonzero(np.diff(mark.astype(np.int8), prepend=0, append=0))
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    for a, b in zip(edge[::2], edge[1::2]):
        k = int(np.searchsorted(first, a, "right")) - 1
        out[k].append((int(a - first[k]), int(b - 1 - first[k]) + window))
    return out


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, tkey, n_bytes, spans, kept, sha``, one row per input row: the removed byte ranges
    [start, end) in order, the bytes that stay (null where all do) and the input's SHA-256."""
    rows = keep_table(scan(docs, id_col, text_col), "suffix-runs")
    kept_rows, equal = [rows], repeated_rows(rows)
    if equal is not None:  # equal rows go by one number: they lose the same, from one text
        lowest = keep_table(equal, "suffix-equal")
        rows = keep_table(_same_row(rows, lowest).withColumn("cid", F.coalesce("low", "cid")).select(*rows.columns), "suffix-runs")
        kept_rows += [lowest, rows]
    runs_ = rows.select("cid", F.explode(F.arrays_zip("keys", "segs", "packs")).alias("r")).select(
        "cid", F.col("r.keys").alias("key"), F.col("r.segs").alias("seg"), F.col("r.packs").alias("pack"))
    # Strings that occur more than once, and whether in different segments. They are
    # joined from a written table: an aggregate by the same key would share the join's
    # partitioning, and the runs of the commonest string could not be split over tasks.
    again = keep_table(runs_.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("lo"), F.max("seg").alias("hi"))
                       .filter("n > 1").select("key", (F.col("lo") != F.col("hi")).alias("mixed")), "suffix-again")
    places = keep_table(runs_.join(again, "key"), "suffix-places")
    segments = places.filter("mixed").groupBy("key", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("cid", "pack")).alias("one"))
    segments = keep_table(segments, "suffix-segments")
    hot = segments.groupBy("key").agg(F.count(F.lit(1)).alias("different")).filter(F.col("different") > HOT)
    cuts = (segments.join(hot, "key", "left")
            .groupBy(F.col("one.cid").alias("cid"))
            .agg(F.collect_list(F.struct("key", "seg", "one.pack", F.col("different").isNotNull().alias("hot"))).alias("cuts")))
    # The texts with a string that occurs again, with the segments to cut from each.
    own = rows.select("cid", "id", "tkey") if equal is None else rows.select("cid", "id", "tkey").distinct()
    need = (own.join(places.select("cid").distinct(), "cid").join(cuts, "cid", "left")
            .withColumnRenamed("id", "__id").withColumnRenamed("tkey", "__tkey"))
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), text_key(text_col).alias("tkey"))
    texts = src.join(need, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tkey") == F.col("__tkey"))).select("cid", "text", "cuts")
    if equal is not None:  # each of n equal rows met the one entry
        texts = texts.dropDuplicates(["cid"])
    texts = keep_table(texts, "suffix-texts")
    marks = _marks(texts, segments)
    known = segments.select("key", "seg", "n").join(marks.groupBy("key", "seg").agg(F.flatten(F.collect_list("spans")).alias("spans")),
                                                   ["key", "seg"], "left")
    known = keep_table(known, "suffix-known")  # joined from a table like the strings, for one segment in very many documents
    start = F.shiftright("pack", 16)
    whole = F.struct(start.alias("a"), (start + F.shiftright("pack", 8).bitwiseAND(F.lit(255)) + (WINDOW - 1)).alias("b"))
    settled = places.filter("NOT mixed").select("cid", whole.alias("span"))
    some = places.filter("mixed").join(known, ["key", "seg"])
    found = settled.union(some.filter("n > 1").select("cid", whole.alias("span"))).union(
        some.filter("n = 1").withColumn("x", F.explode("spans"))
        .select("cid", F.struct((start + F.col("x.a")).alias("a"), (start + F.col("x.b")).alias("b")).alias("span")))
    if equal is not None:
        found = found.distinct()
    spans = found.groupBy("cid").agg(F.collect_list("span").alias("spans"))
    done = texts.select("cid", "text").join(spans, "cid").mapInArrow(_remove, f"cid long, spans {SPANS}, kept binary")
    out = keep_table(rows.select("cid", "id", "tkey", "n_bytes", "sha").join(done, "cid", "left")
                     .select("id", "tkey", "n_bytes", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), "kept", "sha"),
                     "suffix-result")
    discard(*kept_rows, again, places, segments, texts, marks, known)
    return out


def repeated_rows(rows: DataFrame) -> DataFrame | None:
    """``id, tkey, low`` (least cid) of rows that repeat ID and text, None without any."""
    found = (rows.groupBy("id", "tkey").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("low"))
             .filter("n > 1").select("id", "tkey", "low"))
    return None if found.isEmpty() else found


def _same_row(rows: DataFrame, other: DataFrame) -> DataFrame:
    other = other.withColumnRenamed("id", "__id").withColumnRenamed("tkey", "__tkey")
    return rows.join(other, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tkey") == F.col("__tkey")), "left")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` from the rows of ``removed_spans``."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return removed_spans(docs, id_col, text_col).select(
        "id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "sha").alias("kept_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text that stays, in the same columns. A character that is cut
    in two becomes U+FFFD; a null text stays null."""
    gone = (removed_spans(docs, id_col, text_col).filter("kept IS NOT NULL")
            .groupBy(F.col("id").alias("__id"), F.col("tkey").alias("__tkey")).agg(F.any_value("kept").alias("__kept")))  # equal rows lose the same
    kept = F.make_valid_utf8(F.col("__kept").cast("string"))
    return (docs.withColumn("__key", text_key(text_col))
            .join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__tkey")), "left")
            .select(*[F.coalesce(kept, F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns]))


def _pieces(hot: bool):
    """Function for ``mapInArrow``: the parts of the hot strings' segments, or of the others."""
    def pieces(batches):
        import pyarrow as pa

        for b in batches:
            out = [], [], [], [], []
            for text, cuts in zip(b.column("text"), b.column("cuts")):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for c in cuts.as_py():
                    if c["hot"] == hot:
                        for shard, offset, piece in cut(raw, c["key"], c["pack"], hot):
                            for v, x in zip(out, (shard, c["key"], c["seg"], offset, piece)):
                                v.append(x)
            yield pa.record_batch([*[pa.array(v, pa.int64()) for v in out[:4]], pa.array(out[4], pa.binary())],
                                  ["shard", "key", "seg", "offset", "piece"])

    return pieces


def _hot_marks(hot: DataFrame):
    """Pieces of ``hot`` left to sort, and the spans (``key, seg, spans``) that need no sort:
    equal pieces, folded before their bytes are shuffled, and, where more than
    ``HOT`` different ones share a shard's bytes, windows that meet as a whole."""
    folded = keep_table(hot.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "seg", "offset")).alias("one")),
                        "suffix-folded")
    span = lambda a, size: F.array(F.struct(a.alias("a"), (a + size).cast("long").alias("b"))).alias("spans")
    twice = folded.filter("n > 1").select("shard", F.md5("piece").alias("h"))
    found = (hot.select("shard", F.md5("piece").alias("h"), "key", "seg", "offset", F.length("piece").alias("size")).join(twice, ["shard", "h"])
             .select("key", "seg", span(F.col("offset"), F.col("size"))))
    # One row here per more than HOT pieces.
    many = keep_table(folded.groupBy("shard").count().filter(F.col("count") > HOT).select("shard"), "suffix-many")
    windows = keep_table(
        folded.join(F.broadcast(many), "shard")
        .select("shard", "one", "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - WINDOW)).alias("o"))
        .select("shard", F.expr(f"md5(substring(piece, o + 1, {WINDOW}))").alias("w"), "one.key", "one.seg", (F.col("one.offset") + F.col("o")).alias("at")),
        "suffix-windows")
    met = windows.groupBy("shard", "w").count().filter("count > 1").select("shard", "w")
    found = found.union(windows.join(met, ["shard", "w"]).select("key", "seg", span(F.col("at"), F.lit(WINDOW))))
    rest = folded.join(F.broadcast(many), "shard", "left_anti").select("shard", "one.key", "one.seg", "one.offset", "piece")
    return rest, found, [folded, many, windows]


def _marks(texts: DataFrame, segments: DataFrame) -> DataFrame:
    """``key, seg, spans``: what suffix sorting finds in the different segments."""
    size = segments.agg(F.sum(F.shiftright("one.pack", 8).bitwiseAND(F.lit(255)) + WINDOW).alias("b")).first()["b"] or 0
    shards = max(1, -(-size // SHARD))

    def sort(batches):
        import pyarrow as pa

        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        t = pa.Table.from_batches(rows)
        found = sorted_marks(t["piece"].to_pylist())
        hit = [k for k, f in enumerate(found) if f]
        offset = t["offset"].to_pylist()
        spans = [[{"a": a + offset[k], "b": b + offset[k]} for a, b in found[k]] for k in hit]
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        yield from pa.table([t["key"].take(pa.array(hit, pa.int64())), t["seg"].take(pa.array(hit, pa.int64())),
                             pa.array(spans, kind)], ["key", "seg", "spans"]).to_batches()

    kind = "shard long, key long, seg long, offset long, piece binary"
    cutting = texts.filter("cuts IS NOT NULL").select("text", "cuts")
    hot = keep_table(cutting.filter(F.exists("cuts", lambda c: c["hot"])).mapInArrow(_pieces(True), kind), "suffix-hot")
    rest, found, tables = _hot_marks(hot)
    ordered = (cutting.filter(F.exists("cuts", lambda c: ~c["hot"])).mapInArrow(_pieces(False), kind).union(rest)
               .repartition(shards, "shard").mapInArrow(sort, "key long, seg long, spans array<struct<a:long,b:long>>"))
    out = keep_table(ordered.union(found), "suffix-marks")
    discard(hot, *tables)
    return out


def _remove(batches):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        removed, kept = [], []
        for text, spans in zip(b.column("text"), b.column("spans")):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            out = []
            for a, e in sorted((s["a"], s["b"]) for s in spans.as_py()):
                if out and a <= out[-1]["end"]:
                    out[-1]["end"] = max(e, out[-1]["end"])
                else:
                    out.append({"start": a, "end": e})
            edges = [0, *[x for s in out for x in (s["start"], s["end"])], len(raw)]
            removed.append(out)
            kept.append(b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2])))
        yield pa.record_batch([b.column("cid"), pa.array(removed, kind), pa.array(kept, pa.binary())], ["cid", "spans", "kept"])


def query(spark, sf_dir) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
