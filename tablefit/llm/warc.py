"""WARC archives: writing, reading back, and the merged capture index.

Writing: payload digests are taken in one scan, equal payloads are grouped by
digest and length, and every page but the one with the largest ID becomes a
``revisit`` of that one. Each record is a gzip member of its own, so an index
entry (file, offset, length) opens it alone. A task gathers records up to the size
of a file, so that neither pages of megabytes nor very many small ones make a file
too large to be read as one value. The files go through Spark's text writer (its
commit protocol, any file system that Spark can write); what it puts after the
content is an empty gzip member, which readers skip.

Reading: each archive file is a capture run, sorted by URL key and timestamp
where it is read. The runs are cut at common key ranges, and each range merges
its pieces of the runs by a loser tree: read range after range, the index holds
every URL's capture history in order, with no global sort.

Defined results: a null body is an empty payload, a null URL has no target URI
and the empty key, a null ID is written without one and revisits a payload that
another page has; rows that repeat ID and body are all responses. Timestamps
come from ``date_col`` or, without one, count seconds from 2000 by ID. An empty
table writes no records. IDs are integers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import keep_table, scratch_path, ship, table, text_key, text_or_empty

EMPTY_MEMBER = gzip.compress(b"", mtime=0)
#: A file is closed at so many bytes or records, whichever comes first (a longer record has a file of its own).
FILE_BYTES = 32 << 20
RECORDS_PER_FILE = 20_000
#: Index entries merged in one range.
RANGE_ROWS = 100_000
READ_BYTES = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def warc_record(page_id, url, date: str, payload: bytes, refers_to, is_revisit: bool) -> bytes:
    """One record: headers, HTTP head and (for a response) the payload."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
            f"WARC-Record-ID: {record_name(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if is_revisit:
        head += [f"WARC-Refers-To: {record_name(refers_to, digest)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   date_col: str | None = None) -> None:
    ship(pages.sparkSession)
    body = text_or_empty(body_col)
    date = (F.date_format(F.col(date_col).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date_col
            else F.lit(None).cast("string"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        body.alias("body"), date.alias("date"), text_key(body_col).alias("key"))
    narrow = keep_table(rows.select("id", "key", F.octet_length("body").alias("len"),
                                    F.sha1(F.col("body").cast("binary")).alias("sha")), "warc-digests")
    first = narrow.groupBy("sha", "len").agg(F.max("id").alias("refers"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A table of known size: Spark broadcasts it when it is small, else joins by shuffle.
    revisits = keep_table(narrow.join(first, ["sha", "len"]).filter(~F.col("id").eqNullSafe(F.col("refers")))
                          .select(F.col("id").alias("rid"), F.col("key").alias("rkey"), "refers").distinct(), "warc-revisits")
    joined = rows.join(revisits, F.col("id").eqNullSafe(F.col("rid")) & (F.col("key") == F.col("rkey")), "left")

    most_bytes, most_records = FILE_BYTES, RECORDS_PER_FILE

    def run(batches):
        import pyarrow as pa

        def file():
            return pa.record_batch([pa.array([b"".join(held)], pa.binary())], ["content"])

        held, size = [], 0
        for b in batches:
            for page, url, text, day, refers, key in zip(*(b.column(c) for c in ("id", "url", "body", "date", "refers", "rkey"))):
                page = page.as_py()
                day = day.as_py() or (EPOCH + timedelta(seconds=page or 0)).strftime("%Y-%m-%dT%H:%M:%SZ")
                rec = gzip.compress(warc_record(page, url.as_py(), day, text.as_py().encode("utf-8", "surrogatepass"), refers.as_py(),
                                                key.is_valid), 6, mtime=0)
                if held and (size + len(rec) > most_bytes or len(held) == most_records):
                    yield file()
                    held, size = [], 0
                held.append(rec)
                size += len(rec)
        if held:
            yield file()

    (joined.select("id", "url", "body", "date", "refers", "rkey").mapInArrow(run, "content binary")
     .select(F.col("content").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("maxRecordsPerFile", 1).text(path))


def members(data: bytes):
    """(offset, length, content) of each gzip member that holds something."""
    at, end = 0, len(data)
    view = memoryview(data)
    while at < end:
        z, begin, parts = zlib.decompressobj(31), at, []
        while not z.eof and at < end:
            chunk = view[at:at + READ_BYTES]
            parts.append(z.decompress(chunk))
            at += len(chunk)
        at -= len(z.unused_data)
        content = b"".join(parts)
        if content:
            yield begin, at - begin, content


def parse_record(rec: bytes) -> dict:
    head, _, rest = rec.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    h = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = h["warc-type"]
    return {"type": kind, "record": h["warc-record-id"], "uri": h.get("warc-target-uri"), "date": h["warc-date"],
            "id": int(h["x-page-id"]) if "x-page-id" in h else None, "refers": h.get("warc-refers-to"),
            # Of a response, what its payload says; of a revisit, what it declares.
            "bytes": len(payload) if kind == "response" else size,
            "digest": base32_sha1(payload) if kind == "response" else h["warc-payload-digest"][5:]}


def url_key(uri: str | None) -> str:
    """Host labels from the top domain down, then path and query; no scheme or fragment."""
    if not uri:
        return ""
    rest = uri.partition("#")[0].partition("://")[2] or uri
    host, slash, tail = rest.partition("/")
    host = host.lower().partition(":")[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + slash + tail


INDEX = ("url_key string, date string, id long, run string, offset long, length long, type string, record string, "
         "refers string, bytes long, digest string")
NAMES = [f.split()[0] for f in INDEX.split(", ")]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of each archive file, sorted by (url_key, date, id) within the file."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import pyarrow as pa

        schema = _arrow(INDEX)
        for b in batches:
            for name, data in zip(b.column("path"), b.column("content")):
                rows = []
                for offset, length, content in members(data.as_py()):
                    r = parse_record(content)
                    rows.append({"url_key": url_key(r["uri"]), "run": name.as_py(), "offset": offset, "length": length} | r)
                rows.sort(key=order)
                yield pa.RecordBatch.from_pylist([{c: r[c] for c in NAMES} for r in rows], schema)

    return files.mapInArrow(run, INDEX)


def _arrow(ddl: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def order(r) -> tuple:
    return r["url_key"], r["date"], r["id"] is None, r["id"] or 0, r["run"], r["offset"]


class LoserTree:
    """k-way merge: inner nodes keep the losers, each step replays one path."""

    def __init__(self, runs, key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.head = [self._pull(i) for i in range(self.k)]
        self.loser = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._replay(i, fill=True)

    def _pull(self, i):
        row = next(self.runs[i], None)
        return None if row is None else (self.key(row), i, row)

    def _less(self, i, j) -> bool:
        a, b = self.head[i], self.head[j]
        return b is None or a is not None and a[:2] < b[:2]

    def _replay(self, i, fill=False):
        node = (i + self.k) >> 1
        while node:
            other = self.loser[node]
            if other < 0 and fill:
                self.loser[node] = i
                return
            if other >= 0 and self._less(other, i):
                self.loser[node], i = i, other
            node >>= 1
        self.loser[0] = i

    def __iter__(self):
        while self.k and (top := self.head[w := self.loser[0]]) is not None:
            yield top[2]
            self.head[w] = self._pull(w)
            self._replay(w)


def merged_index(runs: DataFrame) -> DataFrame:
    """All entries in the order of (url_key, date, id): one partition a key range, ranges in order."""
    runs = keep_table(runs, "capture-runs")
    parts = max(1, -(-runs.count() // RANGE_ROWS))

    def run(batches):
        import pyarrow as pa

        by_run: dict[str, list] = {}
        for b in batches:
            for r in b.to_pylist():
                by_run.setdefault(r["run"], []).append(r)
        for rows in by_run.values():  # a piece of a run comes as its file had it; else put it in order
            if any(order(x) > order(y) for x, y in zip(rows, rows[1:])):
                rows.sort(key=order)
        out = []
        for r in LoserTree([by_run[k] for k in sorted(by_run)], order):
            out.append(r)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, _arrow(INDEX))
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _arrow(INDEX))

    # Date and ID in the range key split a URL or host that holds a third of the captures.
    return runs.repartitionByRange(parts, "url_key", "date", "id", "offset").mapInArrow(run, INDEX)


def captures(index: DataFrame) -> DataFrame:
    """The index with ``refers_id``, the ID of the page that a revisit refers to."""
    named = index.filter("type = 'response'").select(F.col("record").alias("refers"), F.col("id").alias("refers_id")).distinct()
    return index.join(named, "refers", "left")


def query(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    index = keep_table(merged_index(capture_runs(spark, path)), "capture-index")
    return captures(index).select(F.col("id").alias("page_id"), F.col("bytes").alias("payload_bytes"),
                                  F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                                  F.col("refers_id").alias("refers_to"))
