import base64
import glob
import gzip
import hashlib
import random

from tablefit.llm import warc
from tablefit.session import scratch_path

ROWS = [(1, "http://a.com/x", "<p>é</p>"), (2, "http://a.com/x", "<p>é</p>"), (3, None, None), (4, "http://b.com/", ""),
        (None, "http://c.org", "<p>é</p>"), (7, "https://www.z.net/q?x=1#f", "a\r\n\r\nWARC/1.1\r\n\x00" * 50), (8, "u\nv", "z"),
        (8, "u\nv", "z"), (9, "http://long.org", "w" * 300_000)]
ROWS += [(100 + i, f"http://h{i % 7}.com/{i % 5}", f"body {i % 40}") for i in range(200)]


def archives(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, body string, refers string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df.repartition(parts), path)
    return path


def test_round_trip(spark):
    path = archives(spark, ROWS)
    index = warc.merged_index(warc.capture_runs(spark, path)).cache()
    order = [warc.order(r.asDict()) for r in index.collect()]
    assert order == sorted(order) and len(order) == len(ROWS)
    keep = {}
    for i, _, h in ROWS:
        keep[h or ""] = max(keep.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in ROWS:
        raw, k = (h or "").encode(), keep[h or ""]
        want.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if i == k else "revisit", str(None if i == k else k)))
    got = [(str(r.id), r.bytes, r.digest, r.type, str(r.refers_id)) for r in warc.captures(index).collect()]
    assert sorted(got) == sorted(want)


def test_an_entry_opens_its_record_alone(spark):
    path = archives(spark, ROWS[:9], 2)
    for r in warc.capture_runs(spark, path).collect():
        data = open(r.run.replace("file:", ""), "rb").read()[r.offset:r.offset + r.length]
        rec = gzip.decompress(data)
        assert rec.startswith(b"WARC/1.1\r\n") and rec.endswith(b"\r\n\r\n")
        assert warc.parse_record(rec)["record"] == r.record
    whole = b"".join(gzip.open(f).read() for f in glob.glob(path.replace("file:", "") + "/part-*"))
    assert whole.count(b"WARC-Record-ID: ") == 9


def test_files_are_closed_by_bytes_and_by_records(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, f"http://h.org/{i}", "".join(chr(rng.randrange(32, 0x700)) for _ in range(rng.choice([5, 900, 6_000])))) for i in range(120)]
    rows.append((120, "http://h.org/long", "".join(chr(rng.randrange(32, 0x700)) for _ in range(60_000))))

    def sizes(path):
        index = warc.capture_runs(spark, path).collect()
        assert sorted(r.id for r in index) == list(range(121))
        per = {}
        for r in index:
            per.setdefault(r.run, []).append(r.length)
        return per

    whole = sizes(archives(spark, rows, 2))
    assert len(whole) <= 2
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    cut = sizes(archives(spark, rows, 2))
    assert len(cut) > 10 and all(sum(x) <= 20_000 or len(x) == 1 for x in cut.values()) and max(map(sum, cut.values())) > 20_000
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 30)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    cut = sizes(archives(spark, rows, 2))
    assert len(cut) >= 18 and max(map(len, cut.values())) == 7


def test_empty_table(spark):
    path = archives(spark, [], 1)
    assert warc.merged_index(warc.capture_runs(spark, path)).count() == 0


def test_loser_tree():
    rng = random.Random(2)
    for k in range(0, 9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: (x,))) == sorted(x for r in runs for x in r)


def test_url_key():
    assert warc.url_key("https://www.Example.com:80/a/B?q=1#z") == "com,example)/a/B?q=1"
    assert warc.url_key(None) == "" and warc.url_key("x") == "x)"
