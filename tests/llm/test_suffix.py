import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablefit.llm import suffix_dedup
from tablefit.llm.induced import Shard

from .conftest import messy_rows


def shard_of(strings):
    out = [np.zeros(1, np.int16)]
    for s in strings:
        out += [np.frombuffer(s, np.uint8).astype(np.int16) + 1, np.zeros(1, np.int16)]
    return np.concatenate(out)


@pytest.mark.parametrize("memory", [5, 10**6])
def test_repeats_by_induced_sorting(memory):
    """Also with queues that go to disk all the time."""
    rng = random.Random(memory)
    for _ in range(120):
        letters, length = rng.choice([b"a", b"ab", b"abc", bytes(range(256))]), rng.choice([1, 2, 5, 9])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 8))]
        strings += [rng.choice(strings)[rng.randint(0, 3):] or b"x" for _ in range(rng.randint(0, 3))]
        at, places = 1, defaultdict(list)
        for s in strings:
            for i in range(len(s) - length + 1):
                places[s[i:i + length]].append(at + i)
            at += len(s) + 1
        want = sorted(p for v in places.values() if len(v) > 1 for p in v)
        assert list(np.flatnonzero(Shard(shard_of(strings), memory).repeated(length))) == want


def brute(rows, w=suffix_dedup.WINDOW):
    raws = [(t or "").encode() for _, t in rows]
    n = Counter(hash(r[i:i + w]) for r in raws for i in range(len(r) - w + 1))
    out = []
    for (d, _), r in zip(rows, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - w + 1):
            if n[hash(r[i:i + w])] > 1:
                gone[i:i + w] = b"\1" * w
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((str(d), len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_spans(df).collect())


def test_messy(messy, empty):
    assert got(messy) == brute(messy_rows())
    assert suffix_dedup.repeated_spans(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 2048])
def test_shared_passages(spark, monkeypatch, hot):
    """With strings dealt by the bytes of neighbouring windows, and without."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    base = [text(900) for _ in range(4)]
    rows = []
    for i in range(80):
        b, a = rng.choice(base), rng.randrange(0, 600)
        rows.append((i, text(rng.randint(0, 150)) + b[a:a + rng.randint(150, 500)] + text(rng.randint(0, 150))))
    rows += [(100, "ab" * 300), (101, "x" * 199), (102, "x" * 200), (103, text(2500))]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_many_equal_rows_are_read_once(spark, monkeypatch):
    """Rows equal in ID and text, null IDs too: as brute force says, with one text for each."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    own, shared = text(700), text(400)
    rows = [(None, own)] * 60 + [(7, own[:350] + shared)] * 5 + [(8, shared + text(120)), (None, None), (None, None), (9, "short"), (9, "short")]
    sizes = {}
    real = suffix_dedup.keep_table

    def counted(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "keep_table", counted)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)
    assert sizes["suffix-texts"] == 3 and sizes["suffix-result"] == len(rows)
