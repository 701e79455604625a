import random

import numpy as np

from tablefit.llm import decontaminate as d


def norm(t):
    return d.normalise(np.frombuffer((t or "").encode().replace(b"\0", b" "), np.uint8)).tobytes()


def distance(item, doc):
    """Edits between the item and the best substring of the document."""
    prev = [0] * (len(doc) + 1)
    for i in range(1, len(item) + 1):
        cur = [i] + [0] * len(doc)
        for j in range(1, len(doc) + 1):
            cur[j] = min(prev[j - 1] + (item[i - 1] != doc[j - 1]), prev[j] + 1, cur[j - 1] + 1)
        prev = cur
    return min(prev)


def edited(rng, item, n):
    it = list(item)
    for _ in range(n):
        p = rng.randrange(len(it))
        it[p:p + 1] = rng.choice([[], [rng.choice("abc ")], [it[p], rng.choice("abc ")]])
    return "".join(it)


def test_matches_full_alignment(spark, monkeypatch):
    monkeypatch.setattr(d, "CHUNK_BYTES", 300)
    rng = random.Random(1)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    items = [text(rng.randint(40, 90)) for _ in range(6)] + [None, "", "short", "abc, DEF", "same item twice, all of it", "same item twice, all of it"]
    docs = [text(rng.randint(0, 60)) + " " + edited(rng, rng.choice(items[:6]), rng.randint(0, 12)) + " " + text(rng.randint(0, 60))
            for _ in range(60)]
    docs += [None, "", " ", "xx ABC def yy", "Same  item\ttwice -- all of it!", "\0", items[0] + "\0" + items[1], docs[0]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(docs)] + [(None, items[2], 0, "")],
                               "doc_id long, text string, item_id int, key string").repartition(3)
    got = {(r.id, r.item_id): r.edits for r in d.leaks(df, bench).collect()}
    want = {}
    for i, t in [*enumerate(docs), (None, items[2])]:
        for k, item in enumerate(items):
            a = norm(item)
            if len(a) >= d.Q and (e := distance(a, norm(t))) <= d.budget(len(a)):
                want[i, k] = e
    assert got == want and len(set(want.values())) > 3
    kept = d.drop_leaked(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(docs))) - {i for i, _ in want})


def test_empty(messy, empty, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.leaks(messy, bench).count() == 0
    assert d.leaks(empty, spark.createDataFrame([(1, "some item of a benchmark")], "item_id long, text string")).count() == 0


def test_blocks_of_items_give_the_same(spark, messy, monkeypatch):
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(["one two three four five", "x y x y x y x y", "a" * 60])], "item_id long, text string")
    one = sorted((str(r.id), r.item_id, r.edits) for r in d.leaks(messy, bench).collect())
    monkeypatch.setattr(d, "BLOCK_BYTES", 20)
    assert one and sorted((str(r.id), r.item_id, r.edits) for r in d.leaks(messy, bench).collect()) == one


def search(items, docs):
    x = d.normalise(np.frombuffer(b"\0".join(t.encode() for t in docs), np.uint8))
    return d.Items(items, d.EDIT_SHARE).search(x, np.concatenate([[0], np.flatnonzero(x == 0) + 1]))


def test_repetitive_texts_need_bounded_memory():
    import tracemalloc

    line = "the same line of a page, over and over again. "
    items = ["a" * 6_000, line * 40]
    tracemalloc.start()
    got = search(items, ["a" * 1_000_000, line * 10_000, "nothing of the kind"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 28
    assert {(doc, i): e for doc, i, e, _ in got} == {(0, 0): 0, (1, 1): 0}


def test_counted_bands_and_windows_change_nothing(monkeypatch):
    rng = random.Random(5)
    for t in range(6):
        items = ["".join(rng.choice("ab") for _ in range(rng.randint(8, 14))) * rng.randint(1, 6) for _ in range(4)] + ["a" * 70]
        docs = ["".join(rng.choice(["ab", "a", "b", *items]) for _ in range(rng.randint(0, 12))) for _ in range(3)] + ["a" * 300, "x"]
        for name, value in (("HEAVY", 1 << 16), ("PAIRS", 1 << 21), ("CHUNK_BYTES", 2 << 20)):
            monkeypatch.setattr(d, name, value)
        want = search(items, docs)
        monkeypatch.setattr(d, "HEAVY", 3)
        monkeypatch.setattr(d, "PAIRS", 50)
        assert search(items, docs) == want
        monkeypatch.setattr(d, "CHUNK_BYTES", 100)
        assert [m[:3] for m in search(items, docs)] == [m[:3] for m in want]
        for doc, i, e, _ in want:
            assert t > 1 or e == distance(norm(items[i]), norm(docs[doc]))
