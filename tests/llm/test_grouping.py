import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablefit.llm import grouping
from tablefit.llm.grouping import best_fit, crossover, evolve, lower_bound, merit, mutated, packed
from tablefit.llm.packing import sequences
from tablefit.llm.tokens import word_encoder

from .conftest import messy_rows

VOCAB = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def spec():
    return open(VOCAB, encoding="utf-8").read()


def test_ids_equal_the_library(spec):
    tok, encode = Tokenizer.from_str(spec), word_encoder(spec)
    texts = [t or "" for _, t in messy_rows()]
    texts += ["<|endoftext|>", "a <|startoftext|>B<|ENDOFTEXT|> x", "İx'LL don't IT'S ΣΑΣ", "J̌", "\x1c\x85a᠎b​c", "é" * 70_000,
              " " * 3_000_000 + "a", "\n \t" * 1_000_000, "ab" * 600_000, "word, " * 300_000, "😀👍🏽 ok", "丂𠀀𠀁"]
    texts += [f"a{chr(c)}b {chr(c)}́{chr(c)}" for c in [*range(0x3000), *range(0xa640, 0xa800), *range(0x10d00, 0x10e00), *range(0x1f300, 0x1fb00)]]
    for t, e in zip(texts, tok.encode_batch_fast(texts, add_special_tokens=False)):
        assert list(encode(t)) == e.ids, t[:40]


def test_other_layouts_go_through_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    spec = open(path, encoding="utf-8").read()
    tok = Tokenizer.from_str(spec)
    for t in ("Hello  World <|endoftext|>", "", "é\n\n x"):
        assert list(word_encoder(spec)(t)) == tok.encode(t, add_special_tokens=False).ids


def triplets(rng, n, window):
    """Items of which every three fill a window: n bins are the optimum."""
    a = rng.integers(window * 38 // 100, window * 49 // 100, n)
    b = np.array([rng.integers(window // 4, (window - x) // 2 + 1) for x in a])
    return -np.sort(-np.concatenate([a, b, window - a - b]))


def valid(genome, lengths, window):
    fill = np.bincount(genome, lengths)
    return genome.min() == 0 and fill.max() <= window and fill.min() > 0


def test_operators_keep_items_and_capacity():
    rng = np.random.default_rng(2)
    x = triplets(rng, 60, 1000)
    sizes = x.tolist()
    a, b = packed(sizes, range(len(x)), 1000), packed(sizes, rng.permutation(len(x)).tolist(), 1000)
    for _ in range(50):
        child = crossover(a, b, x, sizes, 1000, rng)
        assert valid(child, x, 1000) and valid(mutated(child, x, sizes, 1000, rng), x, 1000)
        # Some of the father's bins are in the child as they were.
        groups = {frozenset(np.flatnonzero(child == k)) for k in range(child.max() + 1)}
        assert groups & {frozenset(np.flatnonzero(b == k)) for k in range(b.max() + 1)}


def test_best_fit_takes_the_tightest_bin():
    fill, genome = [6, 8, 3], [-1] * 3
    best_fit([0, 1, 2], [2, 4, 7], fill, genome, 10)
    assert genome == [1, 0, 2] and fill == [10, 10, 10]


def test_bound_and_evolution():
    rng = np.random.default_rng(7)
    for _ in range(200):  # against the optimum of tiny instances
        x = rng.integers(1, 11, rng.integers(1, 7))
        best = min(merit(packed(x.tolist(), p, 10), x)[0] for p in [rng.permutation(len(x)).tolist() for _ in range(60)])
        assert lower_bound(x, 10) <= best
    assert lower_bound(np.array([6, 6, 6]), 10) == 3 and lower_bound(np.array([5, 5, 5]), 10) == 2 and lower_bound(np.array([], int), 10) == 0
    x = triplets(rng, 100, 1000)
    first = packed(x.tolist(), range(len(x)), 1000)
    others = [packed(x.tolist(), np.argsort(-x * (1 - 0.3 * rng.random(len(x)))).tolist(), 1000) for _ in range(7)]
    out = evolve([first, *others], x, 1000, lower_bound(x, 1000), np.random.default_rng(0), 60)
    assert merit(out[0], x)[0] < merit(first, x)[0]
    assert all(valid(g, x, 1000) for g in out)


def test_islands_beat_best_fit_decreasing(spark):
    x = triplets(np.random.default_rng(5), 150, 1000)
    cut = spark.createDataFrame([(k, int(v)) for k, v in enumerate(x)], "id long, length long").repartition(3)
    got = grouping.pack(cut, 1000, bins=60, generations=20)
    rows = got.collect()
    assert sorted(r["id"] for r in rows) == list(range(450))
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 1000)
    assert len({r["sequence_id"] for r in rows}) < merit(packed(x.tolist(), range(450), 1000), x)[0]
    again = grouping.pack(cut, 1000, bins=60, generations=20).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def check_sequences(rows, window):
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window


def test_documents(spark, messy, spec):
    encode = word_encoder(spec)
    rows = grouping.pack_documents(messy, VOCAB, window=512, with_ids=True).collect()
    want = {}
    for i, t in messy_rows():
        ids = np.append(encode(t or ""), np.uint32(1)).astype("<u4")
        for p in range(-(-len(ids) // 512)):
            part = ids[p * 512:(p + 1) * 512]
            want.setdefault((i, p, p * 512, len(part), zlib.crc32(part.tobytes())), []).append(part.tolist())
    got = {}
    for r in rows:
        got.setdefault((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]), []).append(list(r["ids"]))
    assert got == want
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 512)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 512) + 2


def test_hot_lengths_and_levels(spark):
    # A third of all pieces are equal rows; most blocks are closed at the first level.
    cut = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
                                   F.when(F.col("id") % 3 == 0, 333).otherwise(1 + F.col("id") * 7919 % 900).alias("length").cast("long"))
    rows = grouping.pack(cut, 1000, bins=50, generations=2).select("sequence_id", "offset", "length").collect()
    assert len(rows) == 6000
    check_sequences([tuple(r) for r in rows], 1000)
    assert len({r[0] for r in rows}) <= sum(r[2] for r in rows) / 1000 * 1.03


def test_sequences_and_empty(spark, empty):
    assert grouping.pack_documents(empty, VOCAB).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "x " * 40)], "doc_id long, text string")
    got = sequences(grouping.pack_documents(docs, VOCAB, window=16, with_ids=True), 16).collect()
    assert sum(r["n_ids"] for r in got) == 4 + 1 + 41 and all(len(r["input_ids"]) == 16 for r in got)
    ones = spark.createDataFrame([(k, None) for k in range(300)], "doc_id long, text string")
    assert grouping.pack_documents(ones, VOCAB, window=16).select("sequence_id").distinct().count() == 19
