import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablefit.llm import packing, token_counts

from .conftest import by_row, messy_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)


def ids(t):
    return TOK.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_and_pieces_as_the_library_gives_them(text):
    from tablefit.llm.tokens import id_encoder, piece_counter

    spec = open(PATH, encoding="utf-8").read()
    split, count = piece_counter(spec)
    for t in (text, text + "<|endoftext|>  " + text):
        assert list(id_encoder(spec)(t)) == ids(t)
        words, special = split(t)
        assert sum(count(words)) + special == len(ids(t))


def test_token_counts(messy, empty):
    got = by_row(token_counts.token_counts(messy, PATH), "id", "n_bytes", "n_tokens")
    want = [(i, len((t or "").encode()), len(ids(t))) for i, t in messy_rows()]
    assert got == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))
    assert token_counts.token_counts(empty, PATH).count() == 0


def test_packing_covers_every_id_once(messy, empty):
    pieces = packing.pack(packing.cut(messy, PATH, with_ids=True)).cache()
    rows = pieces.collect()
    want = sorted(((i if i is not None else -1), len(ids(t)) + 1) for i, t in messy_rows())
    got = sorted(((r.id if r.id is not None else -1), r.doc_tokens) for r in rows if r.start == 0)
    assert got == want
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) <= packing.WINDOW
    of = {}
    for r in rows:
        of.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    whole = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    assert set(whole) == set(of) and all(len(r.input_ids) == packing.WINDOW for r in whole.values())
    one = next(r for r in rows if r.offset > 0)
    assert whole[one.sequence_id].input_ids[one.offset:one.offset + one.length] == one.ids
    assert packing.pack(packing.cut(empty, PATH)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_decreasing_matches_a_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    where, offset = packing.best_fit_decreasing(lengths, 40)
    open_ = []  # remaining capacities
    for n, w, o in zip(lengths, where, offset):
        fits = [c for c in open_ if c >= n]
        rest = min(fits) if fits else 40
        assert 40 - o == rest  # the tightest window that holds it
        if fits:
            open_.remove(rest)
        open_.append(rest - n)
    assert len(set(where)) == len(open_)


def long_white_space():
    n = 3_000_000
    mixed = (" \n\t\r\n  　" * n)[:n]
    return [" " * n + "a", "\n" * n, mixed + "word", "x" + "\n" * n + " y  z" + " " * n, mixed, "a" + " " * 100_000 + "<|endoftext|>" + "\n" * 99_999 + "b",
            ("b" + " " * 99_999) * 3 + "\x1c" * 120_000 + " c", " " * 100_000 + "\n" * 100_000 + "é"]


def test_long_white_space_is_no_error():
    from tablefit.llm.tokens import id_encoder

    encode = id_encoder(open(PATH, encoding="utf-8").read())
    for t in long_white_space():
        assert list(encode(t)) == ids(t), repr(t[:10])


def test_packing_of_long_white_space(spark):
    texts = long_white_space()[:4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in packing.pack_documents(docs, PATH).groupBy("doc_id").agg({"length": "sum"})
           .withColumnRenamed("sum(length)", "n").collect()}
    assert got == {k: len(ids(t)) + 1 for k, t in enumerate(texts)}
