import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tablefit.llm import decontaminate, exact_dedup, jaccard_join, quality
from tablefit.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SF).cache()
        seen.append((name, docs.count()))
        if name != "packing":
            assert docs.columns == columns and docs.exceptAll(before).isEmpty()
    n = dict(seen)
    assert docs.select("doc_id").distinct().count() == n["decontaminate"] > 0
    assert n["quality"] >= n["exact_dedup"] >= n["near_dedup"] >= n["decontaminate"]
    assert corpus_pipeline.run(spark, SF).count() == n["packing"]


def test_each_stage_does_the_whole_job(spark):
    docs = table(spark, SF, "documents")
    good = corpus_pipeline.quality_stage(spark, docs, SF)
    scores = quality.scores(docs, table(spark, SF, "labels"))
    assert good.count() == scores.filter("predicted = 1").count()
    once = corpus_pipeline.exact_dedup_stage(spark, docs, SF)
    assert exact_dedup.exact_groups(once).filter("group_size > 1").isEmpty()
    apart = corpus_pipeline.near_dedup_stage(spark, once, SF)
    assert jaccard_join.jaccard_components(apart, k=5, pct=80).filter("id != component_id").isEmpty()
    clean = corpus_pipeline.decontaminate_stage(spark, docs, SF)
    assert decontaminate.leaks(clean, table(spark, SF, "benchmark")).isEmpty()


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def test_copies_and_near_copies_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    groups = defaultdict(list)
    for i, text in rows_of(docs).items():
        groups[text.translate(LOW)].append(i)
    once = corpus_pipeline.exact_dedup_stage(spark, docs, SF)
    texts = rows_of(once)
    assert set(texts) == {max(g) for g in groups.values()} and len(texts) < docs.count()

    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOW))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    kept = rows_of(corpus_pipeline.near_dedup_stage(spark, once, SF))
    assert sorted(root(i) for i in kept) == sorted({root(i) for i in sets}) and len(kept) < len(sets)


def test_packed_pieces_against_the_tokenizer(spark):
    docs = table(spark, SF, "documents")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, filled = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.packing_stage(spark, docs, SF).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
        filled[r.sequence_id].append((r.offset, r.length))
    texts = rows_of(docs)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for start, length, crc in sorted(pieces[i]):
            assert start == at and crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
