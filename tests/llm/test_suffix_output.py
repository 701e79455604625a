from collections import Counter

from tablefit.llm import suffix_dedup

from .conftest import messy_rows


def cut(rows, w=suffix_dedup.WINDOW):
    """(id, spans, kept bytes) of each row."""
    raws = [(t or "").encode() for _, t in rows]
    n = Counter(r[i:i + w] for r in raws for i in range(len(r) - w + 1))
    for (d, _), r in zip(rows, raws):
        spans = []
        for i in range(len(r) - w + 1):
            if n[r[i:i + w]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + w
                else:
                    spans.append([i, i + w])
        gone = {k for a, b in spans for k in range(a, b)}
        yield d, spans, bytes(c for k, c in enumerate(r) if k not in gone)


def test_spans_and_kept_bytes(messy):
    got = sorted((str(r.id), str([[s.start, s.end] for s in r.spans]), r.n_bytes, r.kept and bytes(r.kept))
                 for r in suffix_dedup.removed_spans(messy).collect() if r.spans)
    size = {str(d): 0 for d, _ in messy_rows()}
    want = [(str(d), str(s), k) for d, s, k in cut(messy_rows()) if s]
    assert [(i, s, k) for i, s, _, k in got] == sorted(want) and len(want) > 5 and set(i for i, *_ in got) <= set(size)


def test_cleaned_text_in_the_columns_of_the_input(messy, empty):
    out = suffix_dedup.deduplicate(messy)
    assert out.schema == messy.schema
    want = [(str(d), None if t is None else k.decode("utf-8", "replace")) for (d, t), (_, _, k) in zip(messy_rows(), cut(messy_rows()))]
    assert sorted(map(str, ((str(r.doc_id), r.text) for r in out.collect()))) == sorted(map(str, want))
    assert suffix_dedup.deduplicate(empty).count() == 0
