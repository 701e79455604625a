import hashlib
from collections import Counter

from tablefit.llm import exact_dedup

from .conftest import by_row, messy_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(t):
    return (t or "").translate(LOW)


def brute(rows):
    size = Counter(norm(t) for _, t in rows)
    keep = {}
    for i, t in rows:
        k = norm(t)
        keep[k] = i if keep.get(k) is None else keep[k] if i is None else max(keep[k], i)
    out = []
    for i, t in rows:
        k = norm(t)
        own = keep[k] if size[k] > 1 else i
        out.append((i, own, size[k], i == own, hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def test_groups_match_brute_force(messy):
    got = by_row(exact_dedup.exact_groups(messy), "id", "keep_id", "group_size", "kept", "sha")
    assert got == brute(messy_rows())


def test_one_row_of_each_group_stays(messy):
    kept = exact_dedup.drop_duplicates(messy)
    assert kept.columns == messy.columns
    texts = [norm(r.text) for r in kept.select("text").collect()]
    assert sorted(texts) == sorted({norm(t) for _, t in messy_rows()})


def test_empty(empty):
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_duplicates(empty).count() == 0


def test_columns_named_like_the_operators_own_stay(spark):
    rows = [(1, "A b", "k1", 7, "g"), (2, "a B", "k2", 8, "h"), (2, "a B", "k3", 9, "h"), (3, "c", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __key string, __ID int, __gone string")
    kept = exact_dedup.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r["__key"] in ("k2", "k3", None), r["__ID"]) for r in kept.collect())[1] == (3, True, None)
    assert kept.count() == 2
