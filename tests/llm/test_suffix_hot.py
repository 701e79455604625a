import random

import pytest

from tablefit.llm import suffix_dedup

from .test_suffix import brute, got


@pytest.mark.parametrize("length", [200, 215, 260, 600])
def test_a_passage_of_many_documents_stays_out_of_one_task(spark, monkeypatch, length):
    """No shard sorts more than HOT pieces of one string, and the result is that of brute force."""
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    rng = random.Random(length)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = text(length)
    rows = [(i, text(rng.randint(20, 60)) + passage + text(rng.randint(20, 60))) for i in range(150)]
    rows += [(1000 + i, "x" + passage[:-1] + "y") for i in range(30)] + [(2000, text(900)), (2001, "ab" * 300)]
    seen, marks = [], suffix_dedup._hot_marks

    def watched(hot):
        rest, found, tables = marks(hot)
        seen.append((hot.count(), max([r["count"] for r in rest.groupBy("shard").count().collect()], default=0)))
        return rest, found, tables

    monkeypatch.setattr(suffix_dedup, "_hot_marks", watched)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)
    assert seen[0][0] > 150 and seen[0][1] <= 20
