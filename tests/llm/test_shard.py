from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablefit.llm import shard
from tablefit.session import scratch_path

from .conftest import messy_rows


def check_law(out, n_shards, total):
    rows = out.select("shard", "slot").collect()
    n = Counter(r.shard for r in rows)
    assert len(rows) == total and max(n.get(s, 0) for s in range(n_shards)) - min(n.get(s, 0) for s in range(n_shards)) <= 1
    for s in range(n_shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n.get(s, 0)))


def test_rows_are_kept_and_shards_even(messy):
    out = shard.shards(messy, 4).cache()
    check_law(out, 4, len(messy_rows()))
    got = Counter((r.doc_id, r.text) for r in out.select("rec.doc_id", "rec.text").collect())
    assert got == Counter(messy_rows())


def test_a_third_of_the_rows_alike_spread_over_buckets(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    path = scratch_path(spark, "t")
    shard.write_buckets(df.repartition(4), path, bucket_bytes=4000)  # whole rows, 20 bytes each
    buckets = spark.read.parquet(path)
    hot = [r["count"] for r in buckets.filter("rec.doc_id = 0").groupBy("bucket").count().collect()]
    assert len(hot) == 15 and max(hot) < 130  # 1000 rows over 15 buckets
    out = shard.read_shards(spark, path, 16)
    check_law(out, 16, 3000)
    order = [r.doc_id for r in out.filter("shard = 3").orderBy("slot").select("rec.doc_id").collect()]
    assert order != sorted(order)


def order_of(df, **more):
    path = scratch_path(df.sparkSession, "t")
    shard.write_buckets(df, path, bucket_bytes=2000, **more)
    out = df.sparkSession.read.parquet(path)
    rows = sorted((r.at, r.bucket, r.pos, tuple(r.rec)) for r in out.collect())
    assert [r[0] for r in rows] == list(range(len(rows)))
    assert rows == sorted(rows, key=lambda r: r[1:3])
    return [r[3] for r in rows]


@pytest.mark.parametrize("tasks", [10_000, 3])
def test_records_and_seed_fix_the_permutation(spark, monkeypatch, tasks):
    """Whatever the files, the session's partitions and the buckets of a task; with records held many times."""
    monkeypatch.setattr(shard, "MAX_TASKS", tasks)
    monkeypatch.setattr(shard, "STEP", 64)
    rows = [(i, f"text {i % 50}" * (i % 7), None) for i in range(900)] + [(5000, "copy", "x")] * 400 + [(None, None, None)] * 70
    df = spark.createDataFrame(rows, "doc_id long, text string, d string")
    one = order_of(df.repartition(2))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert order_of(df.repartition(3, "text")) == one
        assert order_of(df.orderBy(F.desc("doc_id")).coalesce(1)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter(one) == Counter(rows)
    assert order_of(df, seed=8) != one
    spread = [k for k, r in enumerate(one) if r[0] == 5000]
    assert spread[0] < 150 and spread[-1] > len(rows) - 150 and len({b - a for a, b in zip(spread, spread[1:])}) > 5


def test_wide_columns_count_in_a_bucket(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("w" * 5000).alias("page"),
                                F.array(F.lit("v" * 1000)).alias("parts"))
    path = scratch_path(spark, "t")
    shard.write_buckets(df, path, bucket_bytes=20_000)
    assert spark.read.parquet(path).select("bucket").distinct().count() >= 8


def test_one_shuffle_carries_the_records_and_none_reads_them(spark, messy):
    out = shard.shards(messy, 4)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_more_shards_than_rows_and_empty(spark, messy, empty):
    check_law(shard.shards(messy.limit(3), 16), 16, 3)
    assert shard.shards(empty).count() == 0
