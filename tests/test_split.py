"""Splits: disjoint + covering, partition independence, exact sizes vs brute force."""

import math
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablefit.operators import checks, split


def _ids(df, col="id"):
    return {r[0] for r in df.select(col).collect()}


def _orders_like(spark, n=237):
    """Unequal parts, text payload, IDs not from zero."""
    return spark.range(1000, 1000 + 3 * n, 3).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("payload"))


@pytest.mark.parametrize("method", ["hash", "random"])
def test_both_sides_together_are_the_table(spark, method):
    df = _orders_like(spark)
    tr, sc = split.split_train_scoring(df, "k", 0.3, 9, method=method)
    assert tr.intersect(sc).isEmpty() and tr.union(sc).exceptAll(df).isEmpty() and tr.count() + sc.count() == df.count()
    assert checks.expect_split_integrity(df, tr, sc, "k").first()["passed"]


def test_a_null_id_has_a_side(spark):
    df = spark.createDataFrame([(None,), (4,), (None,), (9,), (12,)], "k long")
    tr, sc = split.split_train_scoring(df, "k", 0.5)
    assert tr.count() + sc.count() == 5
    assert {tr.filter("k IS NULL").count(), sc.filter("k IS NULL").count()} == {0, 2}


def test_hash_split_is_partition_independent(spark, reg):
    a = _ids(split.split_train_scoring(reg.repartition(3), "row_id")[0], "row_id")
    b = _ids(split.split_train_scoring(reg.repartition(7), "row_id")[0], "row_id")
    assert a == b
    assert 0.4 < len(a) / reg.count() < 0.6


def test_exact_holdout_matches_full_sort(spark):
    df = spark.range(0, 5003).withColumnRenamed("id", "k").repartition(4)
    rest, held = split.exact_holdout(df, "k", 0.2, 42)
    ranked = (df.select("k", split.hash_u32("k", 42).alias("h")).orderBy("h", "k")
              .limit(math.ceil(0.2 * 5003)))
    assert _ids(held, "k") == _ids(ranked, "k")
    assert held.count() == 1001 and rest.count() == 5003 - 1001


def test_stratified_exact_per_stratum(spark):
    df = spark.range(0, 999).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    tr, sc = split.stratified_split(df, "k", ["s"], 0.3, 7)
    counts = {r["s"]: r["count"] for r in tr.groupBy("s").count().collect()}
    assert counts == {0: 100, 1: 100, 2: 100}
    assert tr.count() + sc.count() == 999


def test_first_and_sample_k(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    assert [r[0] for r in split.first_k(df, "k", 5).collect()] == [0, 1, 2, 3, 4]
    s1 = [r[0] for r in split.sample_k(df.repartition(3), "k", 4, 1).collect()]
    s2 = [r[0] for r in split.sample_k(df.repartition(5), "k", 4, 1).collect()]
    assert s1 == s2 and len(set(s1)) == 4


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=1, max_value=3000), fraction=st.sampled_from([0.01, 0.2, 0.5, 0.77, 1.0]),
       seed=st.integers(min_value=0, max_value=10_000), n_strata=st.integers(min_value=1, max_value=4))
def test_exact_flag_equals_sorting_each_stratum(spark, n, fraction, seed, n_strata):
    df = spark.range(0, n).select(F.col("id").alias("k"), (F.col("id") % n_strata).alias("s")).repartition(3)
    got = {r["k"] for r in split.exact_flag(df, "k", fraction, seed, ["s"]).filter("_tf_held").select("k").collect()}
    rows = df.select("k", "s", split.hash_u32("k", seed).alias("h")).collect()
    want = set()
    for stratum in range(n_strata):
        members = sorted((r["h"], r["k"]) for r in rows if r["s"] == stratum)
        from decimal import Decimal
        import math as _m

        take = _m.ceil(Decimal(repr(fraction)) * len(members))
        want |= {k for _, k in members[:take]}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from(["a", "b"])),
                               st.integers(0, 2)), max_size=60),
       fraction=st.sampled_from([0.0, 0.1, 0.3, 0.5, 0.7, 1.0]), seed=st.integers(0, 99))
def test_exact_flag_with_repeats_nulls_and_null_strata(spark, rows, fraction, seed):
    df = spark.createDataFrame(rows, "k long, s string, v int").repartition(3)
    got = split.exact_flag(df, "k", fraction, seed, ["s"]).withColumn("h", split.hash_u32("k", seed)).collect()
    assert Counter((r.k, r.s, r.v) for r in got) == Counter(rows)
    for s in {r[1] for r in rows}:
        key = lambda r: (r.h, r.k is not None, r.k or 0, r.v)
        held = sorted(key(r) for r in got if r.s == s and r._tf_held)
        left = sorted(key(r) for r in got if r.s == s and not r._tf_held)
        assert len(held) == math.ceil(Decimal(repr(fraction)) * (len(held) + len(left)))
        assert not held or not left or held[-1] <= left[0]


def test_exact_flag_hot_id(spark):
    """A third of the rows share one ID, a sixth are copies of one row."""
    n = 6000
    df = spark.range(0, n, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(123456)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 6 == 0, F.lit(-1)).otherwise(F.col("id")).alias("row")).cache()
    for fraction in (0.2, 0.5, 0.9):
        rows = split.exact_flag(df, "k", fraction, 5).withColumn("h", split.hash_u32("k", 5)).collect()
        assert Counter((r.k, r.row) for r in rows) == Counter((r.k, r.row) for r in df.collect())
        held = [(r.h, r.k, r.row) for r in rows if r._tf_held]
        assert len(held) == math.ceil(fraction * n)
        assert max(held) <= min((r.h, r.k, r.row) for r in rows if not r._tf_held)
