"""Commits made once, promotions by several writers, snapshot layers."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tablefit.operators import registry
from tablefit.plans.store import ModelStore
from tablefit.session import scratch_path
from tablefit.sources import commits, layers


def test_a_number_is_taken_once(spark):
    log = commits.CommitLog(spark, scratch_path(spark, "log"))
    assert log.numbers() == []
    assert log.put(0, {"a": 1}) and not log.put(0, {"a": 2})
    assert log.read(0) == {"a": 1} and log.numbers() == [0]
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: log.put(1, {"by": k}), range(8)))
    assert sum(won) == 1 and log.read(1) == {"by": won.index(True)}
    assert log.commit(lambda seen: {"seen": seen})[0] == 2 and log.read(2) == {"seen": [0, 1]}


def test_other_file_systems_rename_without_overwrite(spark, monkeypatch):
    log = commits.CommitLog(spark, scratch_path(spark, "log"))
    monkeypatch.setattr(commits, "urlparse", lambda url: type("U", (), {"scheme": "hdfs", "path": ""}))
    assert log.put(0, {"a": 1}) and not log.put(0, {"a": 2})
    assert log.read(0) == {"a": 1}


def test_promotions_at_once_get_distinct_versions(spark):
    root = scratch_path(spark, "store")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: ModelStore(spark, root).register("m", [("champion", f"r{k}"), ("challenger", f"s{k}")]), range(6)))
    store = ModelStore(spark, root)
    versions = sorted((r["version"], r["run_id"]) for r in store.versions().collect())
    assert [v for v, _ in versions] == list(range(1, 13))
    assert sorted(r["seq"] for r in store.aliases().collect()) == list(range(12))
    # Each promotion's two versions stand side by side, and the aliases are those of the last one.
    assert all(a[1][1:] == b[1][1:] for a, b in zip(versions[::2], versions[1::2]))
    now = {r["alias"]: r["run_id"] for r in registry.resolve(store.versions(), store.aliases()).collect()}
    assert now == {"champion": versions[-2][1], "challenger": versions[-1][1]}


def test_the_loser_numbers_after_the_winner(spark, monkeypatch):
    root = scratch_path(spark, "store")
    put, raced = commits.CommitLog.put, []

    def late(self, number, content):
        if not raced:
            raced.append(number)
            ModelStore(spark, root).register("m", [("champion", "winner")])
        return put(self, number, content)

    monkeypatch.setattr(commits.CommitLog, "put", late)
    store = ModelStore(spark, root)
    assert store.register("m", [("champion", "loser"), ("challenger", "other")]) == 1
    assert sorted((r["version"], r["run_id"]) for r in store.versions().collect()) == [(1, "winner"), (2, "loser"), (3, "other")]
    assert registry.current_aliases(store.aliases()).filter("alias = 'champion'").first()["version"] == 2


def test_a_crash_leaves_no_half_promotion(spark, monkeypatch):
    store = ModelStore(spark, scratch_path(spark, "store"))
    store.register("m", [("champion", "r1")])

    def crash(self, tmp, name):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(commits.CommitLog, "_take", crash)
        with pytest.raises(RuntimeError, match="killed"):
            store.register("m", [("champion", "r2"), ("challenger", "r3")])
    assert store.versions().count() == 1 and store.aliases().count() == 1
    store.register("m", [("champion", "r4")])
    assert [r["version"] for r in store.versions().orderBy("version").collect()] == [1, 2]


def test_tables_of_older_stores_are_read_along(spark):
    store = ModelStore(spark, scratch_path(spark, "store"))
    spark.createDataFrame([("m", 7, "old", 3)], registry.VERSIONS_SCHEMA).write.parquet(store.path("model_versions"))
    spark.createDataFrame([("m", "champion", 7, 3)], registry.ALIASES_SCHEMA).write.parquet(store.path("model_aliases"))
    store.register("m", [("challenger", "new")])
    got = {r["alias"]: (r["version"], r["run_id"]) for r in registry.resolve(store.versions(), store.aliases()).collect()}
    assert got == {"champion": (7, "old"), "challenger": (8, "new")}


def test_a_layer_is_rewritten_from_itself(spark):
    path = scratch_path(spark, "layer")
    layers.write_layer(spark.range(10), path)
    before = layers.read_layer(spark, path)
    layers.write_layer(layers.read_layer(spark, path).filter("id < 4").withColumn("twice", F.col("id") * 2), path)
    assert layers.read_layer(spark, path).columns == ["id", "twice"] and layers.read_layer(spark, path).count() == 4
    assert before.count() == 10  # a reader of the old snapshot goes on
    assert layers.read_layer(spark, path, snapshot=0).count() == 10
    assert layers.release_layer(spark, path) == [1]
    assert layers.read_layer(spark, path).count() == 4
    with pytest.raises(ValueError, match="no snapshot 0"):
        layers.read_layer(spark, path, snapshot=0)


def test_a_failed_overwrite_leaves_the_old_rows(spark):
    path = scratch_path(spark, "layer")
    layers.write_layer(spark.range(10), path)
    bad = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        layers.write_layer(bad, path)
    assert layers.read_layer(spark, path).count() == 10
    layers.write_layer(spark.range(3).withColumn("v", F.lit(1)), path, partition_by=["id"])
    assert layers.release_layer(spark, path, keep=2) == [0, 1]  # the failed write's folder is gone too
    assert sorted(r["id"] for r in layers.read_layer(spark, path).collect()) == [0, 1, 2]


def test_a_plain_folder_is_a_layer(spark):
    path = scratch_path(spark, "plain")
    spark.range(5).write.parquet(path)
    assert layers.read_layer(spark, path).count() == 5
    layers.write_layer(layers.read_layer(spark, path).limit(2), path)
    assert layers.read_layer(spark, path).count() == 2


def test_a_bare_path_is_swapped(spark, monkeypatch):
    path = scratch_path(spark, "bare")
    for n in (10, 6):
        layers.write_layer(spark.range(n), path, snapshots=False)
        assert spark.read.parquet(path).count() == n
    layers.write_layer(layers.read_layer(spark, path).filter("id < 3"), path, snapshots=False)
    assert layers.read_layer(spark, path).count() == 3
    bad = spark.range(9).select(F.raise_error(F.lit("killed")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        layers.write_layer(bad, path, snapshots=False)
    assert spark.read.parquet(path).count() == 3
    # Cut off between the two renames: the old rows are found where they are.
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.rename(at(path), at(layers._beside(path, "old")))
    assert layers.read_layer(spark, path).count() == 3
    layers.write_layer(spark.range(2), path, snapshots=False)
    assert layers.read_layer(spark, path).count() == 2
