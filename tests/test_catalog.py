"""Catalog layers: snapshots behind a table's location."""

import uuid

import pytest
from pyspark.sql import functions as F

from tablefit.session import scratch_path
from tablefit.sources import catalog, layers


@pytest.fixture
def db(spark):
    name = f"tf_cat_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'catalog')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_a_failed_overwrite_leaves_the_old_rows(spark, db):
    name = f"{db}.silver"
    layers.write_layer(spark.range(20), name)
    bad = spark.range(20).select(F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error("stop").cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        layers.write_layer(bad, name)
    assert ids(layers.read_layer(spark, name)) == list(range(20))


def test_a_table_is_rewritten_from_itself_and_readers_go_on(spark, db):
    name = f"{db}.gold"
    layers.write_layer(spark.range(10), name, comment="it's one")
    before = layers.read_layer(spark, name)
    for k in range(3):
        layers.write_layer(layers.read_layer(spark, name).withColumn("id", F.col("id") + 10), name, comment="it's one")
    assert ids(before) == list(range(10))
    assert ids(layers.read_layer(spark, name)) == list(range(30, 40))
    assert spark.catalog.getTable(name).description == "it's one"
    assert len(layers.release_layer(spark, name, keep=2)) == 2
    assert len(layers.release_layer(spark, name)) == 1
    assert ids(spark.table(name)) == list(range(30, 40))


def test_other_columns_formats_and_partitions(spark, db):
    name = f"{db}.train"
    layers.write_layer(spark.range(5), name)
    wide = spark.range(6).withColumn("part", F.col("id") % 2).withColumn("a b", F.lit("x")).select("part", "id", "a b")
    layers.write_layer(wide, name)
    assert layers.read_layer(spark, name).columns == ["part", "id", "a b"] and ids(spark.table(name)) == list(range(6))
    for n in (6, 4):
        layers.write_layer(wide.filter(F.col("id") < n), name, partition_by=["part"])
        assert ids(spark.table(name)) == list(range(n)) and ids(spark.table(name).filter("part = 1")) == list(range(1, n, 2))
    layers.write_layer(spark.range(3), name, fmt="json")
    assert ids(spark.table(name)) == [0, 1, 2] and catalog.entry(spark, name)["provider"] == "json"
    layers.write_layer(spark.range(0), name)
    assert ids(spark.table(name)) == [] and spark.table(name).columns == ["id"]


def test_a_managed_table_is_taken_over(spark, db):
    name = f"{db}.old"
    spark.range(4).write.saveAsTable(name)
    layers.write_layer(layers.read_layer(spark, name).withColumn("id", F.col("id") * 2), name)
    assert ids(spark.table(name)) == [0, 2, 4, 6] and catalog.entry(spark, name)["type"] == "EXTERNAL"
    assert not spark.catalog.tableExists(f"{name}__managed")
    # A take-over cut off after the rename: the next write finds the rows.
    spark.range(7).write.saveAsTable(f"{db}.cut__managed")
    layers.write_layer(spark.range(2), f"{db}.cut")
    assert ids(spark.table(f"{db}.cut")) == [0, 1] and not spark.catalog.tableExists(f"{db}.cut__managed")
