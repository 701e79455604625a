"""Sources and layers on the lineitem table."""

import pytest
from pyspark.sql import functions as F

from tablefit.operators import checks
from tablefit.sources import layers, tables
from tablefit.spec import LINEITEM_SPEC as SPEC

from conftest import SF_SMALL


def test_row_count_matches_source(spark, reg):
    n = tables.load(spark, SF_SMALL, "lineitem").count()
    assert reg.count() == n
    assert checks.expect_row_count(reg, n).first()["passed"]


def test_target_and_id_present(reg):
    assert SPEC.target in reg.columns and SPEC.id_col in reg.columns
    assert set(SPEC.features) <= set(reg.columns)


def test_sequential_ids_by_sort(spark):
    numbered = tables.lineitem_regression(spark, SF_SMALL, id_order="sort")
    ids = [r[0] for r in numbered.select(SPEC.id_col).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    assert checks.expect_sequential_ids(numbered, SPEC.id_col).first()["passed"]


def test_key_ids_are_distinct_and_need_no_sort(reg, spark):
    df = tables.lineitem_regression(spark, SF_SMALL)
    assert df.select("row_id").distinct().count() == df.count()
    other = tables.lineitem_regression(spark, SF_SMALL.replace("0.001", "0.01"))  # not the cached one
    plan = other.agg(F.max("revenue"))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "l_orderkey" not in plan.split("ReadSchema")[-1]


def test_sequential_ids_follow_sort_order(spark):
    orders = tables.load(spark, SF_SMALL, "orders").repartition(5)
    out = layers.sequential_id(orders, "sid", order_by=["o_orderkey"]).select("o_orderkey", "sid").collect()
    keys = sorted(r["o_orderkey"] for r in out)
    assert {r["o_orderkey"]: r["sid"] for r in out} == {k: i + 1 for i, k in enumerate(keys)}


def test_sequential_ids_source_order(spark):
    df = tables.load(spark, SF_SMALL, "orders")
    with_id = layers.sequential_id(df, "sid")
    got = [r["o_orderkey"] for r in with_id.orderBy("sid").select("o_orderkey").collect()]
    import pyarrow.parquet as pq

    assert got == pq.read_table(f"{SF_SMALL}/orders.parquet", columns=["o_orderkey"]).column(0).to_pylist()
    assert checks.expect_sequential_ids(with_id, "sid").first()["passed"]


def test_continuous_target(reg):
    assert reg.select(SPEC.target).distinct().count() > 50
    assert checks.expect_distinct_target(reg, SPEC.target, 50).first()["passed"]


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "`mean radius` int, `worst area` double")
    assert layers.normalise_columns(df).columns == ["mean_radius", "worst_area"]


def test_gold_columns_order_and_count(reg):
    silver = reg.withColumn("extra", F.lit(1.0))
    gold = layers.gold(silver, SPEC)
    assert gold.columns == [*SPEC.features, SPEC.target, SPEC.id_col]
    assert gold.count() == silver.count()
    assert checks.expect_row_count_preserved(silver, gold).first()["passed"]


def test_gold_on_single_silver_row(spark):
    cols = [*SPEC.features, SPEC.target, SPEC.id_col]
    row = spark.createDataFrame([tuple(1.0 for _ in cols)], ", ".join(f"{c} double" for c in cols))
    gold = layers.gold(row, SPEC)
    assert gold.columns == cols and gold.count() == 1


def test_silver_drops_null_rows(reg):
    bronze = tables.null_injected(reg)
    silver = layers.silver(bronze, SPEC)
    expected = reg.filter(F.col("l_linenumber") != 7).count()
    assert silver.count() == expected
    counts = checks.null_counts(bronze, SPEC.layer_columns).first().asDict()
    assert counts["l_tax"] == reg.count() - expected and counts["revenue"] == 0


def test_layer_roundtrip(spark, reg):
    from tablefit.session import scratch_path

    path = scratch_path(spark, "test-layer")
    layers.write_layer(reg, path)
    back = layers.read_layer(spark, path)
    assert back.count() == reg.count() and back.columns == reg.columns


def test_bronze_missing_column_raises(reg):
    with pytest.raises(ValueError, match="Missing columns"):
        layers.bronze(reg.drop("l_tax"), SPEC)


def test_sequential_ids_hot_key_is_spread(spark):
    df = spark.range(0, 30000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    out = layers.sequential_id(df, "sid", order_by=["k"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 0.5 * 30000  # the 10,000 equal keys are not left in one task
    assert checks.expect_sequential_ids(out, "sid").first()["passed"]
    keys = [r["k"] for r in out.orderBy("sid").select("k").collect()]
    assert keys == sorted(keys)


def test_read_table_formats(spark, reg):
    from tablefit.session import scratch_path
    from pyspark.sql import types as T

    numbered = tables.lineitem_regression(spark, SF_SMALL, id_order="sort")
    small = numbered.select("row_id", "l_quantity", "revenue").filter(F.col("row_id") <= 50)
    for fmt in ("csv", "json", "parquet"):
        path = scratch_path(spark, f"fmt-{fmt}")
        writer = small.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.save(path)
        schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("l_quantity", T.DoubleType()),
                               T.StructField("revenue", T.DoubleType())])
        opts = {"header": "true"} if fmt == "csv" else {}
        back = layers.read_table(spark, path, schema=schema, fmt=fmt, **opts)
        assert sorted(back.collect()) == sorted(small.collect())


def test_catalog_layer_with_comment(spark, reg):
    import uuid

    from tablefit.session import scratch_path

    db = f"tf_test_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    try:
        name = f"{db}.bronze"
        layers.write_layer(reg.limit(100), name, comment="Raw regression rows, unscaled")
        back = layers.read_layer(spark, name)
        assert back.count() == 100 and back.columns == reg.columns
        assert spark.catalog.getTable(name).description == "Raw regression rows, unscaled"
        layers.write_layer(reg.limit(10), name, comment="Raw regression rows, unscaled")  # overwrite
        assert layers.read_layer(spark, name).count() == 10
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
