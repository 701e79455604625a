"""The tables the rebuild derives from the driver's parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.sources.layers import sequential_id
from tablefit.spec import LINEITEM_FEATURES

# The line's own key (it repeats at times) and, for a total order, its measures.
LINEITEM_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
LINEITEM_ORDER = (*LINEITEM_KEY, "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def revenue_expr():
    return (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("revenue")


def lineitem_regression(spark: SparkSession, sf_dir: str, with_id: bool = True,
                        id_order: str = "key") -> DataFrame:
    """Features, ``revenue`` target and a ``row_id``.

    ``id_order="key"`` (default) makes the ID from the table's own key: a
    projection, pruned where the ID is not used. ``"sort"`` numbers the rows 1..n
    in key order, reproducible by any engine that can sort, at the cost of a sort
    of the projected columns; ``"source"`` numbers them in file order from the
    scan metadata, without a sort or a shuffle.
    """
    li = load(spark, sf_dir, "lineitem")
    if not with_id:
        return li.select(*LINEITEM_FEATURES, revenue_expr())
    if id_order == "key":
        parts = [*[F.col(c) for c in LINEITEM_KEY], F.col("l_quantity").cast("bigint")]
        key = F.concat_ws("-", *[c.cast("string") for c in parts]).alias("row_id")
        return li.select(*LINEITEM_FEATURES, revenue_expr(), key)
    if id_order == "source":
        li = sequential_id(li.select(*LINEITEM_FEATURES, revenue_expr()), "row_id")
        return li.select(*LINEITEM_FEATURES, "revenue", "row_id")
    li = li.select(*dict.fromkeys([*LINEITEM_ORDER, *LINEITEM_FEATURES]), revenue_expr())
    li = sequential_id(li, "row_id", order_by=list(LINEITEM_ORDER))
    return li.select(*LINEITEM_FEATURES, "revenue", "row_id")


def null_injected(df: DataFrame) -> DataFrame:
    """The regression table with ``l_tax`` null on line number 7 (the data has no nulls)."""
    return df.withColumn("l_tax", F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_tax")))
