"""Candidates, selection, model versions and aliases.

The registry is two append-only tables: ``model_versions(model_name, version,
run_id, seq)`` and ``model_aliases(model_name, alias, version, seq)``. The
current target of an alias is its row with the highest ``seq``. Version and
alias logs hold one row per registration, so the windows below work on
registry-sized data, never on the scored rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.operators.models import DISTRIBUTIONAL_MODELS

VERSIONS_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("version", T.IntegerType()),
    T.StructField("run_id", T.StringType()), T.StructField("seq", T.LongType()),
])
ALIASES_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("alias", T.StringType()),
    T.StructField("version", T.IntegerType()), T.StructField("seq", T.LongType()),
])


# --------------------------------------------------------------------------- U1
def union_candidates(per_task: list[DataFrame]) -> DataFrame:
    """Candidate rows of all training runs, tagged with their task order ``ord``."""
    tagged = [df.withColumn("ord", F.lit(i)) for i, df in enumerate(per_task)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_distributional_flag(candidates: DataFrame, model_type_col: str = "model_type") -> DataFrame:
    if "is_distributional" in candidates.columns:
        return candidates
    return candidates.withColumn("is_distributional",
                                 F.col(model_type_col).isin(*sorted(DISTRIBUTIONAL_MODELS)))


# --------------------------------------------------------------------------- R1
def champion_challenger(candidates: DataFrame, metric: str = "val_rmse", order_col: str = "ord") -> DataFrame:
    """The two lowest ``metric`` rows (stable on ties by ``order_col``), labelled
    ``champion`` and ``challenger``. Fewer than two candidates is an error."""
    top = candidates.orderBy(F.col(metric).asc_nulls_last(), F.col(order_col)).limit(2)
    rows = top.collect()  # two rows at most
    if len(rows) < 2:
        raise ValueError("Champion / challenger selection needs at least two candidates.")
    spark = candidates.sparkSession
    labels = spark.createDataFrame([(0, "champion"), (1, "challenger")], "rank int, alias string")
    ranked = top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(metric).asc_nulls_last(), F.col(order_col))) - 1)
    return ranked.join(F.broadcast(labels), "rank").drop("rank")


# --------------------------------------------------------------------------- J1
def attach_metric(candidates: DataFrame, run_metrics: DataFrame, metric: str = "best_val_nll",
                  as_col: str = "val_nll", key: str = "run_id") -> DataFrame:
    """Attach ``metric`` by run ID to the distributional candidates; a missing
    value is an error, as a lookup in the run log would be."""
    dist = candidates.filter(F.col("is_distributional"))
    metrics = run_metrics.select(key, F.col(metric).alias(as_col))
    joined = dist.drop(as_col).join(metrics, key, "left")
    missing = joined.filter(F.col(as_col).isNull()).select(key).limit(5).collect()
    if missing:
        raise ValueError(f"Missing metric {metric!r} for runs {[r[key] for r in missing]}")
    return joined


# --------------------------------------------------------------------------- R2
def best_calibrated(candidates: DataFrame, metric: str = "val_nll", order_col: str = "ord") -> DataFrame:
    """The distributional candidate with the lowest ``metric`` (one row)."""
    dist = candidates.filter(F.col("is_distributional"))
    best = dist.orderBy(F.col(metric).asc_nulls_last(), F.col(order_col)).limit(1)
    if not best.take(1):
        raise ValueError("None of the candidates predicts a distribution (No distributional model type among them)")
    return best.withColumn("alias", F.lit("best_calibrated"))


# --------------------------------------------------------------------------- V1, V2
def register(versions: DataFrame, aliases: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append one new version per request ``(model_name, run_id, alias, seq)``
    and point the alias at it. Returns the new ``(versions, aliases)`` rows.

    Version numbers continue per model name after the largest existing one; the
    same run registered twice gets two versions.
    """
    base = versions.groupBy("model_name").agg(F.max("version").alias("_base"))
    w = Window.partitionBy("model_name").orderBy("seq")
    new = (requests.join(base, "model_name", "left")
           .withColumn("version", (F.coalesce(F.col("_base"), F.lit(0)) + F.row_number().over(w)).cast("int")))
    new_versions = new.select("model_name", "version", "run_id", F.col("seq").cast("long"))
    new_aliases = new.select("model_name", "alias", "version", F.col("seq").cast("long"))
    return new_versions, new_aliases


def empty_versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VERSIONS_SCHEMA)


def empty_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ALIASES_SCHEMA)


# --------------------------------------------------------------------------- V3
def current_aliases(aliases: DataFrame) -> DataFrame:
    """Latest assignment of each (model_name, alias)."""
    return (aliases.groupBy("model_name", "alias")
            .agg(F.max_by("version", "seq").alias("version"), F.max("seq").alias("seq")))


def resolve(versions: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(model_name, alias, version, run_id)`` for every current alias."""
    cur = current_aliases(aliases)
    return cur.join(versions.select("model_name", "version", "run_id"), ["model_name", "version"], "left") \
              .select("model_name", "alias", "version", "run_id")
