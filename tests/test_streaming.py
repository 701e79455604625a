"""The scoring projection on a file stream equals batch scoring."""

from pyspark.sql import functions as F

from tablefit.functions.scaler import fit_scaler
from tablefit.operators import linear, scoring
from tablefit.operators.models import LinearModel
from tablefit.session import scratch_path
from tablefit.spec import LINEITEM_SPEC as SPEC
from tablefit.streaming import start_scoring_stream


def test_stream_matches_batch(spark, reg):
    scaler = fit_scaler(reg, SPEC.features)
    b, w = linear.fit_least_squares(linear.moments(reg, scaler, "revenue", 0.0)[None])
    models = {"champion": LinearModel(scaler, b, w)}
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    reg.repartition(3).write.parquet(src)
    q = start_scoring_stream(spark, src, reg.schema, models, sink, max_files_per_trigger=1)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = scoring.score(reg, models)
    joined = streamed.select("row_id", F.col("prediction_champion").alias("s")).join(
        batch.select("row_id", F.col("prediction_champion").alias("b")), "row_id")
    assert joined.count() == reg.count()
    assert joined.agg(F.max(F.abs(F.col("s") - F.col("b")))).first()[0] == 0.0


def test_a_restart_scores_only_what_is_new(spark, reg):
    scaler = fit_scaler(reg, SPEC.features)
    models = {"champion": LinearModel(scaler, 1.0, [0.5] * len(SPEC.features))}
    src, sink = scratch_path(spark, "restart-src"), scratch_path(spark, "restart-sink")
    for k in (1, 2):
        reg.limit(10 * k).coalesce(1).write.mode("append").parquet(src)
        start_scoring_stream(spark, src, reg.schema, models, sink).awaitTermination(120)
        assert spark.read.parquet(sink).count() == (10 if k == 1 else 30)
