"""The whole job graph on the small tables, with small boosting settings."""

from pyspark.sql import functions as F

from tablefit.plans import flow
from tablefit.session import scratch_path
from tablefit.sources import tables
from tablefit.spec import LINEITEM_SPEC as SPEC

from conftest import SF_SMALL


def test_run_all(spark):
    root = scratch_path(spark, "flow-test")
    raw = tables.lineitem_regression(spark, SF_SMALL)
    out = flow.run_all(spark, raw, SPEC, root, "tablefit.test_model", n_trials=2, seed=42, overrides={
        "gradient_boosting": {"n_estimators": 3, "max_depth": 2},
        "ngboost": {"n_estimators": 2, "base_max_depth": 2},
    })
    aliases = {r["alias"]: r["version"] for r in out["aliases"].collect()}
    assert aliases == {"champion": 1, "challenger": 2, "best_calibrated": 3}
    metrics = {r["alias"]: r for r in out["metrics"].collect()}
    assert set(metrics) == {"champion", "challenger", "best_calibrated"}
    assert metrics["champion"]["r2"] > 0.99
    scored = spark.read.parquet(f"{root}/scored_output")
    assert {"prediction_champion", "prediction_challenger", "prediction_best_calibrated"} <= set(scored.columns)
    cal = flow.calibration_job(spark, out["store"], "tablefit.test_model", out["paths"]["scoring_set"], SPEC)
    assert cal["histogram"].count() == 20 and cal["curves"].count() == 800
    assert cal["mixture"].agg(F.count("density")).first()[0] == 500
