"""Scoring, hold-out metrics, model UDF and calibration views."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.functions.scaler import fit_scaler
from tablefit.operators import calibration, linear, scoring
from tablefit.operators.models import LinearModel
from tablefit.spec import LINEITEM_SPEC as SPEC


@pytest.fixture(scope="module")
def models(reg):
    scaler = fit_scaler(reg, SPEC.features)
    m = linear.moments(reg, scaler, "revenue", 0.0)[None]
    b, w = linear.fit_least_squares(m)
    bb, bw, sigma, alpha, _, _ = linear.fit_bayesian_ridge(m)
    return {"champion": LinearModel(scaler, b, w), "challenger": LinearModel(scaler, b, np.asarray(w) * 0.5),
            "best_calibrated": LinearModel(scaler, bb, bw, sigma, alpha)}


def test_score_appends_columns(reg, models):
    scored = scoring.score(reg, models)
    assert scored.columns == reg.columns + [f"prediction_{a}" for a in models]
    assert scored.count() == reg.count()


def test_udf_equals_expression(reg, models):
    m = models["champion"]
    udf = scoring.model_udf(m)
    diff = reg.select((udf(*SPEC.features) - m.predict_col()).alias("d")).agg(F.max(F.abs("d"))).first()[0]
    assert diff < 1e-6


def test_holdout_metrics_vs_numpy(reg, models):
    scored = scoring.score(reg, models)
    out = {r["alias"]: r for r in scoring.holdout_metrics(scored, "revenue", list(models)).collect()}
    pdf = scored.select("revenue", *[f"prediction_{a}" for a in models]).toPandas()
    for a in models:
        e = pdf["revenue"] - pdf[f"prediction_{a}"]
        assert abs(out[a]["rmse"] - np.sqrt(np.mean(e ** 2))) < 1e-6 * out[a]["rmse"]
        sst = np.sum((pdf["revenue"] - pdf["revenue"].mean()) ** 2)
        assert abs(out[a]["r2"] - (1 - np.sum(e ** 2) / sst)) < 1e-9


def test_histogram_area_is_one(reg):
    h = calibration.density_histogram(reg, "revenue", 20).collect()
    assert len(h) == 20
    assert abs(sum(r["density"] * (r["hi"] - r["lo"]) for r in h) - 1.0) < 1e-9
    assert sum(r["n"] for r in h) == reg.count()
    vals = reg.select("revenue").toPandas()["revenue"].to_numpy()
    counts, _ = np.histogram(vals, bins=20)
    assert [r["n"] for r in sorted(h, key=lambda r: r["bin"])] == counts.tolist()


def test_histogram_of_one_value_and_of_nan(spark):
    h = calibration.density_histogram(spark.createDataFrame([(7.0,)] * 9 + [(None,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [(r["lo"], r["hi"], r["n"]) for r in h] == [(6.5, 6.75, 0), (6.75, 7.0, 0), (7.0, 7.25, 9), (7.25, 7.5, 0)]
    assert h[2]["density"] == 4.0
    with pytest.raises(ValueError, match="NaN"):
        calibration.density_histogram(spark.createDataFrame([(1.0,), (float("nan"),)], "v double"), "v")


def test_mixture_density_integrates_to_one(reg, models):
    mu, sd = models["best_calibrated"].dist_cols()
    dist = reg.select("revenue", mu.alias("mu"), sd.alias("sigma"))
    lo, hi = dist.agg(F.min("mu") - 10 * F.max("sigma"), F.max("mu") + 10 * F.max("sigma")).first()
    out = calibration.mixture_density(dist, "mu", "sigma", lo, hi, 2000).orderBy("i").toPandas()
    assert abs(np.trapezoid(out["density"], out["x"]) - 1.0) < 1e-3
    same = calibration.mixture_density(dist, "mu", "sigma", lo, hi, 2000, dedupe=True).orderBy("i").toPandas()
    assert np.allclose(same["density"], out["density"], rtol=1e-9)


def test_point_curves_shape(reg, models):
    mu, sd = models["best_calibrated"].dist_cols()
    dist = reg.select("row_id", "revenue", mu.alias("mu"), sd.alias("sigma"))
    out = calibration.point_curves(dist, "row_id", "revenue", "mu", "sigma", 4, 200).toPandas()
    assert len(out) == 800 and out["row_id"].nunique() == 4
    assert np.all(out["density"] > 0)


def test_expanded_mixture_equals_the_exact_one(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    mu = np.concatenate([rng.normal(0, 50, 4000), [1e6, -1e6, 3.0]])
    sd = np.concatenate([np.exp(rng.normal(1, 1, 4000)), [0.01, 1e4, 1e-9]])
    rows = [(float(a), float(b)) for a, b in zip(mu, sd)]
    odd = [(None, 1.0), (1.0, None), (1.0, 0.0), (1.0, -1.0), (float("nan"), 1.0), (1.0, float("inf")), (float("inf"), 1.0)]
    df = spark.createDataFrame(rows + odd, "mu double, sigma double").repartition(5)
    got = calibration.mixture_density_cells(df, "mu", "sigma", -150.0, 150.0, 301).orderBy("i").toPandas()
    x = np.linspace(-150, 150, 301)
    each = np.exp(-(((x[:, None] - mu) / sd) ** 2) / 2) / (np.sqrt(2 * np.pi) * sd)
    assert np.allclose(got["x"], x)
    assert np.abs(got["density"].to_numpy() - each.mean(1))[x != 3.0].max() < 1e-12
    assert abs(got["density"][153] / each.mean(1)[153] - 1) < 1e-9  # the spike of the smallest sigma
    assert calibration.expansion_error() < 1e-10
    assert calibration.mixture_density_cells(df.limit(0), "mu", "sigma", 0.0, 1.0, 3).filter("density IS NOT NULL").count() == 0


def test_expanded_mixture_meets_the_grid_by_cells(spark):
    df = spark.range(50_000).select((F.col("id") % 97 / 10.0).alias("mu"), (5 + F.col("id") % 13 / 10.0).alias("sigma")).repartition(3)
    pairs = df.select("mu", "sigma", F.lit(1.0).alias("w"))
    assert calibration._cell_moments(pairs).count() < 30
