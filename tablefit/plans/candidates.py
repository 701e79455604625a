"""Candidate models derived from the regression table in one moments pass.

Per feature, a simple least-squares fit on the training part (``ols_<f>``) and
its Normal twin with the training residual std (``gauss_<f>``, distributional).
Validation RMSE and NLL come from the validation moments, so the whole
candidate set costs one scaler aggregate and one moments aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.functions.scaler import Scaler
from tablefit.operators import linear
from tablefit.operators.models import LinearModel
from tablefit.operators.split import hash_threshold, hash_u32
from tablefit.spec import FeatureSpec

CANDIDATE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("model_type", T.StringType()),
    T.StructField("ord", T.IntegerType()), T.StructField("is_distributional", T.BooleanType()),
    T.StructField("val_rmse", T.DoubleType()), T.StructField("val_nll", T.DoubleType()),
    T.StructField("feature", T.StringType()), T.StructField("model", T.StringType()),
])


def candidate_rounds(df: DataFrame, spec: FeatureSpec, seeds, train_fraction: float = 0.5) -> list[tuple[DataFrame, dict]]:
    """The candidates of several split seeds from the same two scans: one gives every
    seed's scaler, one the moments of each combination of sides, which add up to
    every seed's training and validation part."""
    seeds = list(seeds)
    parts = [(hash_u32(spec.id_col, s) < F.lit(hash_threshold(train_fraction))).alias(f"_tf_train{k}") for k, s in enumerate(seeds)]
    tagged = df.select(*spec.features, spec.target, *parts)
    side = [f"_tf_train{k}" for k in range(len(seeds))]
    aggs = []
    for k, c in enumerate(side):
        for name, x in [(f, F.when(F.col(c), F.col(f).cast("double"))) for f in spec.features]:
            aggs += [F.avg(x).alias(f"mean{k}_{name}"), F.stddev_pop(x).alias(f"std{k}_{name}")]
        aggs.append(F.avg(F.when(F.col(c), F.col(spec.target).cast("double"))).alias(f"ybar{k}"))
    row = tagged.agg(*aggs).first()
    scalers = [Scaler(tuple(spec.features), tuple(float(row[f"mean{k}_{f}"]) for f in spec.features),
                      tuple(float(row[f"std{k}_{f}"] or 0.0) for f in spec.features)) for k in range(len(seeds))]
    shifts = [float(row[f"ybar{k}"]) for k in range(len(seeds))]
    cell = F.concat(*[F.when(F.col(c), F.lit("1")).otherwise(F.lit("0")) for c in side]).alias("_tf_cell")
    cells = linear.moments(tagged.select(*spec.features, spec.target, cell), scalers[0], spec.target, shifts[0], part_col="_tf_cell")
    out = []
    for k, seed in enumerate(seeds):
        both = {}
        for name in sorted(cells):
            both[name[k]] = both[name[k]] + cells[name] if name[k] in both else cells[name]
        m_tr, m_val = (both[b].rescaled(scalers[0], scalers[k], shifts[k]) for b in "10")
        out.append(_candidates(df.sparkSession, scalers[k], m_tr, m_val, seed))
    return out


def univariate_candidates(df: DataFrame, spec: FeatureSpec, seed: int = 42,
                          train_fraction: float = 0.5) -> tuple[DataFrame, dict]:
    """Candidates ``(run_id, model_type, ord, is_distributional, val_rmse, val_nll, feature, model)``."""
    return candidate_rounds(df, spec, [seed], train_fraction)[0]


def _candidates(spark: SparkSession, scaler: Scaler, m_tr, m_val, seed: int) -> tuple[DataFrame, dict]:
    rows, models = [], {}
    for k, fit in enumerate(linear.univariate_fits(m_tr, scaler)):
        sse = linear.univariate_sse(m_val, k, fit["intercept_z"], fit["coef_z"])
        val_rmse = math.sqrt(sse / m_val.n)
        sigma = fit["train_rmse"]
        val_nll = 0.5 * math.log(2 * math.pi) + math.log(sigma) + sse / (2 * sigma * sigma * m_val.n)
        coef = [0.0] * len(scaler.features)
        coef[k] = fit["coef_z"]
        point = LinearModel(scaler, fit["intercept_z"], coef)
        # A Normal with constant std: zero weight covariance, noise precision 1 / sigma^2.
        zero = [[0.0] * len(coef) for _ in coef]
        gauss = LinearModel(scaler, fit["intercept_z"], coef, zero, 1.0 / (sigma * sigma))
        f = fit["feature"]
        for j, (mt, m, dist, nll) in enumerate(((f"ols_{f}", point, False, None),
                                               (f"gauss_{f}", gauss, True, val_nll))):
            rid = f"{mt}-s{seed}"
            rows.append((rid, mt, 2 * k + j, dist, val_rmse, nll, f, m.to_json()))
            models[rid] = m
    return spark.createDataFrame(rows, CANDIDATE_SCHEMA), models
