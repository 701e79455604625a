"""Batch scoring and hold-out metrics.

Scaler and model are one expression (B1); all aliases are appended in a single
projection (P6), so the scan, the scoring and the write are one stage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.functions.stats import r2, rmse
from tablefit.operators.models import Model, predict_numpy


def prediction_columns(models: dict[str, Model]) -> dict[str, Column]:
    return {f"prediction_{alias}": m.predict_col() for alias, m in models.items()}


def score(df: DataFrame, models: dict[str, Model]) -> DataFrame:
    """Keep every input column, add ``prediction_<alias>`` per model."""
    return df.withColumns(prediction_columns(models))


def model_udf(model: Model):
    """B2: the model as an Arrow-batched pandas UDF; features by position.

    The generic plug-in form for a model that has no Column expression; the
    built-in expression from :func:`score` is preferred.
    """
    payload = model.to_json()

    @F.pandas_udf(T.DoubleType())
    def predict(*cols: pd.Series) -> pd.Series:
        from tablefit.operators.models import model_from_json

        m = model_from_json(payload)
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        return pd.Series(predict_numpy(m, X))

    return predict


def holdout_metrics(scored: DataFrame, target: str, aliases: list[str]) -> DataFrame:
    """``(alias, n, rmse, r2)`` per alias from one aggregate over the scored rows."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for a in aliases:
        p = F.col(f"prediction_{a}")
        aggs += [rmse(target, p).alias(f"rmse_{a}"), r2(target, p).alias(f"r2_{a}")]
    one = scored.agg(*aggs)
    stacked = ", ".join(f"'{a}', rmse_{a}, r2_{a}" for a in aliases)
    return one.selectExpr("n", f"stack({len(aliases)}, {stacked}) as (alias, rmse, r2)") \
              .select("alias", "n", "rmse", "r2")
