"""Standard scaler (F1, F2): population std, fitted on the training part only.

The fit is one aggregate (partial aggregation, one tiny shuffle); the apply is a
projection with the fitted constants as literals, which Catalyst folds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    @property
    def scales(self) -> tuple[float, ...]:
        """Divisors: a zero (or undefined) std divides by 1."""
        return tuple(s if s and s > 0 else 1.0 for s in self.stds)

    def column(self, i: int, source: Column | None = None) -> Column:
        src = source if source is not None else F.col(self.features[i])
        return (src.cast("double") - F.lit(float(self.means[i]))) / F.lit(float(self.scales[i]))

    def columns(self) -> list[Column]:
        return [self.column(i) for i in range(len(self.features))]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Replace (or add, with ``suffix``) the scaled feature columns."""
        return df.withColumns({f + suffix: self.column(i) for i, f in enumerate(self.features)})

    def to_dict(self) -> dict:
        return {"features": list(self.features), "means": list(self.means), "stds": list(self.stds)}

    @staticmethod
    def from_dict(d: dict) -> "Scaler":
        return Scaler(tuple(d["features"]), tuple(d["means"]), tuple(d["stds"]))


def scaler_stats_aggs(features) -> list[Column]:
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.avg(x).alias(f"mean_{f}"), F.stddev_pop(x).alias(f"std_{f}")]
    return aggs


def scaler_stats(df: DataFrame, features) -> DataFrame:
    """One row: ``mean_<f>`` and ``std_<f>`` (population) for every feature."""
    return df.agg(*scaler_stats_aggs(features))


def fit_scaler(df: DataFrame, features) -> Scaler:
    row = scaler_stats(df, features).first()
    feats = tuple(features)
    return Scaler(feats, tuple(float(row[f"mean_{f}"]) for f in feats),
                  tuple(float(row[f"std_{f}"] or 0.0) for f in feats))
