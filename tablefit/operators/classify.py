"""Classification items described in prose only (O2-O4): class balance,
ROC AUC by rank sum, scaled logistic regression with a probability output."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.functions.scaler import Scaler, fit_scaler
from tablefit.operators.ordered import prefix_sums


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """O3: ``(label, n, share, both_classes)``; the window runs over the per-class rows only."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    return counts.select(label, "n", F.round(F.col("n") / F.sum("n").over(every), 9).alias("share"),
                         (F.count(F.lit(1)).over(every) >= 2).alias("both_classes"))


def validate_class_balance(df: DataFrame, label: str) -> None:
    n = df.agg(F.count_distinct(label)).first()[0]
    if n < 2:
        raise ValueError(f"Class balance check failed. Found {n} class(es) in {label!r}.")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """O2: AUC = P(score_pos > score_neg) + P(equal) / 2 (the rank-sum statistic).

    Rows are first folded to one row per distinct score (partial aggregation
    absorbs hot scores); the count of negatives below each score is a running
    total over the distinct scores (see :mod:`ordered`), never a global window.
    """
    per_score = df.groupBy(score).agg(F.sum(F.col(label).cast("double")).alias("pos"),
                                      F.sum((F.lit(1) - F.col(label)).cast("double")).alias("neg"))
    run = prefix_sums(per_score, [score], ["neg"])
    return run.agg(
        (F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
         / (F.sum("pos") * F.sum("neg"))).alias("auc"))


class LogisticModel:
    """``status``: converged, separable (no finite optimum: some margin has every
    row on its side) or max_iter; ``history``: mean loss of each accepted step."""

    def __init__(self, scaler: Scaler, intercept: float, coef, status: str = "converged", history: tuple = ()):
        self.scaler, self.intercept, self.coef = scaler, float(intercept), [float(c) for c in coef]
        self.status, self.history = status, tuple(history)

    def margin_col(self) -> Column:
        out = F.lit(self.intercept)
        for i, w in enumerate(self.coef):
            out = out + F.lit(w) * self.scaler.column(i)
        return out

    def probability_col(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin_col()))


def _newton_pass(rows: DataFrame, zcols: list[str], beta: np.ndarray) -> dict:
    """At ``beta`` (intercept first): rows, summed loss, rows not on their side,
    gradient and Hessian, as one aggregate of (d + 1)^2 sums."""
    k = len(beta)
    x = [F.lit(1.0), *[F.col(z) for z in zcols]]
    margin = F.lit(float(beta[0]))
    for b, z in zip(beta[1:], zcols):
        margin = margin + F.lit(float(b)) * F.col(z)
    at = rows.select("_tf_y", *zcols, margin.alias("_tf_m"))
    m, y = F.col("_tf_m"), F.col("_tf_y")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-m))
    w = p * (F.lit(1.0) - p)
    # log(1 + e^m) without overflow.
    loss = F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m))) - y * m
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss"), F.count_if((2 * y - 1) * m <= 0).alias("wrong")]
    aggs += [F.sum((y - p) * x[i]).alias(f"g{i}") for i in range(k)]
    aggs += [F.sum(w * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)]
    r = at.agg(*aggs).first()
    h = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            h[i, j] = h[j, i] = r[f"h{i}_{j}"] or 0.0
    return {"n": r["n"], "loss": r["loss"] or 0.0, "wrong": r["wrong"], "g": np.array([r[f"g{i}"] or 0.0 for i in range(k)]), "h": h}


def fit_logistic(df: DataFrame, features: list[str], label: str, reg_param: float = 0.0,
                 max_iter: int = 100, tol: float = 1e-10) -> LogisticModel:
    """Scaler (F1) on the training rows, then logistic regression on the scaled
    features by Newton's method: mean loss plus ``reg_param / 2`` times the squared
    weights (not the intercept's). A step is one aggregate; one that does not lower
    the objective is halved. Rows with a null are left out."""
    df = df.dropna(subset=[*features, label])
    if not df.take(1):
        raise ValueError("Logistic regression needs rows without nulls.")
    scaler = fit_scaler(df, features)
    zcols = [f"_tf_z{i}" for i in range(len(features))]
    rows = df.select(F.col(label).cast("double").alias("_tf_y"), *[scaler.column(i).alias(z) for i, z in enumerate(zcols)])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        beta = np.zeros(len(features) + 1)
        ridge = np.concatenate([[0.0], np.full(len(features), float(reg_param))])
        now = _newton_pass(rows, zcols, beta)
        n, history = now["n"], [now["loss"] / now["n"]]
        status, halved = "max_iter", 0
        value = history[0]
        step = None
        for _ in range(max_iter):
            if step is None:
                step = np.linalg.lstsq(now["h"] + n * np.diag(ridge), now["g"] - n * ridge * beta, rcond=None)[0]
            try_at = beta + step
            there = _newton_pass(rows, zcols, try_at)
            new = there["loss"] / n + float(ridge @ try_at ** 2) / 2
            if not new <= value + 1e-15 * abs(value):
                step, halved = step / 2, halved + 1
                if halved > 40:
                    status = "converged"  # no lower point along the step: rounding
                    break
                continue
            moved, gained = float(np.abs(step).max()), value - new
            beta, now, value, step, halved = try_at, there, new, None, 0
            history.append(value)
            if reg_param == 0.0 and there["wrong"] == 0:
                status = "separable"
                break
            if moved <= tol * max(1.0, float(np.abs(beta).max())) or gained <= 1e-16 * abs(value):
                status = "converged"
                break
        return LogisticModel(scaler, beta[0], beta[1:], status, history)
    finally:
        rows.unpersist()
