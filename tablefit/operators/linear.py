"""Linear least squares, non-negative least squares and Bayesian ridge (M1, M4).

One pass over the rows builds the moment matrix of ``[z, t]`` (scaled features,
target minus a shift) per split part with partial aggregation, so the shuffle
is one (d+2)^2-sized row per task. Every fit and every validation RMSE / R^2
of a linear model is then d x d algebra on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.functions.scaler import Scaler

EPS = float(np.finfo(np.float64).eps)


@dataclass
class Moments:
    """Sums over rows of ``a = [z_1..z_d, t]``: count, sum(a), sum(a a')."""

    n: float
    s: np.ndarray
    G: np.ndarray
    shift: float

    @property
    def d(self) -> int:
        return len(self.s) - 1

    def centered(self):
        d, n = self.d, self.n
        mean = self.s / n
        C = self.G - n * np.outer(mean, mean)
        return mean, C[:d, :d], C[:d, d], C[d, d]

    def sse(self, intercept: float, coef: np.ndarray) -> float:
        """Sum of squared errors of ``intercept + z . coef`` on these rows."""
        d = self.d
        c = intercept - self.shift
        w = np.asarray(coef, dtype=float)
        Gzz, Gzt, Gtt = self.G[:d, :d], self.G[:d, d], self.G[d, d]
        sz, st = self.s[:d], self.s[d]
        val = Gtt - 2 * c * st - 2 * w @ Gzt + self.n * c * c + 2 * c * (w @ sz) + w @ Gzz @ w
        return float(max(val, 0.0))

    def sst(self) -> float:
        return float(max(self.G[self.d, self.d] - self.s[self.d] ** 2 / self.n, 0.0))

    def rmse_r2(self, intercept: float, coef) -> tuple[float, float]:
        err = self.sse(intercept, coef)
        tot = self.sst()
        r2 = (1.0 if err == 0 else 0.0) if tot == 0 else 1.0 - err / tot
        return float(np.sqrt(err / self.n)), float(r2)

    def __add__(self, other: "Moments") -> "Moments":
        """The moments of both sets of rows (same scaling, same shift)."""
        return Moments(self.n + other.n, self.s + other.s, self.G + other.G, self.shift)

    def rescaled(self, have: Scaler, want: Scaler, shift: float) -> "Moments":
        """The same rows under another scaler and target shift: ``a' = D a + b``."""
        if have == want and shift == self.shift:
            return self
        to = np.array(want.scales)
        D = np.append(np.array(have.scales) / to, 1.0)
        b = np.append((np.array(have.means) - np.array(want.means)) / to, self.shift - shift)
        ds = D * self.s
        G = D[:, None] * self.G * D + np.outer(ds, b) + np.outer(b, ds) + self.n * np.outer(b, b)
        return Moments(self.n, ds + self.n * b, G, shift)


def moment_aggs(scaler: Scaler, target: str, shift: float):
    cols = scaler.columns() + [F.col(target).cast("double") - F.lit(float(shift))]
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(cols[i]).alias(f"s{i}") for i in range(k)]
    aggs += [F.sum(cols[i] * cols[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    return aggs, k


def _row_to_moments(row, k: int, shift: float) -> Moments:
    s = np.array([row[f"s{i}"] or 0.0 for i in range(k)], dtype=float)
    G = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            G[i, j] = G[j, i] = row[f"g{i}_{j}"] or 0.0
    return Moments(float(row["n"]), s, G, shift)


def moments(df: DataFrame, scaler: Scaler, target: str, shift: float = 0.0,
            part_col: str | None = None) -> dict:
    """Moments of ``[scaled features, target - shift]``, per value of ``part_col``."""
    aggs, k = moment_aggs(scaler, target, shift)
    if part_col is None:
        return {None: _row_to_moments(df.agg(*aggs).first(), k, shift)}
    rows = df.groupBy(part_col).agg(*aggs).collect()
    return {r[part_col]: _row_to_moments(r, k, shift) for r in rows}


# --------------------------------------------------------------------------- M1
def _lstsq(A: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(A, b, rcond=None)[0]


def nnls_gram(A: np.ndarray, c: np.ndarray, max_iter: int | None = None) -> np.ndarray:
    """Lawson-Hanson active set for min 1/2 w'Aw - c'w subject to w >= 0."""
    d = len(c)
    tol = 1e-12 * max(1.0, float(np.max(np.abs(c))) if d else 1.0)
    w = np.zeros(d)
    passive = np.zeros(d, dtype=bool)
    max_iter = max_iter or 30 * max(d, 1)
    for _ in range(max_iter):
        grad = c - A @ w
        candidates = (~passive) & (grad > tol)
        if not candidates.any():
            break
        j = int(np.argmax(np.where(candidates, grad, -np.inf)))
        passive[j] = True
        while True:
            s = np.zeros(d)
            idx = np.flatnonzero(passive)
            s[idx] = _lstsq(A[np.ix_(idx, idx)], c[idx])
            if np.all(s[idx] > 0):
                w = s
                break
            bad = passive & (s <= 0)
            alpha = np.min(w[bad] / (w[bad] - s[bad]))
            w = w + alpha * (s - w)
            passive &= w > tol
            w[~passive] = 0.0
    return w


def fit_least_squares(m: Moments, fit_intercept: bool = True, positive: bool = False):
    """Plain or non-negative least squares from train moments: (intercept, coef)."""
    d = m.d
    if fit_intercept:
        mean, Czz, Czt, _ = m.centered()
        w = nnls_gram(Czz, Czt) if positive else _lstsq(Czz, Czt)
        intercept = m.shift + mean[d] - mean[:d] @ w
        return float(intercept), w
    Gzz = m.G[:d, :d]
    Gzy = m.G[:d, d] + m.shift * m.s[:d]
    w = nnls_gram(Gzz, Gzy) if positive else _lstsq(Gzz, Gzy)
    return 0.0, w


# --------------------------------------------------------------------------- M4
def fit_bayesian_ridge(m: Moments, alpha_1=1e-6, alpha_2=1e-6, lambda_1=1e-6, lambda_2=1e-6,
                       max_iter: int = 300, tol: float = 1e-3):
    """Evidence maximisation on the centred Gram matrix (MacKay 1992, Tipping 2001).

    Returns ``(intercept, coef, sigma, alpha, lambda, n_iter)``: posterior mean,
    posterior covariance of the weights and the noise / weight precisions.
    """
    d, n = m.d, m.n
    mean, Czz, Czt, Ctt = m.centered()
    eig, V = np.linalg.eigh(Czz)
    eig = np.clip(eig, 0.0, None)
    Vty = V.T @ Czt
    alpha = 1.0 / (Ctt / n + EPS)
    lam = 1.0
    coef_old = None

    def update(alpha_, lam_):
        coef_ = V @ (Vty / (eig + lam_ / alpha_))
        rss_ = max(Ctt - 2 * coef_ @ Czt + coef_ @ Czz @ coef_, 0.0)
        return coef_, rss_

    it = 0
    for it in range(max_iter):
        coef, rss = update(alpha, lam)
        gamma = float(np.sum(alpha * eig / (lam + alpha * eig)))
        lam = (gamma + 2 * lambda_1) / (float(coef @ coef) + 2 * lambda_2)
        alpha = (n - gamma + 2 * alpha_1) / (rss + 2 * alpha_2)
        if coef_old is not None and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef.copy()
    coef, _ = update(alpha, lam)
    sigma = (1.0 / alpha) * (V @ (V.T / (eig + lam / alpha)[:, None]))
    intercept = m.shift + mean[d] - mean[:d] @ coef
    return float(intercept), coef, sigma, float(alpha), float(lam), it + 1


def univariate_fits(m: Moments, scaler: Scaler) -> list[dict]:
    """Per feature, the simple regression of the target on that feature alone,
    from the same moments: raw-unit slope and intercept, training residual RMSE."""
    d = m.d
    mean, Czz, Czt, Ctt = m.centered()
    out = []
    for f in range(d):
        w = Czt[f] / Czz[f, f] if Czz[f, f] > 0 else 0.0
        slope = w / scaler.scales[f]
        x_mean = scaler.means[f] + mean[f] * scaler.scales[f]
        y_mean = m.shift + mean[d]
        sse = max(Ctt - w * Czt[f], 0.0)
        out.append({"feature": scaler.features[f], "slope": float(slope),
                    "intercept": float(y_mean - slope * x_mean), "coef_z": float(w),
                    "intercept_z": float(y_mean - w * mean[f]), "train_rmse": float(np.sqrt(sse / m.n))})
    return out


def univariate_sse(m: Moments, f: int, intercept_z: float, coef_z: float) -> float:
    w = np.zeros(m.d)
    w[f] = coef_z
    return m.sse(intercept_z, w)
