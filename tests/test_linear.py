"""Linear family: Gram solutions against numpy (brute force) and Spark ML."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from tablefit.functions.scaler import fit_scaler
from tablefit.operators import linear
from tablefit.operators.models import LinearModel
from tablefit.spec import LINEITEM_SPEC as SPEC


@pytest.fixture(scope="module")
def setup(reg):
    scaler = fit_scaler(reg, SPEC.features)
    ybar = reg.agg({"revenue": "avg"}).first()[0]
    m = linear.moments(reg, scaler, "revenue", ybar)[None]
    pdf = reg.select(*SPEC.features, "revenue").toPandas()  # small fixture only
    X = pdf[list(SPEC.features)].to_numpy(float)
    Z = (X - X.mean(0)) / X.std(0)
    y = pdf["revenue"].to_numpy(float)
    return scaler, m, Z, y


def test_scaler_population_std(reg, setup):
    scaler, _, _, _ = setup
    pdf = reg.select(*SPEC.features).toPandas()
    assert np.allclose(scaler.means, pdf.mean().to_numpy(), rtol=1e-12)
    assert np.allclose(scaler.stds, pdf.std(ddof=0).to_numpy(), rtol=1e-10)


def test_scaler_zero_std_divides_by_one(spark):
    sc = fit_scaler(spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double"), ["a", "b"])
    assert sc.scales[1] == 1.0 and sc.stds[1] == 0.0


def test_ols_matches_numpy(setup):
    _, m, Z, y = setup
    b, w = linear.fit_least_squares(m, True, False)
    A = np.column_stack([np.ones(len(Z)), Z])
    ref = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose([b, *w], ref, rtol=1e-7, atol=1e-6)


def test_ols_no_intercept_matches_numpy(setup):
    _, m, Z, y = setup
    b, w = linear.fit_least_squares(m, False, False)
    assert b == 0.0
    assert np.allclose(w, np.linalg.lstsq(Z, y, rcond=None)[0], rtol=1e-7, atol=1e-6)


def test_ols_matches_spark_ml(reg, setup):
    scaler, m, _, _ = setup
    b, w = linear.fit_least_squares(m, True, False)
    data = VectorAssembler(inputCols=[f"z{i}" for i in range(len(w))], outputCol="x").transform(
        reg.select(*[scaler.column(i).alias(f"z{i}") for i in range(len(w))], "revenue"))
    ml = LinearRegression(featuresCol="x", labelCol="revenue", solver="normal", regParam=0.0,
                          standardization=False).fit(data)
    assert np.allclose(ml.coefficients.toArray(), w, rtol=1e-6)
    assert abs(ml.intercept - b) < 1e-6 * abs(b)


def test_nnls_is_nonnegative_and_optimal(setup):
    _, m, Z, y = setup
    b, w = linear.fit_least_squares(m, True, True)
    assert (w >= 0).all()
    # KKT: gradient zero on active coefficients, non-positive on the clamped ones.
    r = y - b - Z @ w
    g = Z.T @ r
    scale = np.abs(Z.T @ y).max()
    assert np.all(np.abs(g[w > 0]) < 1e-6 * scale)
    assert np.all(g[w == 0] < 1e-6 * scale)


def test_nnls_gram_brute_force():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 4))
    y = X @ np.array([1.0, -2.0, 0.5, -0.1]) + rng.normal(size=200) * 0.1
    w = linear.nnls_gram(X.T @ X, X.T @ y)
    best = None
    import itertools

    for mask in itertools.product([0, 1], repeat=4):
        idx = [i for i in range(4) if mask[i]]
        cand = np.zeros(4)
        if idx:
            sol = np.linalg.lstsq(X[:, idx], y, rcond=None)[0]
            if (sol < 0).any():
                continue
            cand[idx] = sol
        err = np.sum((y - X @ cand) ** 2)
        best = err if best is None or err < best else best
    assert np.sum((y - X @ w) ** 2) <= best + 1e-9


def _bayes_reference(Z, y, a1=1e-6, a2=1e-6, l1=1e-6, l2=1e-6, max_iter=300, tol=1e-3):
    """Evidence iterations on the data matrix itself (the brute-force form)."""
    Zc, yc = Z - Z.mean(0), y - y.mean()
    U, S, Vh = np.linalg.svd(Zc, full_matrices=False)
    eig = S ** 2
    n = len(y)
    alpha, lam = 1.0 / (np.var(yc) + np.finfo(float).eps), 1.0
    coef_old = None
    for it in range(max_iter):
        coef = Vh.T @ (Vh @ (Zc.T @ yc) / (eig + lam / alpha))
        rss = np.sum((yc - Zc @ coef) ** 2)
        gamma = np.sum(alpha * eig / (lam + alpha * eig))
        lam = (gamma + 2 * l1) / (np.sum(coef ** 2) + 2 * l2)
        alpha = (n - gamma + 2 * a1) / (rss + 2 * a2)
        if coef_old is not None and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef
    coef = Vh.T @ (Vh @ (Zc.T @ yc) / (eig + lam / alpha))
    return coef, alpha, lam


def test_bayesian_ridge_matches_data_form(setup):
    _, m, Z, y = setup
    b, w, sigma, alpha, lam, _ = linear.fit_bayesian_ridge(m)
    ref_w, ref_alpha, ref_lam = _bayes_reference(Z, y)
    assert np.allclose(w, ref_w, rtol=1e-6)
    assert abs(alpha - ref_alpha) < 1e-6 * ref_alpha
    assert np.allclose(sigma, sigma.T) and np.all(np.linalg.eigvalsh(sigma) > 0)


def test_validation_metrics_from_moments(reg, setup):
    scaler, m, Z, y = setup
    b, w = linear.fit_least_squares(m, True, False)
    r, r2 = m.rmse_r2(b, w)
    p = b + Z @ w
    assert abs(r - np.sqrt(np.mean((y - p) ** 2))) < 1e-6 * r
    assert abs(r2 - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-9


def test_linear_model_expression_and_distribution(reg, setup):
    scaler, m, Z, y = setup
    b, w, sigma, alpha, _, _ = linear.fit_bayesian_ridge(m)
    model = LinearModel(scaler, b, w, sigma, alpha)
    mu, sd = model.dist_cols()
    got = reg.select(mu.alias("mu"), sd.alias("sd")).toPandas()
    assert np.allclose(got["mu"], b + Z @ w, rtol=1e-9)
    ref_sd = np.sqrt(np.einsum("ij,jk,ik->i", Z, sigma, Z) + 1 / alpha)
    assert np.allclose(got["sd"], ref_sd, rtol=1e-9)


def test_rounds_of_candidates_match_each_seed_alone(reg):
    from tablefit.plans.candidates import candidate_rounds, univariate_candidates

    for seed, (together, models) in zip((42, 7, 9), candidate_rounds(reg, SPEC, (42, 7, 9))):
        alone, one = univariate_candidates(reg, SPEC, seed)
        for a, b in zip(together.collect(), alone.collect()):
            assert (a.run_id, a.model_type, a.ord, a.feature) == (b.run_id, b.model_type, b.ord, b.feature)
            assert a.val_rmse == pytest.approx(b.val_rmse, rel=1e-10)
            assert (a.val_nll is None) == (b.val_nll is None) and (a.val_nll is None or a.val_nll == pytest.approx(b.val_nll, rel=1e-10))
        for k, m in models.items():
            assert np.allclose(m.coef, one[k].coef, rtol=1e-9) and np.isclose(m.intercept, one[k].intercept, rtol=1e-10)


def test_moments_under_another_scaler(reg, setup):
    from tablefit.functions.scaler import Scaler

    scaler, m, _, _ = setup
    other = Scaler(scaler.features, tuple(x + 0.3 for x in scaler.means), tuple(2.5 * s for s in scaler.stds))
    want = linear.moments(reg, other, "revenue", 123.0)[None]
    got = m.rescaled(scaler, other, 123.0)
    assert got.n == want.n and np.allclose(got.s, want.s, rtol=1e-9) and np.allclose(got.G, want.G, rtol=1e-9)
