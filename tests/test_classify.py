"""Prose-only classification items: AUC by rank sum vs brute force, balance, logistic."""

import numpy as np
from pyspark.sql import functions as F

from tablefit.operators import classify


def test_roc_auc_brute_force(spark):
    rng = np.random.default_rng(0)
    score = rng.integers(0, 30, size=400).astype(float)
    label = (rng.random(400) < 0.3 + 0.01 * score).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(label, score)], "label int, score double")
    got = classify.roc_auc(df.repartition(4), "label", "score").first()["auc"]
    pos, neg = score[label == 1], score[label == 0]
    ref = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(got - ref) < 1e-12


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (1,)], "y int")
    rows = {r["y"]: (r["n"], r["share"], r["both_classes"]) for r in classify.class_balance(df, "y").collect()}
    assert rows == {1: (3, 0.75, True), 0: (1, 0.25, True)}
    import pytest

    with pytest.raises(ValueError):
        classify.validate_class_balance(df.filter(F.col("y") == 1), "y")


def test_logistic_probability(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    y = (x + rng.normal(size=300) * 0.5 > 0).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    m = classify.fit_logistic(df, ["x"], "y")
    out = df.select("y", m.probability_col().alias("p")).toPandas()
    assert out["p"].between(0, 1).all()
    assert np.mean((out["p"] > 0.5) == (out["y"] == 1)) > 0.8


def _logit_rows(seed=1, n=400, d=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 5, 0.1][:d] + [0, 3, -2][:d]
    y = (x @ [1.0, -0.3, 4.0][:d] + 9 + rng.normal(size=n) * 2 > 0).astype(float)
    return x, y


def _frame(spark, x, y):
    cols = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], f"{cols}, y double").repartition(3)


def test_logistic_equals_spark_ml(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    x, y = _logit_rows()
    df, names = _frame(spark, x, y), ["x0", "x1", "x2"]
    for reg in (0.0, 0.1):
        m = classify.fit_logistic(df, names, "y", reg)
        assert m.status == "converged" and all(b <= a + 1e-12 for a, b in zip(m.history, m.history[1:]))
        z = [m.scaler.column(i).alias(f"z{i}") for i in range(3)]
        data = VectorAssembler(inputCols=["z0", "z1", "z2"], outputCol="f").transform(df.select("y", *z))
        ml = LogisticRegression(featuresCol="f", labelCol="y", regParam=reg, standardization=False, maxIter=500, tol=1e-14).fit(data)
        assert np.allclose([m.intercept, *m.coef], [ml.intercept, *ml.coefficients.toArray()], rtol=1e-6, atol=1e-6)


def test_logistic_separable_constant_and_nulls(spark):
    x, y = _logit_rows(2, 60, 1)
    m = classify.fit_logistic(_frame(spark, x, (x[:, 0] > 0.1).astype(float)), ["x0"], "y")
    assert m.status == "separable" and np.isfinite(m.coef[0])
    assert classify.fit_logistic(_frame(spark, x, np.ones(60)), ["x0"], "y").status == "separable"
    # A ridge has an optimum there too.
    assert classify.fit_logistic(_frame(spark, x, (x[:, 0] > 0.1).astype(float)), ["x0"], "y", 0.01).status == "converged"
    # A constant column weighs nothing; a row with a null is left out.
    two = np.column_stack([x[:, 0], np.full(60, 7.0)])
    df = _frame(spark, two, y)
    more = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0), (2.0, None, 0.0), (1.0, 1.0, None)], "x0 double, x1 double, y double"))
    a, b = classify.fit_logistic(df, ["x0", "x1"], "y"), classify.fit_logistic(more, ["x0", "x1"], "y")
    assert a.coef == b.coef and abs(a.coef[1]) < 1e-9
    import pytest

    with pytest.raises(ValueError, match="without nulls"):
        classify.fit_logistic(df.limit(0), ["x0"], "y")
