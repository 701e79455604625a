"""Scoring of tree ensembles at the declared sizes, against nested expressions on small ones."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.functions.scaler import Scaler
from tablefit.operators.models import (
    FlatTrees, NGBoostModel, TreeEnsembleModel, model_from_json, predict_numpy, tree_column, weighted_leaves)

NAMES = ("a", "b", "c")
SCALER = Scaler(NAMES, (0.1, 0.2, 0.3), (1.0, 2.0, 0.5))


def tree(rng, depth):
    if depth == 0 or rng.random() < 0.1:
        return {"v": rng.uniform(-1, 1)}
    return {"f": rng.randrange(3), "t": rng.uniform(-1, 1), "l": tree(rng, depth - 1), "r": tree(rng, depth - 1)}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 5000, numPartitions=4).select("id", *[F.rand(i).alias(n) for i, n in enumerate(NAMES)]).cache()


def test_small_models_equal_nested_expressions(rows):
    rng = random.Random(4)
    m = TreeEnsembleModel(SCALER, [tree(rng, 3) for _ in range(7)], [rng.random() for _ in range(7)], 0.25)
    want = F.lit(0.25)
    for t, w in zip(m.trees, m.weights):
        want = want + F.lit(w) * tree_column(t, m.z())
    d = rows.select(F.abs(m.predict_col() - want).alias("d")).agg(F.max("d")).first()[0]
    assert d < 1e-12
    ng = NGBoostModel(SCALER, 1.0, -0.5, [{"mu": tree(rng, 2), "s": tree(rng, 3), "scale": 2.0} for _ in range(5)], 0.1)
    mu, s = F.lit(1.0), F.lit(-0.5)
    for r in ng.rounds:
        mu = mu - F.lit(0.2) * tree_column(r["mu"], ng.z())
        s = s - F.lit(0.2) * tree_column(r["s"], ng.z())
    a, b = ng.dist_cols()
    d = rows.select(F.greatest(F.abs(a - mu), F.abs(b - F.exp(s))).alias("d")).agg(F.max("d")).first()[0]
    assert d < 1e-12


def test_largest_declared_sizes(rows):
    rng = random.Random(5)
    big = TreeEnsembleModel(SCALER, [tree(rng, 6) for _ in range(200)], [0.1] * 200, 3.0)
    ng = NGBoostModel(SCALER, 1.0, 0.0, [{"mu": tree(rng, 4), "s": tree(rng, 4), "scale": 1.0} for _ in range(400)], 0.01)
    for m in (big, ng):
        m = model_from_json(m.to_json())
        t = time.time()
        col = m.predict_col()
        assert time.time() - t < 2.0
        got = rows.select("id", *NAMES, col.alias("p")).toPandas()
        assert np.allclose(got["p"], predict_numpy(m, got[list(NAMES)].to_numpy()), rtol=1e-12)


def test_a_leaf_alone_and_no_rounds(rows):
    m = TreeEnsembleModel(SCALER, [{"v": 2.0}], [0.5], 1.0)
    ng = NGBoostModel(SCALER, 1.5, 0.0, [], 0.1)
    assert rows.select(m.predict_col().alias("p"), ng.predict_col().alias("q")).distinct().collect() == [(2.0, 1.5)]


def binned_tree(rng, depth):
    """A tree on few cut points, as those grown on bins have."""
    if depth == 0 or rng.random() < 0.1:
        return {"v": rng.uniform(-1, 1)}
    return {"f": rng.randrange(3), "t": rng.randrange(-8, 9) / 4, "l": binned_tree(rng, depth - 1), "r": binned_tree(rng, depth - 1)}


def test_leaf_tables_equal_walks_and_are_faster():
    """Trees as grown on bins: the same bits of the result from far fewer steps."""
    rng = random.Random(6)
    Z = np.random.default_rng(6).normal(size=(10_000, 3))
    Z[::7] = np.round(Z[::7] * 4) / 4  # on a cut point
    Z[:6, 0] = [np.nan, np.inf, -np.inf, 0.0, -0.0, 0.25]
    for n, depth, width in ((200, 6, 1), (200, 3, 2), (3, 0, 1), (65, 6, 2)):
        flat = FlatTrees([binned_tree(rng, depth) for _ in range(n)]).arrays()
        weights = np.random.default_rng(n).normal(size=(n, width))
        took = []
        for form in (flat, (*flat[:-1], None)):
            t = time.perf_counter()
            took.append(weighted_leaves(form, Z, weights))
            took.append(time.perf_counter() - t)
        assert flat[-1] is not None and np.array_equal(took[0], took[2])
        if depth == 6 and n == 200:
            assert took[3] > 2 * took[1]


def test_many_leaves_or_cut_points_are_walked():
    rng = random.Random(7)

    def full(depth, cut):
        return {"v": rng.random()} if depth == 0 else {"f": 0, "t": cut(), "l": full(depth - 1, cut), "r": full(depth - 1, cut)}

    assert FlatTrees([full(7, lambda: rng.randrange(20) / 4)]).tables is None
    assert FlatTrees([full(6, rng.random) for _ in range(100)]).tables is None
    assert FlatTrees([full(6, lambda: rng.randrange(20) / 4) for _ in range(100)]).tables is not None
