import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.llm import centroids

from .conftest import by_row

SCHEMA = "vec_id long, embedding array<float>, id string, x string, cluster string, distance string"


def brute(rows, k, rounds, dim=64):
    """Plain Python over (vec_id, vector): (vec_id, cluster, distance) and the final centroids."""
    kept = [(i, [math.floor(256 * float(e)) for e in v]) for i, v in rows
            if v is not None and len(v) == dim and all(e is not None and math.isfinite(e) for e in v)]
    cs = [x for _, x in sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        cs = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(cs)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept], cs


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(160, 64)).astype(np.float32)
    out = [(i, [float(e) for e in v]) for i, v in enumerate(base)]
    out += [(500 + i, out[3][1]) for i in range(60)]  # a hot vector
    out += [(7, out[7][1]), (7, out[8][1])]  # a repeated row, an ID with another vector
    out += [(900, None), (901, []), (902, [0.5] * 63), (903, [float("nan")] + [0.1] * 63), (904, [None] + [0.1] * 63),
            (905, [float("-inf")] + [0.1] * 63), (906, [0.0] * 64), (907, [-0.001] * 64), (None, out[9][1]), (None, out[10][1])]
    return out


def test_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA).repartition(5)
    for k, rounds in ((40, 5), (7, 2), (1, 1)):
        got, cs = centroids.cluster(df, k, rounds)
        want, want_cs = brute(rows, k, rounds)
        assert by_row(got, "id", "cluster", "distance") == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))
        assert cs.tolist() == want_cs


def test_search_prunes_and_keeps_ties():
    rng = np.random.default_rng(1)
    c = rng.integers(-200, 200, size=(40, 64))
    c[11], c[30] = c[5], c[5]  # equal centroids: the smallest number wins
    x = np.concatenate([rng.integers(-200, 200, size=(500, 64)), c, c + 1, np.zeros((3, 64), int)])
    search = centroids.CentroidSearch(c)
    who, d = search.nearest(x)
    every = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (who == every.argmin(1)).all() and (d == every.min(1)).all()
    assert search.tried < every.size
    far = np.full((2, 64), (1 << 30) // 64)
    far[1] *= -1
    who, d = centroids.CentroidSearch(far).nearest(np.concatenate([far, far // 2, x]))
    assert d[0] == 0 and who[1] == 1 and (d >= 0).all()


def test_small_and_empty_tables(spark):
    assert centroids.cluster(spark.createDataFrame([], SCHEMA))[0].count() == 0
    three = spark.createDataFrame([(i, [float(i)] * 64, *[None] * 4) for i in range(3)], SCHEMA)
    got, cs = centroids.cluster(three)
    assert len(cs) == 3 and [r["distance"] for r in got.collect()] == [0, 0, 0]
    huge = spark.createDataFrame([(1, [1e30] * 64, *[None] * 4), (2, [-1e30] * 64, *[None] * 4)], SCHEMA)
    assert centroids.cluster(huge)[0].agg(F.sum("distance")).first()[0] == 0


def test_components_of_other_types(spark):
    got, _ = centroids.cluster(spark.createDataFrame([(1, [0.5] * 8), (2, [0.25] * 8)], "vec_id int, embedding array<double>"), 1, 1, 8)
    assert by_row(got, "id", "distance") == [(1, 8 * 32 ** 2), (2, 8 * 32 ** 2)]
