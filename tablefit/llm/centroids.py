"""K-means on integer vectors with an exact, pruned centroid search.

Equal-average equal-variance search: the centroids lie sorted by their component
mean. A vector starts where its own mean falls and scans outward, the nearer side
first. With k components, sums S and spreads V = sqrt(k sum(x^2) - S^2),

    k * distance >= (Sx - Sc)^2 + (Vx - Vc)^2.

The first term alone ends the scan (all centroids further out have a larger one);
both together reject a centroid without touching its components. What is left is
settled by the exact integer distance, equal ones by the smaller centroid number.
The first test is exact in integers; the second is in floating point with a
margin that only lets more centroids through.

A round is one pass over the written vectors: every task folds its vectors to one
row per (cluster, component), Spark adds them. Only the centroids (``k`` times the
number of components) pass the driver, whatever the number of vectors, and no row
is grouped by its cluster, so a hot cluster is no hot task.

Defined results: vectors that are null, of another length, or that hold a null,
NaN or infinite component are left out; a null ID is never a starting centroid
but is assigned like any other; repeated rows count each time, and starting
centroids with equal hashes are ordered by their components; fewer kept vectors
than ``k`` give as many centroids as there are; an empty table gives an empty
result. Scaled components are held within +-2^30 / dimension (65,536 before
scaling, for 64 components), within which every sum and distance fits a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import keep_table, table

FAR = np.int64(1) << 62


class CentroidSearch:
    """Centroids in the order of their means, with sums and spreads."""

    def __init__(self, centroids: np.ndarray):
        c = np.asarray(centroids, np.int64)
        self.k, self.dim = c.shape
        total = c.sum(1)
        self.order = np.argsort(total, kind="stable")
        self.c, self.total = c[self.order], total[self.order]
        self.spread = np.sqrt((self.dim * (self.c * self.c).sum(1) - self.total ** 2).astype(float))
        self.tried = 0  # exact distances computed

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each row of ``x``."""
        n, k, dim = len(x), self.k, self.dim
        total = x.sum(1)
        spread = np.sqrt((dim * (x * x).sum(1) - total ** 2).astype(float))
        right = np.searchsorted(self.total, total)
        left = right - 1
        best, who = np.full(n, FAR // dim), np.full(n, k)
        live = np.arange(n)
        while len(live):
            lo, hi = left[live], right[live]
            down = np.where(lo >= 0, total[live] - self.total[lo], FAR)
            up = np.where(hi < k, self.total[np.minimum(hi, k - 1)] - total[live], FAR)
            gap = np.minimum(down, up)
            # Sums lie within 2^30, so a gap is below 2^31 and its square fits.
            on = (gap < FAR) & (np.minimum(gap, np.int64(1) << 31) ** 2 <= dim * best[live])
            live, gap, go_left = live[on], gap[on], (down <= up)[on]
            at = np.where(go_left, left[live], right[live])
            left[live] -= go_left
            right[live] += ~go_left
            a, b = spread[live], self.spread[at]
            apart = np.maximum(np.abs(a - b) - (a + b) * 1e-14, 0.0)
            near = (gap.astype(float) ** 2 + apart ** 2) * (1 - 1e-12) <= dim * best[live].astype(float)
            row, at = live[near], at[near]
            self.tried += len(row)
            d = x[row] - self.c[at]
            d = (d * d).sum(1)
            number = self.order[at]
            won = (d < best[row]) | ((d == best[row]) & (number < who[row]))
            best[row[won]], who[row[won]] = d[won], number[won]
        return who, best


def scaled_vectors(vectors: DataFrame, dim: int = 64, scale: int = 256, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """``id, x``: integer components floor(scale * value) of the vectors kept."""
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    bound = F.lit(float((1 << 30) // dim))
    whole = F.transform(v, lambda e: F.floor(F.greatest(F.least(e * F.lit(float(scale)), bound), -bound)).cast("long"))
    return (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias(vector_col))
            .filter(F.col(vector_col).isNotNull() & (F.size(vector_col) == dim) & fit)
            .select("id", whole.alias("x")))


def first_centroids(kept: DataFrame, k: int, seed: int = 2) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``, in that order."""
    rows = (kept.filter("id IS NOT NULL")
            .select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), "x")
            .orderBy("h", "x").limit(k).collect())
    return np.array([r["x"] for r in rows], np.int64)


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def moved_centroids(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: nearest centroid of every vector, then the floor of each cluster's mean."""
    k, dim = centroids.shape

    def fold(batches):
        import pyarrow as pa

        search, total, n = CentroidSearch(centroids), np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), dim)
                who, _ = search.nearest(x)
                # Rows in cluster order, so that each cluster is one slice to add up.
                by = np.argsort(who, kind="stable")
                seen, start = np.unique(who[by], return_index=True)
                total[seen] += np.add.reduceat(x[by], start, axis=0)
                n += np.bincount(who, minlength=k)
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(np.repeat(some, dim)), pa.array(np.tile(np.arange(dim), len(some))),
                               pa.array(total[some].reshape(-1)), pa.array(np.repeat(n[some], dim))], ["cluster", "i", "s", "n"])

    sums = (kept.select("x").mapInArrow(fold, "cluster long, i long, s long, n long")
            .groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
    out = centroids.copy()
    for r in sums:  # k times dim rows; Python's // is the floor, also below zero
        out[r["cluster"], r["i"]] = r["s"] // r["n"]
    return out


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` for every vector."""
    dim = centroids.shape[1]
    id_type = kept.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        search = CentroidSearch(centroids)
        for b in batches:
            if b.num_rows:
                who, d = search.nearest(_matrix(b.column("x"), dim))
                yield pa.record_batch([b.column("id"), pa.array(who.astype(np.int32)), pa.array(d)], ["id", "cluster", "distance"])

    return kept.mapInArrow(run, f"id {id_type}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance per vector; final centroids)``."""
    kept = keep_table(scaled_vectors(vectors, dim, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(kept, k, seed).reshape(-1, dim)
    if not len(centroids):
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    for _ in range(rounds):
        centroids = moved_centroids(kept, centroids)
    return assign(kept, centroids), centroids


def query(spark, sf_dir) -> DataFrame:
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"))
    assigned = keep_table(assigned, "clusters")
    of = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    facts = [(c, of[c], sum(of.values()), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
             for c, row in enumerate(centroids.tolist()) if c in of]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The same by comparing every vector with every centroid, round by round."""
    ctes = [f"v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x "
            f"FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim})",
            "long AS (SELECT r, unnest(range(1, " + str(dim + 1) + ")) AS i, unnest(x) AS x FROM v)",
            f"first AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS cluster FROM v WHERE vec_id IS NOT NULL "
            f"ORDER BY cluster LIMIT {k})",
            "c0 AS (SELECT cluster, i, x FROM first JOIN long USING (r))"]
    for t in range(rounds + 1):
        ctes.append(f"d{t} AS MATERIALIZED (SELECT r, cluster, sum((long.x - c.x) * (long.x - c.x)) AS distance FROM long JOIN c{t} AS c USING (i) GROUP BY r, cluster)")
        ctes.append(f"a{t} AS MATERIALIZED (SELECT r, cluster, distance FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)")
        if t < rounds:
            ctes.append(f"c{t + 1} AS MATERIALIZED (SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM c{t} AS c LEFT JOIN (SELECT cluster, i, "
                        f"CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM a{t} JOIN long USING (r) "
                        "GROUP BY cluster, i) AS m USING (cluster, i))")
    return ("WITH " + ", ".join(ctes) + f", digest AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) "
            "SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, "
            f"CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN v USING (r) JOIN digest USING (cluster)")


ORACLE = oracle()
