"""Calibration views: density histogram, mixture density, per-row curves.

Bounds (min / max / count) are one aggregate collected as three numbers; the
curves then run as a generator plus a grouped aggregate whose shuffle is one
row per grid point per task (partial aggregation), whatever the row count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.functions.stats import linspace_point, normal_pdf
from tablefit.operators.split import sample_k

# |z| beyond which a Normal density underflows to 0.0 (exp(-745) is below the
# smallest double).
SUPPORT_SIGMAS = 40.0


def _bounds(df: DataFrame, value: str) -> tuple[float, float, int]:
    row = df.agg(F.min(F.col(value).cast("double")).alias("lo"), F.max(F.col(value).cast("double")).alias("hi"),
                 F.count(F.col(value)).alias("n")).first()
    return row["lo"], row["hi"], row["n"]


def density_histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """``bins`` equal bins over [min, max] (last bin closed); height = count / (n * width).

    Empty bins are kept (right join from the ``bins``-row frame of bin numbers).
    A column of one value gets bins over that value plus and minus a half. Nulls
    are left out; NaN or infinite values are an error.
    """
    lo, hi, n = _bounds(df, value)
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([], "bin int, lo double, hi double, n long, density double")
    if not (math.isfinite(lo) and math.isfinite(hi)):
        raise ValueError(f"{value!r} has NaN or infinite values; a histogram needs finite ones")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    x = F.col(value).cast("double")
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    F.when(F.col("bin") == bins - 1, F.lit(hi))
                    .otherwise(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n"),
                    (F.coalesce(F.col("n"), F.lit(0)) / F.lit(float(n) * width)).alias("density")))


def mixture_density(df: DataFrame, mu: Column | str, sigma: Column | str, lo: float, hi: float,
                    points: int = 500, dedupe: bool = False) -> DataFrame:
    """Mean over rows of Normal(mu, sigma) densities on ``points`` grid points.

    Each row expands to (at most) ``points`` densities in the scan stage and is
    folded by a partial aggregate at once, so the shuffle is one row per grid
    point per task. ``dedupe=True`` first groups equal (mu, sigma)
    pairs (worth it when they repeat, e.g. a discrete mean), weighting by count.
    """
    mu_c = F.col(mu) if isinstance(mu, str) else mu
    sd_c = F.col(sigma) if isinstance(sigma, str) else sigma
    pairs = df.select(mu_c.cast("double").alias("_tf_mu"), sd_c.cast("double").alias("_tf_sd"))
    if dedupe:
        pairs = pairs.groupBy("_tf_mu", "_tf_sd").agg(F.count(F.lit(1)).cast("double").alias("_tf_w"))
    else:
        pairs = pairs.withColumn("_tf_w", F.lit(1.0))
    # Beyond SUPPORT_SIGMAS standard deviations exp(-z^2 / 2) is exactly 0.0 in
    # double precision, so each row only expands over the grid points in its
    # support: the same sums, less work when sigma is small against the range.
    step = (hi - lo) / (points - 1) if points > 1 else 1.0
    reach = F.lit(SUPPORT_SIGMAS) * F.col("_tf_sd")
    first = F.greatest(F.lit(0), F.floor((F.col("_tf_mu") - reach - F.lit(lo)) / F.lit(step)).cast("int"))
    last = F.least(F.lit(points - 1), F.ceil((F.col("_tf_mu") + reach - F.lit(lo)) / F.lit(step)).cast("int"))
    # Grid index -1 carries each row's weight once, so the normaliser comes out
    # of the same aggregate.
    span = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    grid = pairs.select("*", F.explode(F.concat(F.array(F.lit(-1)), span)).alias("i"))
    x = linspace_point(F.col("i"), F.lit(lo), F.lit(hi), points)
    contrib = F.when(F.col("i") == -1, F.col("_tf_w")).otherwise(F.col("_tf_w") * normal_pdf(x, "_tf_mu", "_tf_sd"))
    sums = grid.groupBy("i").agg(F.sum(contrib).alias("_tf_s"))
    # At most points + 1 rows: the window and the join below stay small.
    sums = sums.withColumn("_tf_tot", F.max(F.when(F.col("i") == -1, F.col("_tf_s"))).over(Window.partitionBy()))
    all_points = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    joined = all_points.join(F.broadcast(sums.filter(F.col("i") >= 0)), "i", "left")
    total = F.max("_tf_tot").over(Window.partitionBy())
    return joined.select("i", linspace_point(F.col("i"), F.lit(lo), F.lit(hi), points).alias("x"),
                         (F.coalesce(F.col("_tf_s"), F.lit(0.0)) / total).alias("density"))


# Cells of the expanded mixture: half widths in units of the cell's sigma and in
# log sigma, and the order of the expansion.
CELL_MU, CELL_LOG, ORDER = 0.5, 0.04, 24


def expansion_error(half_mu: float = CELL_MU, half_log: float = CELL_LOG, order: int = ORDER) -> float:
    """Bound on the error of one row's expanded density, in units of 1 / (its cell's
    sigma): the terms left out, each by Cramer's bound on Hermite functions
    (|He_n(z)| phi(z) <= 0.4335 sqrt(n!))."""
    a, b = half_mu, math.expm1(2 * half_log) / 2
    c, total = [1.0, a], 0.0
    for n in range(2, order + 200):
        c.append((a * c[n - 1] + 2 * b * c[n - 2]) / n)
        if n > order:
            total += c[n] * 0.4335 * math.exp(math.lgamma(n + 1) / 2)
    return total


def _cell_moments(pairs: DataFrame) -> DataFrame:
    """``s, c, m0..``: moments of the rows ``(mu, sd, w)`` of each cell. A Normal near
    Normal(m, s) is sum_n c_n He_n(z) phi(z) / s with z = (x - m) / s and
    n c_n = a c_(n-1) + 2 b c_(n-2), a = (mu - m) / s, b = (sd^2 / s^2 - 1) / 2."""
    names = [f"m{n}" for n in range(ORDER + 1)]
    half_mu, half_log = CELL_MU, CELL_LOG

    def fold(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            mu, sd, w = (batch.column(c).to_numpy() for c in range(3))
            if not len(mu):
                continue
            s = np.rint(np.log(sd) / (2 * half_log))
            s0 = np.exp(s * 2 * half_log)
            at = np.rint(mu / (2 * half_mu * s0))
            a, b = mu / s0 - at * 2 * half_mu, ((sd / s0) ** 2 - 1) / 2
            cells, where = np.unique(np.stack([s, at]), axis=1, return_inverse=True)
            where = where.reshape(-1)
            older, now, sums = None, w, []
            for n in range(len(names)):
                if n == 1:
                    older, now = now, a * now
                elif n > 1:
                    older, now = now, (a * now + 2 * b * older) / n
                sums.append(np.bincount(where, now, minlength=cells.shape[1]))
            yield pa.record_batch([pa.array(cells[0].astype(np.int32)), pa.array(cells[1].astype(np.int64)), *map(pa.array, sums)], ["s", "c", *names])

    kinds = "s int, c long, " + ", ".join(f"{n} double" for n in names)
    return pairs.mapInArrow(fold, kinds).groupBy("s", "c").agg(*[F.sum(n).alias(n) for n in names])


def mixture_density_cells(df: DataFrame, mu: Column | str, sigma: Column | str, lo: float, hi: float, points: int = 500) -> DataFrame:
    """C2 by local expansions: rows are folded into cells of near-equal (mu, log sigma),
    25 moments each (one shuffle row a cell and task), and only cells meet the grid.
    The work on the grid grows with the cells, not the rows; the error of a density is
    below ``expansion_error()`` over the smallest sigma. Rows whose mean is not finite
    or whose sigma is not positive and finite are left out."""
    mu_c = (F.col(mu) if isinstance(mu, str) else mu).cast("double")
    sd_c = (F.col(sigma) if isinstance(sigma, str) else sigma).cast("double")
    inf = F.lit(float("inf"))
    pairs = df.select(mu_c.alias("mu"), sd_c.alias("sd"), F.lit(1.0).alias("w")).filter(
        (F.abs("mu") < inf) & (F.col("sd") > 0) & (F.col("sd") < inf))
    cells = _cell_moments(pairs)
    names = [c for c in cells.columns if c not in ("s", "c")]
    half_mu, half_log = CELL_MU, CELL_LOG
    step = (hi - lo) / (points - 1) if points > 1 else 0.0

    def on_grid(batches):
        import numpy as np
        import pyarrow as pa

        x, total, weight = lo + step * np.arange(points), np.zeros(points), 0.0
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                s0 = np.exp(part.column("s").to_numpy() * 2 * half_log)
                m0 = part.column("c").to_numpy() * 2 * half_mu * s0
                z = np.clip((x[None, :] - m0[:, None]) / s0[:, None], -39.0, 39.0)  # the density is 0.0 beyond
                older, he, out = None, np.ones_like(z), 0.0
                for n, name in enumerate(names):
                    if n == 1:
                        older, he = he, z
                    elif n > 1:
                        older, he = he, z * he - (n - 1) * older
                    out = out + part.column(name).to_numpy()[:, None] * he
                total += (out * np.exp(-z * z / 2) / (math.sqrt(2 * math.pi) * s0[:, None])).sum(0)
                weight += part.column("m0").to_numpy().sum()
        yield pa.record_batch([pa.array(np.arange(-1, points, dtype=np.int32)), pa.array(np.concatenate([[weight], total]))], ["i", "v"])

    # points + 1 rows a task, then points + 1 rows in all.
    sums = cells.mapInArrow(on_grid, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    sums = sums.withColumn("n", F.max(F.when(F.col("i") == -1, F.col("v"))).over(Window.partitionBy()))
    return sums.filter("i >= 0").select("i", linspace_point(F.col("i"), F.lit(lo), F.lit(hi), points).alias("x"),
                                        F.when(F.col("n") > 0, F.greatest(F.col("v"), F.lit(0.0)) / F.col("n")).alias("density"))


def mixture_density_for(df: DataFrame, actual: str, mu, sigma, points: int = 500,
                        margin: float = 30.0, dedupe: bool = False) -> DataFrame:
    """C2 with the grid from (min - margin) to (max + margin) of the actual values."""
    lo, hi, _ = _bounds(df, actual)
    return mixture_density(df, mu, sigma, lo - margin, hi + margin, points, dedupe)


def point_curves(df: DataFrame, id_col: str, actual: str, mu, sigma, k: int = 4, points: int = 200,
                 width: float = 4.0, seed: int = 42) -> DataFrame:
    """For ``k`` sampled rows, ``points`` densities over mu +- width * sigma, with the actual value."""
    mu_c = F.col(mu) if isinstance(mu, str) else mu
    sd_c = F.col(sigma) if isinstance(sigma, str) else sigma
    rows = sample_k(df.select(id_col, F.col(actual).cast("double").alias("actual"),
                              mu_c.cast("double").alias("mu"), sd_c.cast("double").alias("sigma")),
                    id_col, k, seed)
    grid = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = linspace_point(F.col("i"), F.col("mu") - F.lit(width) * F.col("sigma"),
                       F.col("mu") + F.lit(width) * F.col("sigma"), points)
    return grid.select(id_col, "i", x.alias("x"), normal_pdf(x, "mu", "sigma").alias("density"),
                       "actual", "mu", "sigma")
