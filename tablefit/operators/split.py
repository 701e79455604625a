"""Splits and samples.

Membership is a function of a seeded hash of the row ID, so a split does not
depend on how the input happens to be partitioned (``randomSplit`` does) and a
recomputed partition after an executor loss lands on the same side.
"""

from __future__ import annotations

from decimal import Decimal

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.operators.ordered import prefix_sums
from tablefit.session import materialize

# The exact selection first histograms the top HIST_BITS of the 32-bit hash.
HIST_BITS = 20
COARSE_BITS = 10
# Copies of one row that a single row is expanded to at a time.
COPIES = 1000


def hash_u32(id_col: str | Column, seed: int = 42) -> Column:
    """Seeded 32-bit hash of the ID: first 8 hex digits of md5('<seed>:<id>').

    Written with md5 so SQL engines other than Spark compute the same value. A
    null ID hashes like the word ``null``: it has a side like any other.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit("null")))), 1, 8)
    return F.conv(hexed, 16, 10).cast("bigint")


def hash_threshold(fraction: float) -> int:
    return int(fraction * (1 << 32))


# --------------------------------------------------------------------------- X1
def split_train_scoring(df: DataFrame, id_col: str, train_fraction: float = 0.5, seed: int = 42,
                        method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Disjoint, covering two-way split; each row goes to train with ``train_fraction``.

    ``method="hash"`` (default) is partition-independent and needs no shuffle;
    ``method="random"`` is ``randomSplit`` for parity with the original.
    """
    if method == "random":
        train, scoring = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
        return train, scoring
    if method != "hash":
        raise ValueError(f"unknown split method {method!r}")
    in_train = hash_u32(id_col, seed) < F.lit(hash_threshold(train_fraction))
    return df.filter(in_train), df.filter(~in_train)


# --------------------------------------------------------------------------- X2, O1
def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _boundaries(base: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """Per stratum the hash bucket ``_tf_bb`` in which the wanted number is
    reached, and how many of its rows (``_tf_need``) still belong to it.

    A coarse running total (2^10 buckets per stratum) and a fine one inside the
    boundary coarse bucket: no window sees more than 1024 rows per stratum.
    """
    shift = HIST_BITS - COARSE_BITS
    hist = base.groupBy(*keys, "_tf_b").agg(F.count(F.lit(1)).alias("_tf_n"))
    coarse = hist.groupBy(*keys, F.shiftright("_tf_b", shift).alias("_tf_c")).agg(F.sum("_tf_n").alias("_tf_cn"))
    run = Window.partitionBy(*keys).orderBy("_tf_c").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.ceil(F.sum("_tf_cn").over(Window.partitionBy(*keys)).cast("decimal(38,0)")
                    * F.lit(Decimal(repr(float(fraction))))).cast("bigint")
    coarse = coarse.withColumn("_tf_ccum", F.sum("_tf_cn").over(run)).withColumn("_tf_k", wanted)
    coarse = (coarse.filter("_tf_ccum >= _tf_k AND _tf_ccum - _tf_cn < _tf_k")
              .withColumn("_tf_cneed", F.expr("_tf_k - (_tf_ccum - _tf_cn)")))
    fine = (hist.alias("h").join(coarse.alias("c"), _same("h", "c", keys)
                                 & (F.shiftright("h._tf_b", shift) == F.col("c._tf_c")))
            .select("h.*", "c._tf_cneed"))
    run = Window.partitionBy(*keys).orderBy("_tf_b").rowsBetween(Window.unboundedPreceding, 0)
    return (fine.withColumn("_tf_cum", F.sum("_tf_n").over(run))
            .filter("_tf_cum >= _tf_cneed AND _tf_cum - _tf_n < _tf_cneed")
            .select(*keys, F.col("_tf_b").alias("_tf_bb"), F.expr("_tf_cneed - (_tf_cum - _tf_n)").alias("_tf_need")))


def exact_flag(df: DataFrame, id_col: str, fraction: float, seed: int = 42,
               strata: list[str] | None = None, flag: str = "_tf_held") -> DataFrame:
    """Flag exactly ``ceil(fraction * n_s)`` rows per stratum: the lowest by
    (hash, ID, other columns).

    No global sort: a histogram of the top ``HIST_BITS`` of the hash finds each
    stratum's boundary bucket; rows below it are in, rows above it are out. The
    rows of the boundary buckets (about n_s / 2^20, or a hot ID) are folded to
    distinct rows with a count, ordered by a distributed running total, and cut
    where the number is reached; copies of a row are interchangeable, so they
    are written out again from their count. Null IDs and null strata are values
    like any other. Columns must be of types that can be grouped.
    """
    strata = list(strata or [])
    keys = strata or ["_tf_all"]
    cols = list(df.columns)
    base = df.withColumn("_tf_h", hash_u32(id_col, seed))
    if not strata:
        base = base.withColumn("_tf_all", F.lit(0))
    base = base.withColumn("_tf_b", F.shiftright(F.col("_tf_h"), 32 - HIST_BITS).cast("bigint"))
    bound = materialize(_boundaries(base, keys, fraction))  # a row per stratum
    placed = (base.alias("r").join(bound.alias("b"), _same("r", "b", keys), "left")
              .select("r.*", "b._tf_bb", "b._tf_need"))
    clear = placed.filter("_tf_bb IS NULL OR _tf_b != _tf_bb")
    clear = clear.select(*cols, F.coalesce(F.expr("_tf_b < _tf_bb"), F.lit(False)).alias(flag))

    order = [*keys, "_tf_h", id_col, *[c for c in cols if c != id_col and c not in keys]]
    folded = (placed.filter("_tf_b = _tf_bb").groupBy(*order)
              .agg(F.count(F.lit(1)).alias("_tf_c"), F.first("_tf_need").alias("_tf_need")))
    ranked = prefix_sums(folded, list(dict.fromkeys(order)), ["_tf_c"])
    start = ranked.groupBy(*keys).agg(F.min("_tf_c_before").alias("_tf_start"))
    ranked = (ranked.alias("r").join(start.alias("s"), _same("r", "s", keys))
              .select("r.*", (F.col("r._tf_c_before") - F.col("s._tf_start")).alias("_tf_before")))
    taken = F.greatest(F.lit(0), F.least(F.col("_tf_c"), F.col("_tf_need") - F.col("_tf_before"))).cast("bigint")
    sides = ranked.withColumn("_tf_in", taken).select(*cols, F.explode(F.array(
        F.struct(F.lit(True).alias("held"), F.col("_tf_in").alias("n")),
        F.struct(F.lit(False).alias("held"), (F.col("_tf_c") - F.col("_tf_in")).alias("n")))).alias("_tf_side"))
    # Copies come back in two steps, so that no array grows with their number squared or all at once.
    n = F.col("_tf_side.n")
    chunks = sides.filter(n > 0).withColumn("_tf_at", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(COPIES).cast("bigint"))))
    copies = chunks.withColumn("_tf_one", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES), n - F.col("_tf_at")))))
    return clear.unionByName(copies.select(*cols, F.col("_tf_side.held").alias(flag)))


def exact_holdout(df: DataFrame, id_col: str, fraction: float = 0.2, seed: int = 42,
                  strata: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rest, held) with exactly ``ceil(fraction * n)`` held rows (per stratum)."""
    flagged = exact_flag(df, id_col, fraction, seed, strata)
    cols = df.columns
    return (flagged.filter(~F.col("_tf_held")).select(*cols),
            flagged.filter(F.col("_tf_held")).select(*cols))


def stratified_split(df: DataFrame, id_col: str, strata: list[str], train_fraction: float = 0.5,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """O1: per stratum exactly ``ceil(train_fraction * n_s)`` rows go to train."""
    flagged = exact_flag(df, id_col, train_fraction, seed, strata)
    cols = df.columns
    return (flagged.filter(F.col("_tf_held")).select(*cols),
            flagged.filter(~F.col("_tf_held")).select(*cols))


# --------------------------------------------------------------------------- X3, X4
def first_k(df: DataFrame, order_col: str, k: int = 5) -> DataFrame:
    """The first ``k`` rows by ``order_col`` (per-partition top-k, then merge)."""
    return df.orderBy(order_col).limit(k)


def sample_k(df: DataFrame, id_col: str, k: int = 4, seed: int = 42) -> DataFrame:
    """``k`` rows uniformly without replacement, reproducible by seed."""
    return df.orderBy(hash_u32(id_col, seed), F.col(id_col)).limit(k)
