"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

One scan reduces each row to a narrow key (byte length, hash of the first
characters, SHA-256). Lengths held by one row are settled by the length alone,
then (length, prefix) pairs held by one row by the prefix; only the rows of the
surviving groups take part in the comparison of full digests. No text is
shuffled. The groups are counted with map-side partial aggregates, written, and
joined back from the written table: a join whose small side is known to be small
is broadcast, else its hot groups are split by the skew handling of the join, as
nothing after it asks for its partitioning. No window or list holds a group.

Defined results: a null text counts as empty, a null ID loses against any other
ID and keeps itself only if the whole group has null IDs; repeated rows (same ID
and text) count each and share one answer. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import drop_rows, free_name, keep_table, lower_ascii, text_key, text_or_empty

PREFIX_CHARS = 64


def narrow_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    norm = lower_ascii(text_or_empty(text_col))
    return (docs.select(F.col(id_col).alias("id"), norm.alias("norm"), text_key(text_col).alias("key"))
            .select("id", F.octet_length("norm").alias("len"),
                    F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
                    F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), "key"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, key, keep_id, group_size, kept, sha``."""
    keys = keep_table(narrow_keys(docs, id_col, text_col), "exact-keys")
    # Level 1: lengths. Level 2: prefixes, among rows whose length repeats. The
    # prefix counts are taken once and rolled up to the lengths.
    by_prefix = keep_table(keys.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")), "exact-prefixes")
    by_len = by_prefix.groupBy("len").agg(F.sum("n").alias("n_len")).filter("n_len > 1")
    open_groups = keep_table(by_prefix.filter("n > 1").join(by_len, "len", "left_semi").select("len", "prefix"), "exact-open")
    # Level 3: full digests of the rows still open. Written between join and count, so that
    # the join may be split (or broadcast, its size known) and each task folds before the shuffle.
    open_rows = keep_table(keys.join(open_groups, ["len", "prefix"], "left_semi").select("id", "len", "prefix", "sha"), "exact-rows")
    full = keep_table(open_rows.groupBy("len", "prefix", "sha")
                      .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                      .filter("group_size > 1"), "exact-full")
    return (keys.join(full, ["len", "prefix", "sha"], "left")
            .select("id", "key",
                    F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                    "sha")
            .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept (one per group of equal texts)."""
    groups = keep_table(exact_groups(docs, id_col, text_col), "exact-groups")
    kept = groups.filter("kept")
    # One ID may stand in its group more than once, the texts equal but for case or altogether.
    twice = (kept.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low")).filter("n > 1"))
    gone = groups.filter(~F.col("kept")).select("id", "key")
    if twice.isEmpty():
        return drop_rows(docs, gone, id_col, text_col)
    other = kept.join(twice, "sha").filter("key != low").select("id", "key")
    key = free_name("__key", docs.columns)
    return (drop_rows(docs, gone.union(other), id_col, text_col).withColumn(key, text_key(text_col))
            .dropDuplicates([id_col, key]).drop(key))


ORACLE = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}', '{"abcdefghijklmnopqrstuvwxyz"}') AS norm
           FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


def query(spark, sf_dir) -> DataFrame:
    from tablefit.llm.common import table

    return exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
