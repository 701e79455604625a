"""The corpus pipeline: documents in, packed training sequences out.

Quality classifier, exact duplicates, near duplicates (five words, similarity
0.8), benchmark leaks, packing. Each stage works on all rows that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablefit.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from tablefit.llm.common import discard, keep_table, ship, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.keep_one(docs, k=5, pct=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

#: The stages are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), f"stage-{name}")
        kept.append(docs)
    packed = STAGES[-1][1](spark, docs, sf_dir)  # packing has written its pieces by now
    discard(*kept)
    return packed
