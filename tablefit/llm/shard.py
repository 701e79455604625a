"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash
of the record and of its number among equal records. Equal records are folded to
one with a count first and dealt out again, so a third of all rows being copies
of one record spread as evenly as anything else. Pass 2 puts each bucket in a
canonical order, applies Fisher-Yates (``shuffle`` with a seed) and writes it
with the place of each record in the concatenation of the buckets. That is a
random permutation of the table which the records, the seed and the bucket size
fix: file layout, executors and session settings have no part in it. Shard ``s`` of
``n`` is a contiguous range, so row counts are at most one apart (law ``rows``).

The bucket files are written once, with all columns of the records; shard and
slot follow from the place when they are read, for any number of shards, without
a join. The offsets of the buckets travel with the records in the one shuffle.

Defined results: a null text has no bytes (size 1), nulls in any column travel
as they are, repeated rows keep their number, an empty table has no shards.
Columns must be of types that Spark can order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablefit.llm.common import discard, keep_table, scratch_path, text_or_empty

BUCKET_BYTES = 16 << 20
#: Buckets of one step of the running total, copies of a record dealt out at once.
STEP = 1024
#: Beyond that many buckets, several share a task of pass 2, one after the other.
MAX_TASKS = 10_000
MAX_BUCKETS = 2**31 - 1


def record_size(text_col: str = "text") -> Column:
    return F.octet_length(text_or_empty(text_col)).cast("bigint") + 1


def row_size(df: DataFrame) -> Column:
    """About the bytes of a row, all columns: what a bucket is measured by."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "struct"):
            total = total + F.octet_length(F.to_json(F.struct(c)))
    return total + 8 * len(df.columns)


def write_buckets(df: DataFrame, path: str, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Both passes: scatter ``df`` and write each bucket in Fisher-Yates order.

    Writes ``bucket, pos`` (gapless from 0 in its bucket), ``at`` (gapless from 0 in
    the whole sequence) and the record ``rec``.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    # Hashes skip nulls, so which columns are null is hashed as well.
    digest = F.xxhash64(*cols, *[c.isNull() for c in cols])
    records = df.select(F.struct(*cols).alias("rec"), digest.alias("d"))
    narrow = keep_table(df.select(digest.alias("d"), row_size(df).alias("size")), "shard-digests")
    total = narrow.agg(F.sum("size").alias("b")).first()["b"] or 0
    n_buckets = min(MAX_BUCKETS, max(1, -(-total // bucket_bytes)))
    # Digests only choose what is folded; equal records are told by all their columns.
    again = keep_table(narrow.groupBy("d").count().filter("count > 1").select("d"), "shard-again")
    folded = keep_table(records.join(again, "d", "left_semi").groupBy("rec", "d").agg(F.count(F.lit(1)).alias("n")), "shard-folded")
    blocks = (folded.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {STEP}"))))
              .repartition("d", "block"))
    rank = F.explode(F.sequence(F.col("block") * STEP + 1, F.least("n", (F.col("block") + 1) * STEP))).alias("rank")
    place = F.xxhash64(F.lit(seed), "d", "rank")
    bucket = F.pmod(place, F.lit(n_buckets)).cast("int")
    once = F.lit(0).cast("bigint").alias("rank")

    counted = (narrow.join(again, "d", "left_anti").select("d", once).union(blocks.select("d", rank))
               .groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    starts = keep_table(bucket_starts(counted), "shard-starts")
    scattered = (records.join(again, "d", "left_anti").select("rec", "d", once).union(blocks.select("rec", "d", rank))
                 .select(bucket.alias("bucket"), F.struct(place.alias("h"), "rec").alias("r"), F.lit(None).cast("bigint").alias("start")))
    kind = scattered.schema["r"].dataType
    both = scattered.union(starts.select("bucket", F.lit(None).cast(kind), "start"))
    per_task = -(-n_buckets // MAX_TASKS)
    task = F.expr(f"bucket div {per_task}").cast("int")
    # One shuffle; a task's buckets in order, since the generator of ``shuffle`` runs through a partition.
    mixed = (both.withColumn("task", task).repartitionById(-(-n_buckets // per_task), "task")
             .groupBy("task", "bucket").agg(F.collect_list("r").alias("rows"), F.max("start").alias("start"))
             .sortWithinPartitions("bucket")
             .select("bucket", "start", F.shuffle(F.sort_array("rows"), F.lit(seed)).alias("rows")))
    (mixed.select("bucket", "start", F.posexplode("rows").alias("pos", "r"))
     .select("bucket", "pos", (F.col("start") + F.col("pos")).alias("at"), F.col("r.rec").alias("rec"))
     .write.parquet(path))
    discard(narrow, again, folded, starts)


def bucket_starts(counted: DataFrame) -> DataFrame:
    """``bucket, start`` from ``bucket, n``: the offset of each bucket in the whole sequence.

    The running total goes in two levels of at most ``STEP`` buckets a window.
    """
    n = counted.withColumn("step", F.expr(f"bucket div {STEP}"))
    inner = Window.partitionBy("step").orderBy("bucket")
    steps = n.groupBy("step").agg(F.sum("n").alias("step_n"))
    before = steps.withColumn("step_start", F.sum("step_n").over(Window.orderBy("step")) - F.col("step_n"))
    return (n.withColumn("in_step", F.sum("n").over(inner) - F.col("n"))
            .join(before, "step").select("bucket", (F.col("in_step") + F.col("step_start")).alias("start")))


def read_shards(spark: SparkSession, path: str, n_shards: int = 16) -> DataFrame:
    """The written records with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0)."""
    buckets = spark.read.parquet(path)
    small, large = divmod(buckets.count(), n_shards)  # the first `large` shards hold small + 1 rows
    at, cut = F.col("at"), large * (small + 1)
    shard = F.when(at < cut, F.expr(f"at div {small + 1}")).otherwise(F.expr(f"{large} + (at - {cut}) div {max(small, 1)}"))
    slot = F.when(at < cut, at % (small + 1)).otherwise((at - cut) % max(small, 1))
    return buckets.select(F.col("rec"), shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))


def shards(df: DataFrame, n_shards: int = 16, seed: int = 7, path: str | None = None) -> DataFrame:
    path = path or scratch_path(df.sparkSession, "shards")
    write_buckets(df, path, seed)
    return read_shards(df.sparkSession, path, n_shards)


def query(spark, sf_dir) -> DataFrame:
    from tablefit.llm.common import table

    out = shards(table(spark, sf_dir, "documents"))
    text = text_or_empty("rec.text")
    return out.select(F.col("rec.doc_id").alias("doc_id"), record_size("rec.text").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
