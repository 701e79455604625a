"""Sources, sinks and the bronze -> silver -> gold layers.

A layer is a pure function of its upstream DataFrame; a write is an overwrite
of a parquet path or a catalog table: a new snapshot in both cases.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.operators import checks
from tablefit.sources.catalog import release_table, write_table
from tablefit.sources.commits import CommitLog
from tablefit.spec import FeatureSpec

# A per-file or per-partition offset table is broadcast only under this many rows.
OFFSET_BROADCAST_ROWS = 1_000_000


# --------------------------------------------------------------------------- S1, S7
def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None,
               fmt: str = "parquet", **options) -> DataFrame:
    """Scan a table by catalog name or a file path (parquet, csv, json, orc)."""
    if "/" not in source and "." in source and fmt == "parquet" and not options:
        return spark.table(source)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv",):
        reader = reader.option("header", "true").option("inferSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source)


# --------------------------------------------------------------------------- S2
def normalise_columns(df: DataFrame) -> DataFrame:
    """Replace spaces in column names by underscores (no job, one projection)."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


# --------------------------------------------------------------------------- S4
def attach_target(df: DataFrame, target: str, expr: Column | str) -> DataFrame:
    """Attach (or rename to) the canonical target column."""
    if isinstance(expr, str):
        return df.withColumnRenamed(expr, target) if expr != target else df
    return df.withColumn(target, expr.cast("double"))


# --------------------------------------------------------------------------- S3
def sequential_id(df: DataFrame, id_col: str, order_by: list | None = None) -> DataFrame:
    """Attach an ID 1..n.

    ``order_by=None`` numbers rows in source order (file, then row inside the
    file) from the scan's ``_metadata``: one count per file, no sort and no
    shuffle of the data. With ``order_by`` the rows are range-partitioned and
    sorted by those keys (scan position as the last tie-break, so a hot key is
    split), materialised once (reliable checkpoint, so a lost executor cannot
    renumber them), and numbered by per-partition offsets. Neither path puts
    the rows into one partition.
    """
    spark = df.sparkSession
    if order_by is None:
        meta = df.select("*", F.col("_metadata.file_path").alias("_tf_file"),
                         F.col("_metadata.row_index").alias("_tf_row"))
        per_file = meta.groupBy("_tf_file").agg(F.count(F.lit(1)).alias("_tf_n"))
        offsets = _offsets(per_file, "_tf_file", "_tf_n")
        joined = meta.join(offsets, "_tf_file")
        out = joined.withColumn(id_col, (F.col("_tf_off") + F.col("_tf_row") + 1).cast("bigint"))
        return out.drop("_tf_file", "_tf_row", "_tf_off")

    from tablefit.session import fit_partitions, materialize

    # The scan position breaks ties last: identical keys (up to whole copies of
    # a row) then spread over several range partitions instead of one task.
    ordered = materialize(df.withColumn("_tf_tie", F.monotonically_increasing_id())
                          .orderBy(*order_by, "_tf_tie").drop("_tf_tie")
                          .withColumn("_tf_pid", F.spark_partition_id())
                          .withColumn("_tf_mid", F.monotonically_increasing_id()))
    per_part = ordered.groupBy("_tf_pid").agg(F.count(F.lit(1)).alias("_tf_n"))
    offsets, n_rows = _offsets(per_part, "_tf_pid", "_tf_n", with_total=True)
    local_idx = F.col("_tf_mid") - F.shiftleft(F.col("_tf_pid").cast("bigint"), 33)
    out = (ordered.join(offsets, "_tf_pid")
           .withColumn(id_col, (F.col("_tf_off") + local_idx + 1).cast("bigint")))
    # The IDs are fixed by the materialised columns, so merging partitions
    # afterwards (a narrow coalesce) cannot change them.
    return fit_partitions(out.drop("_tf_pid", "_tf_mid", "_tf_off"), n_rows, 8 * len(df.columns) + 8)


def _offsets(counts: DataFrame, key: str, n: str, with_total: bool = False):
    """Exclusive running total of ``n`` in ``key`` order.

    ``counts`` has one row per file or per partition, bounded by the layout and
    not by the data, so it is collected once and returned as a small frame that
    is broadcast under ``OFFSET_BROADCAST_ROWS`` rows (shuffle join above).
    """
    rows = sorted((r[0], r[1]) for r in counts.collect())
    acc, out = 0, []
    for k, c in rows:
        out.append((k, acc))
        acc += c
    key_type = counts.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("_tf_off", T.LongType())])
    small = counts.sparkSession.createDataFrame(out, schema)
    small = F.broadcast(small) if len(out) <= OFFSET_BROADCAST_ROWS else small
    return (small, acc) if with_total else small


# --------------------------------------------------------------------------- S5, S6, S8
# A layer at a path is a folder of snapshots: data folders ``_v-<name>`` and a
# commit log ``_snapshots`` whose last entry names the current one. An overwrite
# writes a new folder and then commits its name, so a job that fails or is killed
# leaves the old rows in place, and a layer can be rewritten from itself. A layer
# that others read by its bare path has no snapshots: its new rows are written
# beside it and change places with the old ones by two renames.

def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _snapshots(spark: SparkSession, target: str) -> CommitLog:
    return CommitLog(spark, f"{target.rstrip('/')}/_snapshots")


def _beside(target: str, kind: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}-{name}"


def _swap_in(spark: SparkSession, new: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    at, old = path(target), path(_beside(target, "old"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at):
        fs.delete(old, True)
        fs.rename(at, old)
    if not fs.rename(path(new), at):
        raise RuntimeError(f"{new} could not take the place of {target}; its old rows are in {old.toString()}")
    fs.delete(old, True)


def write_layer(df: DataFrame, target: str, comment: str | None = None, fmt: str = "parquet",
                partition_by: list[str] | None = None, snapshots: bool = True) -> str:
    """Overwrite a layer: a path (``/``, ``:`` in it; a new snapshot, readers of the
    old one go on undisturbed) or a catalog table name (``catalog``: snapshots too).
    With ``snapshots=False`` a path's rows lie in the folder itself, for readers that
    know no layers."""
    if _is_path(target):
        name = f"_v-{uuid.uuid4().hex}"
        at = f"{target.rstrip('/')}/{name}" if snapshots else f"{_beside(target, 'new')}-{uuid.uuid4().hex}"
        writer = df.write.mode("errorifexists").format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(at)
        if snapshots:
            _snapshots(df.sparkSession, target).commit(lambda seen: {"data": name, "format": fmt})
        else:
            _swap_in(df.sparkSession, at, target)
        return target
    write_table(df, target, fmt, partition_by, comment)
    return target


def layer_path(spark: SparkSession, target: str, snapshot: int | None = None) -> str:
    """The folder that holds a layer's rows: of its last snapshot, or of a given one
    that is still kept. A folder without snapshots is its own (or, where a swap was
    cut off between its renames, the one that held the old rows)."""
    log = _snapshots(spark, target)
    numbers = log.numbers()
    if not numbers and snapshot is None:
        path = spark._jvm.org.apache.hadoop.fs.Path
        old = path(_beside(target, "old"))
        fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
        return target if fs.exists(path(target)) or not fs.exists(old) else old.toString()
    if snapshot is not None and snapshot not in numbers:
        raise ValueError(f"{target} has no snapshot {snapshot}; kept: {numbers}")
    return f"{target.rstrip('/')}/{log.read(numbers[-1] if snapshot is None else snapshot)['data']}"


def read_layer(spark: SparkSession, target: str, fmt: str = "parquet", snapshot: int | None = None) -> DataFrame:
    """Read an upstream layer by path or table name. The snapshot is looked up once:
    the rows stay the same whatever is written meanwhile."""
    if _is_path(target):
        return spark.read.format(fmt).load(layer_path(spark, target, snapshot))
    return spark.table(target)


def release_layer(spark: SparkSession, target: str, keep: int = 1) -> list:
    """Delete all but the last ``keep`` snapshots (at least one stays) and data folders
    of writes that failed; only when no job reads or writes the layer. Returns what is kept
    (numbers; folder names of a catalog table)."""
    if not _is_path(target):
        return release_table(spark, target, keep)
    log = _snapshots(spark, target)
    numbers = log.numbers()
    kept = numbers[-max(1, keep):]
    named = {log.read(n)["data"] for n in kept}
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    for n in numbers[:-max(1, keep)]:
        fs.delete(path(log.file(n)), False)
    if numbers:
        for f in fs.listStatus(path(target)):
            name = f.getPath().getName()
            if name.startswith("_v-") and name not in named:
                fs.delete(f.getPath(), True)
    return kept


# --------------------------------------------------------------------------- layers
def bronze(raw: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Raw rows with names normalised; checked for the expected columns (Q2)."""
    df = normalise_columns(raw)
    checks.validate_bronze(df, spec)
    return df


def silver_dropna(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.dropna(how="any")


def silver(bronze_df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Bronze without incomplete rows; checked for nulls (Q3)."""
    df = silver_dropna(bronze_df)
    checks.validate_silver(df, spec)
    return df


def gold_select(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Features, then target, then ID, in that order."""
    return df.select(*spec.gold_columns)


def gold(silver_df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Check first (Q4), then project."""
    checks.validate_gold(silver_df, spec)
    return gold_select(silver_df, spec)
