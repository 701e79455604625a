"""Session construction and the shared folder used for checkpoints and tables."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers are reused, so an Arrow UDF does not pay a fork per task.
    "spark.python.worker.reuse": "true",
    # Checkpoint files of frames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tablefit", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults (UI off, AQE on)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir). Only a local session with nothing configured gets a fresh folder;
    on a cluster an unset value is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="tablefit-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Send the package's code to the executors, once per context: functions that
    run in their Python workers are looked up in it."""
    sc = spark.sparkContext
    if getattr(sc, "_tablefit_code_sent", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    at = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tablefit-package-")), "tablefit_package.zip")
    with zipfile.ZipFile(at, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(at)
    sc._tablefit_code_sent = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tablefit/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table of this library's own that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df, min_partitions: int | None = None):
    """Round-robin repartition only when ``df`` has fewer partitions than the
    cluster's parallelism (a file with one row group scans as one task).

    For inputs that an operator reads many times (iterative fits); at scale a
    scan already has more partitions than cores and nothing is shuffled.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    The rows are persisted first so writing the checkpoint does not compute
    them a second time; the persisted copy is released afterwards.
    """
    from pyspark import StorageLevel

    shared_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = kept.checkpoint(eager=True)
    kept.unpersist()
    return out


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def fit_partitions(df, n_rows: int, row_bytes: int = 64):
    """Partitions sized to the data once its row count is known.

    ``max(cores, rows * row_bytes / 128 MB)``: an input split far finer than
    that (e.g. 200 shuffle partitions over a small table) is merged with a
    narrow ``coalesce``; one split coarser than the cores is spread.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    target = max(cores, -(-int(n_rows) * int(row_bytes) // TARGET_PARTITION_BYTES))
    current = df.rdd.getNumPartitions()
    if current > 2 * target:
        return df.coalesce(target)
    if current < cores:
        return df.repartition(target)
    return df
