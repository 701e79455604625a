"""Helpers shared by the operators: tables, text normalisation, materialising."""

from __future__ import annotations

import os
import pathlib
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.session import scratch_path, shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per context: the functions that
    run in their Python workers import it."""
    sc = spark.sparkContext
    if getattr(sc, "_tablefit_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    at = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tablefit-code-")), "tablefit_code.zip")
    with zipfile.ZipFile(at, "w") as z:
        for f in root.rglob("*.py"):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(at)
    sc._tablefit_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage
    that survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``keep_table`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._kept_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query are deleted when it ends. Otherwise they stay until
    the driver happens to collect its garbage. For code whose every query is written at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def text_key(text_col: str | Column) -> Column:
    """With the ID, tells rows of a table apart that share an ID."""
    return F.xxhash64(text_or_empty(text_col).cast("binary"))


def free_name(name: str, columns: list[str]) -> str:
    """``name``, or what it takes to differ from all ``columns`` (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose (ID, text key) is in ``gone(id, key)``."""
    key, gone_id, gone_key = (free_name(n, docs.columns) for n in ("__key", "__id", "__gone"))
    gone = gone.select(F.col("id").alias(gone_id), F.col("key").alias(gone_key)).distinct()
    return (docs.withColumn(key, text_key(text_col))
            .join(gone, F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left_anti")
            .drop(key))


__all__ = ["LOWER", "UPPER", "discard", "drop_rows", "free_name", "keep_table", "lower_ascii", "scratch_path", "shared_dir", "ship", "shuffles_dropped", "table", "text_key", "text_or_empty"]
