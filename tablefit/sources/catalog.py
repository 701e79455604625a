"""Catalog tables as snapshots.

A catalog layer is an external table. An overwrite writes its rows to a new folder
``_v-<name>`` below ``<database location>/<table>__layer`` and then points the table
there (``ALTER TABLE ... SET LOCATION``, one change of the catalog entry). A job that
fails or is killed leaves the old rows in place, a query that has begun goes on with
the folder it resolved, and a table can be rewritten from itself. Of two writers at
once the one that points last wins; both snapshots are whole.

Where the catalog entry itself has to change (other columns or types, another
format, partitions, a managed table made elsewhere) the entry is dropped and made anew
over the new folder: rows are never lost, but readers in between find no table. The
rows of a managed table are moved under the name ``<table>__managed`` first and go
once the new entry stands; a write that was cut off in between brings them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted(*names: str) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def layer_root(spark: SparkSession, table: str) -> str:
    """The folder that holds the snapshots of a catalog layer."""
    db, _, name = table.rpartition(".")
    at = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{at.rstrip('/')}/{name}__layer"


def entry(spark: SparkSession, table: str) -> dict | None:
    """``location``, ``type``, ``provider`` and ``partitioned`` of a table's catalog entry."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r["col_name"] for r in rows]
    detail = {r["col_name"]: r["data_type"] for r in rows[names.index("# Detailed Table Information") + 1:]}
    return {"location": detail.get("Location"), "type": detail.get("Type"), "provider": (detail.get("Provider") or "").lower(),
            "partitioned": "# Partition Information" in names}


def _types(schema) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _make(spark: SparkSession, table: str, df: DataFrame, fmt: str, at: str, partition_by: list[str]) -> None:
    # Columns of partitions stand last, as the reader of the folder has them.
    fields = sorted(df.schema.fields, key=lambda f: f.name in partition_by)
    cols = StructType(fields).toDDL()
    parts = f" PARTITIONED BY ({_quoted(*partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({cols}) USING {fmt}{parts} LOCATION {_literal(at)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def write_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                comment: str | None = None) -> str:
    """Overwrite a catalog layer; returns the new snapshot's folder."""
    spark, parts = df.sparkSession, list(partition_by or [])
    aside = f"{table}__managed"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(aside):
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    at = f"{layer_root(spark, table)}/_v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(at)
    have = entry(spark, table)
    if have is None:
        _make(spark, table, df, fmt, at, parts)
    elif (have["type"] == "EXTERNAL" and have["provider"] == fmt and not have["partitioned"] and not parts
          and _types(spark.table(table).schema) == _types(df.schema)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(at)}")
        spark.catalog.refreshTable(table)
    elif have["type"] == "MANAGED":
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        _make(spark, table, df, fmt, at, parts)
        spark.sql(f"DROP TABLE {aside}")
    else:
        spark.sql(f"DROP TABLE {table}")
        _make(spark, table, df, fmt, at, parts)
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_literal(comment)}")
    return at


def release_table(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Delete the snapshots that the table does not point to, but for the ``keep - 1``
    latest of them; only when no job reads or writes it. Returns the folders that stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(layer_root(spark, table))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    have = entry(spark, table)
    if have is None:
        raise ValueError(f"no table {table}")
    found = [f for f in (fs.listStatus(root) if fs.exists(root) else []) if f.getPath().getName().startswith("_v-")]
    current = path(have["location"]).getName()
    others = sorted((f for f in found if f.getPath().getName() != current), key=lambda f: -f.getModificationTime())
    for f in others[max(0, keep - 1):]:
        fs.delete(f.getPath(), True)
    return [current, *[f.getPath().getName() for f in others[:max(0, keep - 1)]]]


__all__ = ["entry", "layer_root", "release_table", "write_table"]
