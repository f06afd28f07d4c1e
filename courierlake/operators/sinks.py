"""Target-table writes: full replacement, append, fail-if-exists, and the
guarded load that keeps the old table when nothing arrived.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from courierlake.operators.shape import q
from courierlake.operators.snapshots import read_snapshot, replace_folder

# The feeds' write modes and Spark's names for them.
MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists",
         "overwrite": "overwrite", "errorifexists": "errorifexists"}


def _quoted(name: str) -> str:
    return ".".join(q(p) for p in name.replace("`", "").split("."))


def _location(spark: SparkSession, name: str) -> str | None:
    """Folder of a catalog table (None for tables without one)."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()}
    return rows.get("Location")


def _database_folder(spark: SparkSession, name: str) -> str:
    database = name.replace("`", "").rsplit(".", 1)[0] if "." in name else spark.catalog.currentDatabase()
    rows = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {_quoted(database)}").collect()}
    return rows["Location"].rstrip("/")


def stage_table(df: DataFrame, name: str, fmt: str, options: dict[str, str], partition_by: list[str] | None) -> str:
    """Write the new rows of table ``name`` to a folder of their own."""
    folder = f"{_database_folder(df.sparkSession, name)}/{name.replace('`', '').rsplit('.', 1)[-1]}-{uuid.uuid4().hex}"
    out = df.write.format(fmt).mode("errorifexists").options(**options)
    (out.partitionBy(*partition_by) if partition_by else out).save(folder)
    return folder


def point_table(spark: SparkSession, name: str, folder: str, df: DataFrame, fmt: str,
                partition_by: list[str] | None) -> None:
    """Make catalog table ``name`` the rows in ``folder``.

    A table with the same columns is pointed at the folder: one catalog
    operation. Otherwise the new table gets a name of its own, the old one is
    set aside, and the new one takes its name; if that fails the old one takes
    it back."""
    table = _quoted(name)
    partitioned = f" PARTITIONED BY ({', '.join(map(q, partition_by))})" if partition_by else ""
    columns = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    create = "CREATE TABLE {} (" + columns + f") USING {fmt}" + partitioned + f" LOCATION '{folder}'"
    if not spark.catalog.tableExists(name.replace("`", "")):
        spark.sql(create.format(table))
        if partition_by:
            spark.catalog.recoverPartitions(name)
        return
    old = spark.table(name).schema
    same = [(f.name, f.dataType) for f in old.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    if same and not partition_by and spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(
            "col_name = 'Provider'").first()["data_type"].lower() == fmt:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
        return
    tag = uuid.uuid4().hex[:12]
    fresh, aside = f"{name}__new_{tag}", f"{name}__old_{tag}"
    spark.sql(create.format(_quoted(fresh)))
    if partition_by:
        spark.catalog.recoverPartitions(fresh)
    spark.sql(f"ALTER TABLE {table} RENAME TO {_quoted(aside)}")
    try:
        spark.sql(f"ALTER TABLE {_quoted(fresh)} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {_quoted(aside)} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {_quoted(aside)}")


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_target(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """The rows of a target that :func:`replace_table` wrote."""
    return read_snapshot(spark, target, fmt) if "/" in target else spark.table(target)


def replace_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "replace",
                  options: dict[str, str] | None = None, skip_if_empty: bool = False,
                  partition_by: list[str] | None = None) -> bool:
    """Write ``df`` to ``target`` (a path if it contains ``/``, else a table).

    ``mode``: ``replace`` | ``append`` | ``fail``. With ``skip_if_empty`` an
    empty frame leaves the target untouched (a bounded ``isEmpty`` probe).
    The new rows are written in full beside the old ones before anything
    changes, so a job that fails or reads what it replaces leaves the old rows
    readable. A path is then replaced by one commit (see
    :mod:`courierlake.operators.snapshots`; the version before stays for
    readers that have begun), a table by pointing it at the new folder; a table
    that changes its columns, or is partitioned, changes its name for a moment.
    Read targets with :func:`read_target`. Returns True when something was
    written.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if skip_if_empty and df.isEmpty():
        return False
    how, options, spark = MODES[mode], dict(options or {}), df.sparkSession
    if "/" in target:
        replace_folder(df, target, fmt, how, options, partition_by)
    elif how == "overwrite":
        old = _location(spark, target) if spark.catalog.tableExists(target) else None
        folder = stage_table(df, target, fmt, options, partition_by)
        point_table(spark, target, folder, df, fmt, partition_by)
        if old and old.rstrip("/") != folder:
            drop_folder(spark, old)
    else:
        out = df.write.format(fmt).mode(how).options(**options)
        (out.partitionBy(*partition_by) if partition_by else out).saveAsTable(target)
    return True
