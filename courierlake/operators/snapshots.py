"""Folders that are replaced in one step.

A target folder holds finished snapshots and a log of numbered commits::

    target/_snapshots/<id>/...      one complete write each
    target/_commits/000000000007    the snapshots that make up version 7

A version exists once its commit file does, and a commit file appears whole or
not at all: it is written under a hidden name and renamed to a number that does
not exist yet (one file, also on stores without atomic folder renames). Readers
take the highest number, so they see the old rows or the new ones, never a mix
and never nothing, wherever a writer stops. A target without a log is a plain
folder; the first commit turns it into its version 1.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from courierlake.operators.shape import union_outer

SNAPSHOTS, COMMITS = "_snapshots", "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed the next version first."""


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = _fs(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, target: str) -> list[int]:
    """Committed versions of a target, rising."""
    return [int(n) for n in _names(spark, f"{target}/{COMMITS}") if n.isdigit()]


def _commit_of(spark: SparkSession, target: str, version: int) -> dict:
    return json.loads(_read_text(spark, f"{target}/{COMMITS}/{version:012d}"))


def current(spark: SparkSession, target: str, version: int | None = None) -> dict | None:
    """``{"version", "format", "folders"}`` of the newest (or given) version;
    None for a target that does not exist."""
    target = target.rstrip("/")
    known = versions(spark, target)
    if known:
        number = known[-1] if version is None else version
        return {"version": number, **_commit_of(spark, target, number)}
    fs, hadoop = _fs(spark, target)
    plain = fs.exists(hadoop) and any(not n.startswith(("_", ".")) for n in _names(spark, target))
    return {"version": 0, "format": None, "folders": [target]} if plain else None


def read_snapshot(spark: SparkSession, target: str, fmt: str = "parquet", version: int | None = None,
                  **options: str) -> DataFrame:
    """The rows of a target's newest version. Folders of several appends are
    combined by name."""
    found = current(spark, target, version)
    if found is None:
        raise FileNotFoundError(f"nothing was written to {target}")
    return union_outer([spark.read.format(found["format"] or fmt).options(**options).load(f) for f in found["folders"]])


def write_snapshot(df: DataFrame, target: str, fmt: str = "parquet", options: dict[str, str] | None = None,
                   partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a snapshot that no version names yet; its folder."""
    folder = f"{target.rstrip('/')}/{SNAPSHOTS}/{uuid.uuid4().hex}"
    out = df.write.format(fmt).mode("errorifexists").options(**(options or {}))
    (out.partitionBy(*partition_by) if partition_by else out).save(folder)
    return folder


def publish(spark: SparkSession, target: str, version: int, fmt: str, folders: list[str]) -> None:
    """Commit ``version``: the single step that makes it what readers see."""
    log = f"{target.rstrip('/')}/{COMMITS}"
    fs, hidden = _fs(spark, f"{log}/.{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(json.dumps({"format": fmt, "folders": folders}).encode()))
    finally:
        stream.close()
    _, number = _fs(spark, f"{log}/{version:012d}")
    # rename() of a file to a name that exists fails on HDFS; local stores and
    # some object stores would overwrite, hence the test before it.
    if fs.exists(number) or not fs.rename(hidden, number):
        fs.delete(hidden, False)
        raise CommitConflict(f"version {version} of {target} was committed by another writer")


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete the commits before the last ``keep`` and every snapshot that none
    of the rest names; the deleted folders. Readers of a deleted version fail,
    so ``keep`` must cover the longest read; unfinished writes of a running
    writer count as unnamed, so this belongs to the writer."""
    target = target.rstrip("/")
    known = versions(spark, target)
    if not known:
        return []
    named = {f for v in known[-keep:] for f in _commit_of(spark, target, v)["folders"]}
    gone = []
    for v in known[:-keep]:
        fs, path = _fs(spark, f"{target}/{COMMITS}/{v:012d}")
        fs.delete(path, False)
    for name in _names(spark, f"{target}/{SNAPSHOTS}"):
        folder = f"{target}/{SNAPSHOTS}/{name}"
        if folder not in named:
            fs, path = _fs(spark, folder)
            fs.delete(path, True)
            gone.append(folder)
    if target not in named:  # files of a plain folder from before the log
        for name in _names(spark, target):
            if not name.startswith(("_", ".")):
                fs, path = _fs(spark, f"{target}/{name}")
                fs.delete(path, True)
                gone.append(f"{target}/{name}")
    return gone


def replace_folder(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                   options: dict[str, str] | None = None, partition_by: list[str] | None = None,
                   keep: int = 2) -> int:
    """Make ``df`` (``overwrite``) or the old rows and ``df`` (``append``) the
    next version of ``target``; its number. ``errorifexists`` wants no version.
    The last ``keep`` versions stay readable."""
    spark, target = df.sparkSession, target.rstrip("/")
    old = current(spark, target)
    if mode == "errorifexists" and old is not None:
        raise FileExistsError(f"{target} exists")
    folder = write_snapshot(df, target, fmt, options, partition_by)
    version = (old["version"] if old else 0) + 1
    kept = old["folders"] if old and mode == "append" else []
    publish(spark, target, version, fmt, [*kept, folder])
    vacuum(spark, target, keep)
    return version
