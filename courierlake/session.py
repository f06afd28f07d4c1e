"""Session defaults and the shared scratch location.

Everything the library writes as an intermediate (landed fixture files, staged
tables) goes below the folder the cluster names in ``spark.checkpoint.dir``.
That folder is shared storage on a cluster, so a lost executor never takes a
written intermediate with it. Only when the setting is absent (local tests) do
we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins from
# measured shuffle sizes (runtime broadcast, skew split, partition coalescing);
# ANSI stays on, so every parse in the package uses a try_* form.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Small inputs are split by bytes-per-core instead of being packed into a
    # few 4 MB splits; at scale splits are capped by maxPartitionBytes anyway.
    "spark.sql.files.openCostInBytes": "512k",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a
    # larger whole-stage method would run interpreted. At 8000 Spark falls back
    # to per-operator codegen for such a subtree instead (Spark's own advice).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "courierlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="courierlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/courierlake/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


@contextmanager
def set_for_a_while(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these ``settings``."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, Spark removes the shuffle files of each write as soon as it ends,
    so that steps staged one after the other do not fill the disks together."""
    return set_for_a_while(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
