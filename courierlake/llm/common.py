"""Helpers shared by the corpus operators: tables, staging, byte-level words."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from courierlake.session import ensure_checkpoint_dir, scratch_path, shuffles_dropped  # noqa: F401

# Upper-case A-Z folded, every other byte kept; used with bytes.translate.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# As FOLD, with every ASCII byte outside 0-9 and a-z turned into a blank: all
# bytes of code points above 0x7F are >= 0x80, so the split is exact on UTF-8.
ALNUM = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 128 else 32
              for b in FOLD)


# Of one Arrow batch to a Python worker.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's code to the Python workers, once for an application.

    The driver serves the archive to every executor, as with --py-files, so
    the workers need no installed copy. Batches to the workers are bounded by
    bytes in this session: rows carry whole texts, so a number of rows bounds
    nothing.
    """
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    stem = os.path.join(tempfile.mkdtemp(prefix="courierlake-code-"), "courierlake-code")
    sc.addPyFile(shutil.make_archive(stem, "zip", root, "courierlake"))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files that survive a lost executor.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def space_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes with A-Z folded.

    ``bytes.split()`` splits on exactly these six ASCII characters.
    """
    return data.translate(FOLD).split()


def alnum_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of folded UTF-8 bytes."""
    return data.translate(ALNUM).split()


def pii_key(spark: SparkSession) -> str:
    """The secret of the pseudonyms: ``spark.courierlake.pii.key``. The synthetic
    tables need no secret, so queries over them run without the setting."""
    return spark.conf.get("spark.courierlake.pii.key", None) or "key of the synthetic tables"
