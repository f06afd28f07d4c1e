"""Incremental landing of feed responses with Structured Streaming.

The feeds' own runs are full rebuilds (the targets are replaced, see
``courierlake.operators.sinks``); what arrives continuously is the raw
responses. These jobs pick up newly landed response files and apply the same
column expressions as the batch readers, exactly once per file:

* keyed documents: parse the body once into the VARIANT ``doc`` and append to
  the landed document table (the batch E2 plan reads that table);
* dated pages: gate, parse and explode into rows appended to a staging table.

State is only the file source's log of processed files, kept with the sink's
offsets below the shared checkpoint folder, so a restarted or relocated
driver resumes where it stopped. ``trigger(availableNow=True)`` processes
everything present and stops; a long-running job uses a processing-time
trigger instead.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courierlake.schemas import DATED_RESPONSE, DOCUMENT_RESPONSE
from courierlake.session import ensure_checkpoint_dir
from courierlake.sources.landed import parse_documents, read_dated_json


def _checkpoint(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/courierlake-streams/{name}"


def land_documents_stream(spark: SparkSession, inbox: str, landed: str, name: str = "documents",
                          available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Append every new response file under ``inbox`` to ``landed`` with the
    body parsed once into ``doc``."""
    reader = spark.readStream.schema(DOCUMENT_RESPONSE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parsed = parse_documents(reader.parquet(inbox))
    writer = parsed.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", _checkpoint(spark, name)).option("path", landed)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def land_dated_stream(spark: SparkSession, inbox: str, staging: str, item_schema: T.StructType,
                      name: str = "dated", keep: tuple[str, ...] = ("endpoint", "planned_date"),
                      available_now: bool = True) -> StreamingQuery:
    """Append the rows of every usable dated page under ``inbox`` to
    ``staging`` (partitioned by endpoint and planned date)."""
    raw = spark.readStream.schema(DATED_RESPONSE).parquet(inbox)
    rows = read_dated_json(raw, item_schema, keep=list(keep))
    writer = rows.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", _checkpoint(spark, name)).option("path", staging) \
        .partitionBy(*keep)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
