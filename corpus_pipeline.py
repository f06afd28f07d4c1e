"""Corpus preparation: five stages over ``documents``, each one whole.

Every stage gets the documents that the stage before kept, as written and read
back, and returns the columns of ``documents``; the last returns the pieces of
the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm import decontaminate, langid, neardup, packing, pii
from courierlake.llm.common import pii_key, ship, staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# DuckDB SQL cannot express the trained profiles, the tokenizer or the packing;
# tests/llm/test_pipeline.py holds the stages against plain Python versions.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. Documents without a language (null text, no letter) go; a
    missing ``lang`` takes the predicted one."""
    ship(spark)
    profile = langid.profiles(docs.where(~langid.held_out()))
    found = langid.identify(docs.select(*COLUMNS), profile)
    return (found.where(F.col("language.lang_pred") != langid.UNKNOWN)
            .withColumn("lang", F.coalesce("lang", "language.lang_pred")).select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4. The document with the smallest id of each group stays.

    Of rows that are equal in every column one stays. Unlike rows that share an
    id, and rows without one, are documents of their own: they are known by a
    hash of all their columns, and one of those in a group stays."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    own = F.xxhash64(*COLUMNS)
    often = staged(docs.select("doc_id", own.alias("h")).groupBy("doc_id").agg(
        F.count("*").alias("n"), (F.min("h") != F.max("h")).alias("unlike")).where("n > 1 OR doc_id IS NULL")
        .select(F.col("doc_id").alias("often_id"), (F.col("unlike") | F.col("doc_id").isNull()).alias("unlike")), "repeated-ids")
    some = not often.isEmpty()
    if some:
        docs = docs.join(often, F.col("doc_id").eqNullSafe(F.col("often_id")), "left").withColumn(
            "row_key", F.when(F.col("unlike"), own).otherwise(F.col("doc_id"))).select(*COLUMNS, "row_key")
    else:
        docs = docs.withColumn("row_key", F.col("doc_id"))
    gone = neardup.near_duplicates(docs, id_col="row_key").where(~F.col("kept")).select(
        F.col("doc_id").alias("row_key")).distinct()
    left = docs.join(gone, "row_key", "left_anti").select(*COLUMNS)
    return left.dropDuplicates() if some else left


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3. Contaminated documents go."""
    ship(spark)
    found = decontaminate.contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contamination.contaminated")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. Every document stays, with pseudonyms in its text and
    ``n_chars`` counted anew."""
    found = pii.pseudonymise(docs.select(*COLUMNS), pii_key(spark)).withColumn("text", F.col("pii.text"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10. One row per piece of the packed sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
