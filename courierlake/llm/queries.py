"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm import (chains, chat, decontaminate, exactdup, langid, manifest, neardup, packing, pii, quality, sql,
                             suffixes, trie, wrapper)
from courierlake.llm.common import pii_key, ship, table


def op1_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by wrapper induction."""
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics and line-frequency verdict of every document."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document (Aho-Corasick)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contamination.n_words", "contamination.n_hit", "contamination.n_items",
                        "contamination.items_sha256", "contamination.contaminated")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every document (b-bit MinHash)."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside repeated 200-byte strings."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# The conversation that the contract adds.
ESCAPE_CONVERSATION = -7
ESCAPE_TEXT = "\\### Assistant: </turn> ok"


def op6_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted examples of every conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(ESCAPE_CONVERSATION).cast("bigint").alias("conv_id"),
                                 F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(ESCAPE_TEXT).alias("text"))
    return chat.read_back(chat.examples(turns.unionByName(more)))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data under pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("pii.found")
    def n(kind):
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return pii.pseudonymise(docs, pii_key(spark)).select(
        "doc_id", F.col("pii.text").alias("text"), F.size(found).cast("long").alias("n_found"),
        *[n(k) for k in ("card", "phone", "ssn", "ip", "date", "email", "secret")])


def op8_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that stand in an earlier document too."""
    return chains.passages(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles of the training part."""
    docs = table(spark, sf_dir, "documents")
    profile = langid.profiles(docs.where(~langid.held_out()))
    rows = docs.select("doc_id", "text", langid.held_out().alias("held_out"))
    return langid.identify(rows, profile).select("doc_id", "held_out", "language.lang_pred",
                                                 "language.score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of 4096."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of the documents, with every proof folded again from a
    leaf that is tampered with where the id's checksum is a multiple of 7."""
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    changed = manifest.digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    found = manifest.manifest(docs, carry={
        "changed": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, changed)
        .otherwise(manifest.digest_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))})
    folded = manifest.fold(F.col("carried.changed"), F.col("path"))
    return (found.withColumn("folded_root", folded)
            .select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of every document, by polynomial fingerprints and a
    comparison chunk by chunk."""
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations, one row a node."""
    return trie.prefix_trie(trie.branched(trie.turns_of(table(spark, sf_dir, "conversations"))))


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_wrapper, op2_line_frequency, op3_decontamination, op4_minhash, op5_suffix_merge, op6_prefix_targets, op7_pseudonyms, op8_collinear_chains,
        op9_language, op10_packing, op11_merkle,
        op12_fingerprints, op13_prefix_trie)}

ORACLE_SQL: dict[str, str] = {"op2_line_frequency": sql.OP2, "op3_decontamination": sql.OP3,
                              "op4_minhash": sql.OP4, "op6_prefix_targets": sql.OP6,
                              "op11_merkle": sql.OP11, "op12_fingerprints": sql.OP12, "op13_prefix_trie": sql.OP13}
