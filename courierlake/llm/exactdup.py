"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks that are hashed apart from each other; the hash of a
concatenation follows from the parts' hashes and lengths alone (shift the left
one by the length of the right one, add), so a huge document is never hashed in
one piece. Rows with equal fingerprints are then compared chunk by chunk: the
smallest and the largest chunk of every (fingerprint, chunk number) are equal
exactly if all chunks are, and both are combined in each task before the
shuffle, however large a group of copies is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import staged

CHUNK = 1 << 16                       # code points of a chunk
MODULUS = (1 << 31) - 1
# Four bases below the modulus, 124 bits together.
BASES = (1_290_817_203, 747_796_405, 1_831_565_813, 402_653_189)


def combine(left: tuple[int, int], right: tuple[int, int], base: int, modulus: int = MODULUS) -> tuple[int, int]:
    """(hash, bytes) of a concatenation from those of its parts."""
    return (left[0] * pow(base, right[1], modulus) + right[0]) % modulus, left[1] + right[1]


def _weights(base: int, n: int, modulus: int = MODULUS) -> np.ndarray:
    """base ** (n - 1), ..., base, 1 modulo ``modulus``, by doubling."""
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate((out * pow(base, len(out), modulus) % modulus, out))
    return out[len(out) - n:]


def hashes(chunks: list[bytes], bases: tuple[int, ...], modulus: int = MODULUS) -> np.ndarray:
    """Hash of every chunk under every base, one row a chunk. Bytes count as
    1 to 256, so leading zero bytes matter. Products stay below 2 ** 40: 2 ** 22
    of them add up exactly in 64 bits, and longer chunks go in pieces."""
    piece = 1 << 22
    longest = min(max(map(len, chunks), default=0), piece)
    out = np.zeros((len(chunks), len(bases)), np.int64)
    for k, base in enumerate(bases):
        weight = _weights(base, max(longest, 1), modulus)
        for i, chunk in enumerate(chunks):
            value = (0, 0)
            for at in range(0, len(chunk), piece):
                data = np.frombuffer(chunk, np.uint8, min(piece, len(chunk) - at), at).astype(np.int64) + 1
                value = combine(value, (int(data @ weight[len(weight) - len(data):]) % modulus, len(data)), base, modulus)
            out[i, k] = value[0]
    return out


def normalised(text: Column) -> Column:
    """Each ``[\\x20\\x09-\\x0D]+`` as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _chunked(docs: DataFrame, id_col: str, text_col: str, chunk: int, bases: tuple[int, ...], modulus: int) -> DataFrame:
    """(row, id, sha, k, chunk, size, h, shift): every row's chunks, hashed."""
    @F.pandas_udf("h array<long>, shift array<long>, size long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [x.encode() for x in batch]
            yield pd.DataFrame({"h": list(hashes(data, bases, modulus)),
                                "shift": [[pow(b, len(x), modulus) for b in bases] for x in data],
                                "size": [len(x) for x in data]})

    text = normalised(F.col(text_col))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    # (?s) lets "." stand for a line break, too; an empty text is one empty chunk.
    parts = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % chunk), F.lit(0))
    # The digest of the whole text is taken below the explode: a chunk's row carries no text.
    cut = (rows.select("row", "id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
                       F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(parts).alias("parts"))
           .select("row", "id", "sha", F.posexplode("parts").alias("k", "chunk")))
    return cut.withColumn("f", hashed("chunk")).select("row", "id", "sha", "k", "chunk", "f.*")


def _fingerprint(parts: Column, bases: tuple[int, ...], modulus: int) -> Column:
    """Chunk hashes (structs k, h, shift, size) combined in order."""
    start = F.transform(F.sequence(F.lit(1), F.lit(len(bases))), lambda _: F.lit(0).cast("bigint"))

    def step(own: Column, part: Column) -> Column:
        shifted = F.zip_with(own, part["shift"], lambda a, b: a * b % modulus)
        return F.zip_with(shifted, part["h"], lambda a, b: (a + b) % modulus)
    return F.aggregate(F.array_sort(parts), start, step)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
                     bases: tuple[int, ...] = BASES, modulus: int = MODULUS) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row for each row of
    ``docs``. Texts are equal when they are after ``normalised``; of equal
    texts the row with the smallest id stays (of repeated ids one, a null id
    only where the group has no other), and ``keep_id`` names it.

    Null and empty texts form one group, a text of white space alone is one
    blank. Other columns are ignored, whatever their names; an empty table gives
    no rows. Long texts go in chunks of ``chunk`` code points; a group of any
    size is one row a task and chunk in the comparison. Fewer bases or a smaller
    modulus only make the comparison do more: rows whose fingerprints agree and
    texts do not are told apart by the whole text.
    """
    chunks = staged(_chunked(docs, id_col, text_col, chunk, bases, modulus), "chunks")
    own = chunks.groupBy("row", "id", "sha").agg(
        F.collect_list(F.struct("k", "h", "shift", "size")).alias("parts"), F.sum("size").alias("size"))
    value = _fingerprint(F.col("parts"), bases, modulus)
    own = staged(own.select("row", "id", "sha", F.concat_ws(":", F.col("size").cast("string"), F.transform(
        value, lambda h: h.cast("string"))).alias("print")), "prints")

    shared = own.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    # Rows that have no like need no comparison; their chunks are left out first.
    alike = own.select("row", "print").join(shared, "print", "left_semi")
    unequal = (chunks.select("row", "k", "chunk").join(alike, "row").groupBy("print", "k")
               .agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
               .where("low <> high").select("print").distinct())
    # Fingerprints that unlike texts share: their rows go by the text itself.
    unequal = staged(unequal, "collisions")
    if unequal.isEmpty():
        classed = own.withColumn("rest", F.lit(-1).cast("bigint"))
    else:
        mixed = chunks.join(own.select("row", "print").join(unequal, "print", "left_semi"), "row")
        whole = mixed.groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct("k", "chunk"))), lambda c: c["chunk"]), "").alias("text"))
        first = whole.groupBy("text").agg(F.min("row").alias("rest"))
        named = whole.join(first, "text").select("row", "rest")
        classed = own.join(named, "row", "left").withColumn("rest", F.coalesce("rest", F.lit(-1)))

    # One row a group, then back to its rows; rows without a like need no partner.
    groups = classed.groupBy("print", "rest").agg(
        F.count("*").alias("group_size"), F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    found = classed.join(groups.where("group_size > 1"), ["print", "rest"], "left")
    alone = F.col("group_size").isNull()
    return found.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"), F.col("sha").alias("text_sha256"))
