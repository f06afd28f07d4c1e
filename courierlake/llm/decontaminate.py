"""Benchmark decontamination: one Aho-Corasick automaton over test windows.

Every run of 13 consecutive words of a benchmark item (the whole item when it
is shorter) is one pattern. The automaton is built once on the driver from the
benchmark, broadcast, and each document is scanned once; a hit is mapped back
to word positions and to character offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import alnum_words

WINDOW_WORDS = 13
# Patterns of one automaton: about 32 bytes of trie for each pattern byte at
# worst. A larger benchmark is scanned in several blocks of items.
MAX_BLOCK_BYTES = 4 << 20

RESULT = ("n_words long, n_hit long, hits array<struct<first:int,last:int,item:string>>,"
          "spans array<struct<start:int,end:int>>")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def item_windows(text: bytes, window: int = WINDOW_WORDS) -> list[str]:
    """The distinct patterns of an item, as blank-framed Latin-1 views of UTF-8."""
    words = alnum_words(text)
    n = max(1, len(words) - window + 1) if words else 0
    return list(dict.fromkeys(" " + b" ".join(words[i:i + window]).decode("latin-1") + " "
                              for i in range(n)))


def _automaton(items: list[tuple[str, bytes]], window: int) -> ahocorasick.Automaton:
    owners: dict[str, list[str]] = {}
    for item, text in items:
        for pattern in item_windows(text, window):
            owners.setdefault(pattern, []).append(item)
    auto = ahocorasick.Automaton()
    for pattern, own in owners.items():
        auto.add_word(pattern, (pattern.count(" ") - 1, tuple(sorted(set(own)))))
    if owners:
        auto.make_automaton()
    return auto


def _scan(data: bytes, auto: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int, str]]]:
    """Word count and (first word, last word, item) of every occurrence."""
    words = alnum_words(data)
    if not words or not len(auto):
        return len(words), []
    found = list(auto.iter(" " + b" ".join(words).decode("latin-1") + " "))
    if not found:
        return len(words), []
    ends = np.cumsum([len(w) + 1 for w in words])  # offset of the blank after each word
    last = np.searchsorted(ends, [e for e, _ in found])
    return len(words), [(int(j) - n + 1, int(j), item)
                        for j, (_, (n, own)) in zip(last, found) for item in own]


def hit_words(hits: list[tuple[int, int, str]], n_words: int) -> np.ndarray:
    """Mask of the words inside any occurrence."""
    edge = np.zeros(n_words + 1, np.int64)
    for first, last, _ in hits:
        edge[first] += 1
        edge[last + 1] -= 1
    return np.cumsum(edge)[:-1] > 0


def _spans(data: bytes, mask: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of the runs of hit words in the original text."""
    at = [m.span() for m in _WORD.finditer(data)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    chars = lambda b: len(data[:b].decode("utf-8", "replace"))
    return [(chars(at[a][0]), chars(at[b - 1][1])) for a, b in edges.reshape(-1, 2)]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of bounded bytes (a benchmark is a
    curated table; each block's automaton is broadcast on its own)."""
    rows = (benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(item_col).cast("string"), F.col(text_col).cast("binary")))
    blocks, size = [[]], 0
    for item, text in rows.toLocalIterator():
        # A window repeats each word up to 13 times.
        size += len(text) * WINDOW_WORDS
        if blocks[-1] and size > MAX_BLOCK_BYTES * WINDOW_WORDS:
            blocks.append([])
            size = len(text) * WINDOW_WORDS
        blocks[-1].append((item, bytes(text)))
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", bench_text_col: str = "text",
                  window: int = WINDOW_WORDS, out: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, n_items,
    items_sha256, contaminated, items, spans (character ranges in the original).

    One row out for each row in, other columns untouched (an existing ``out``
    is replaced). Null or empty text: no words, nothing hit, not contaminated.
    Items without an id or without words have no windows. Repeated items and
    repeated rows count as they stand. An empty benchmark hits nothing.
    Contaminated: a hit and 20 * n_hit >= n_words.
    """
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_col, bench_text_col)
    shared = [spark.sparkContext.broadcast(items) for items in blocks]

    def scan_with(items):
        @F.pandas_udf(RESULT)
        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            auto = _automaton(items.value, window)
            for batch in batches:
                out_rows = []
                for data in batch:
                    data = b"" if data is None else data
                    n, hits = _scan(data, auto)
                    mask = hit_words(hits, n) if hits else None
                    out_rows.append((n, 0 if mask is None else int(mask.sum()),
                                     [{"first": a, "last": b, "item": i} for a, b, i in hits],
                                     [] if mask is None else [{"start": a, "end": b}
                                                              for a, b in _spans(data, mask)]))
                yield pd.DataFrame(out_rows, columns=["n_words", "n_hit", "hits", "spans"])
        return scan

    found = docs.withColumn(out, scan_with(shared[0])(F.col(text_col).cast("binary")))
    if len(shared) > 1:
        found = _more_blocks(found, [scan_with(b) for b in shared[1:]], text_col, out)
    c = F.col(out)
    items = F.array_sort(F.array_distinct(c["hits"]["item"]))
    return found.withColumn(out, F.struct(
        c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((c["n_hit"] > 0) & (20 * c["n_hit"] >= c["n_words"])).alias("contaminated"),
        items.alias("items"), c["spans"].alias("spans")))


def _more_blocks(found: DataFrame, scans: list, text_col: str, out: str) -> DataFrame:
    """Add the hits of further blocks of a large benchmark, then recount."""
    @F.pandas_udf(RESULT)
    def recount(data: pd.Series, n_words: pd.Series, hits: pd.Series) -> pd.DataFrame:
        rows = []
        for text, n, own in zip(data, n_words, hits):
            mask = hit_words([(h["first"], h["last"], h["item"]) for h in own], int(n))
            rows.append((n, int(mask.sum()), list(own),
                         [{"start": a, "end": b} for a, b in _spans(text, mask)] if mask.any() else []))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "hits", "spans"])

    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    hits = F.concat(F.col(out)["hits"], *[s(data)["hits"] for s in scans])
    return found.withColumn(out, recount(data, F.col(out)["n_words"], hits))


def empty_items_sha256() -> str:
    """items_sha256 of a document without items."""
    return hashlib.sha256(b"").hexdigest()
