"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Suffixes are sorted where content-defined anchors place them (see
:mod:`anchors`): every 200-byte window lies in one segment, and equal windows
lie in segments with the same anchor. Tasks sort the segments whose anchor gram
occurs more than once, collapse equal ones and send front-coded runs; the runs
of a bucket are combined by a loser tree that keeps each string's common prefix
with the last output and never compares a known prefix again. Equal segments
repeat as a whole. Where segments share an anchor but differ, their windows
are compared with each other.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.anchors import WINDOW, segments, window_hashes
from courierlake.llm.common import staged

RUN_STRINGS = 60_000       # strings a task sorts at a time
BUCKET_STRINGS = 150_000   # strings of a bucket, about
GROUP_STRINGS = 20_000     # strings around one anchor that one task compares

_RUN = "bucket long, strings binary, owners binary"
_OUT = "row long, a long, b long, gram long, string binary, repeated boolean"


# ---------------------------------------------------------------- sorted runs

def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, the first ``known`` bytes being common."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def front_code(strings: list[bytes]) -> bytes:
    """Sorted strings, each as its common prefix with the one before and the rest."""
    last, shared, rests = b"", [], []
    for s in strings:
        n = common_prefix(last, s)
        shared.append(n)
        rests.append(s[n:])
        last = s
    head = np.array([len(strings), *shared, *map(len, rests)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(rests))


def front_decode(data: bytes) -> tuple[list[bytes], list[int]]:
    """The strings of a run and their common prefixes with the ones before."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    numbers = np.frombuffer(raw, "<u4", 2 * n, 4).tolist()
    at, last, out = 4 + 8 * n, b"", []
    for shared, size in zip(numbers[:n], numbers[n:]):
        last = last[:shared] + raw[at:at + size]
        out.append(last)
        at += size
    return out, numbers[:n]


class LoserTree:
    """Merges sorted runs. Each head knows its common prefix with the last
    output; heads that differ in it are ordered without looking at a byte."""

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.head = [s[0] if s else None for s, _ in runs]
        self.lcp = [0] * len(runs)
        self.losers = [-1] * max(len(runs), 1)
        self.winner = -1
        for r in range(len(runs)):
            self._climb(r)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return y is None and x is not None
        if self.lcp[a] != self.lcp[b]:
            return self.lcp[a] > self.lcp[b]
        n = common_prefix(x, y, self.lcp[a])
        if x[n:n + 1] <= y[n:n + 1]:
            self.lcp[b] = n
            return True
        self.lcp[a] = n
        return False

    def _climb(self, r: int) -> None:
        node = (r + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = r
                return
            if not self._beats(r, other):
                self.losers[node], r = r, other
            node //= 2
        self.winner = r

    def __iter__(self) -> Iterator[tuple[bytes, int, int, int]]:
        """(string, common prefix with the output before, run, index) in order."""
        while self.runs and self.head[self.winner] is not None:
            r = self.winner
            strings, shared = self.runs[r]
            i = self.at[r]
            yield strings[i], self.lcp[r], r, i
            self.at[r] = i = i + 1
            self.head[r] = strings[i] if i < len(strings) else None
            self.lcp[r] = shared[i] if i < len(strings) else 0
            self._climb(r)


# ------------------------------------------------------------- sort and merge

def _runs(items: dict, n_buckets: int) -> pd.DataFrame:
    """Front-coded runs of ``items``: string -> [row, start, gram, repeated]."""
    buckets: dict[int, list[bytes]] = {}
    for s in items:
        buckets.setdefault(zlib.crc32(s) % n_buckets, []).append(s)
    rows = []
    for bucket, strings in buckets.items():
        strings.sort()
        owners = np.array([items[s] for s in strings], "<i8")
        rows.append((bucket, front_code(strings), zlib.compress(owners.tobytes(), 1)))
    items.clear()
    return pd.DataFrame(rows, columns=["bucket", "strings", "owners"])


def _merged(runs: DataFrame) -> DataFrame:
    """Each distinct string once with its first owner, and every other owner of
    an equal string: (row, a, b) window starts, repeated."""
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["owners", "strings"])
        decoded = [front_decode(x) for x in frame["strings"]]
        owners = [np.frombuffer(zlib.decompress(x), "<i8").reshape(-1, 4).tolist() for x in frame["owners"]]
        out: list[list] = []
        first = None
        for s, lcp, r, i in LoserTree(decoded):
            row, start, gram, repeated = owners[r][i]
            if first is not None and lcp == len(s) == len(first[4]):
                first[5] = True
                out.append([row, start, start + len(s) - WINDOW, None, None, True])
                continue
            first = [row, start, start + len(s) - WINDOW, gram, s, bool(repeated)]
            out.append(first)
        return pd.DataFrame(out, columns=["row", "a", "b", "gram", "string", "repeated"]).astype({"gram": "Int64"})

    return runs.groupBy("bucket").applyInPandas(merge, _OUT)


def _sorted_runs(rows: DataFrame, take, n_buckets: int) -> DataFrame:
    """Runs and local repeats of what ``take(frame)`` yields: (string, row,
    start, gram). Owners of a string the task already holds leave at once."""
    schema = f"{_RUN}, row long, a long, b long"

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: dict[bytes, list] = {}
        known: list[tuple] = []
        for batch in batches:
            for s, row, start, gram in take(batch):
                held = items.get(s)
                if held is not None:
                    held[3] = 1
                    known.append((row, start, start + len(s) - WINDOW))
                    continue
                items[s] = [row, start, gram, 0]
                if len(items) >= RUN_STRINGS:
                    yield _both(_runs(items, n_buckets), known)
        yield _both(_runs(items, n_buckets), known)

    def _both(runs: pd.DataFrame, known: list) -> pd.DataFrame:
        out = pd.concat([runs.astype(object), pd.DataFrame(known, columns=["row", "a", "b"]).astype(object)])
        known.clear()
        return out[["bucket", "strings", "owners", "row", "a", "b"]].astype(
            {c: "Int64" for c in ("bucket", "row", "a", "b")})

    return rows.mapInPandas(sort, schema)


def _sort_merge(rows: DataFrame, take, n_strings: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(distinct strings and their equals, repeats found while sorting)."""
    n_buckets = max(1, math.ceil(n_strings / BUCKET_STRINGS))
    sorted_rows = staged(_sorted_runs(rows, take, n_buckets), f"{name}-runs")
    runs = sorted_rows.where("bucket IS NOT NULL").select("bucket", "strings", "owners")
    local = sorted_rows.where("bucket IS NULL").select("row", "a", "b")
    return staged(_merged(runs), f"{name}-merged"), local


# ------------------------------------------------------------------- operator

def _anchors(docs: DataFrame) -> DataFrame:
    @F.pandas_udf("array<long>")
    def grams(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([segments(x)[2] for x in batch], dtype=object)

    return docs.select("row", grams("data").alias("grams"))


def _packed(data: str):
    """The bytes compressed for a shuffle."""
    @F.pandas_udf("binary")
    def pack(batch: pd.Series) -> pd.Series:
        return batch.map(zstandard.ZstdCompressor(level=1).compress)

    return pack(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _flagged_segments(batch: pd.DataFrame) -> Iterator[tuple[bytes, int, int, int]]:
    for row, packed, ks in zip(batch["row"], batch["packed"], batch["ks"]):
        data = _unpack(packed)
        first, last, gram = segments(data)
        for k in ks:
            a = int(first[k])
            yield data[a:int(last[k]) + WINDOW], row, a, int(gram[k])


def _windows(batch: pd.DataFrame) -> Iterator[tuple[bytes, int, int, int]]:
    for row, a, gram, s in zip(batch["row"], batch["a"], batch["gram"], batch["string"]):
        for i in range(len(s) - WINDOW + 1):
            yield s[i:i + WINDOW], row, a + i, gram


def _shared_windows(frame: pd.DataFrame) -> pd.DataFrame:
    """Runs of windows that occur in more than one string of the frame."""
    strings = frame["string"].tolist()
    hashes = [window_hashes(np.frombuffer(s, np.uint8), WINDOW) for s in strings]
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    twice = np.zeros(len(every), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    out, at = [], 0
    for row, a, n in zip(frame["row"], frame["a"], map(len, hashes)):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], twice[at:at + n].view(np.int8), [0]))))
        out += [(row, a + x, a + y - 1) for x, y in edges.reshape(-1, 2).tolist()]
        at += n
    return pd.DataFrame(out, columns=["row", "a", "b"])


def repeats(docs: DataFrame) -> DataFrame:
    """(row, a, b): runs of the starts of windows that occur elsewhere, from
    (row, data). Rows with one ``row`` number must hold the same data."""
    anchors = staged(_anchors(docs), "anchors")
    every = anchors.select("row", F.posexplode("grams").alias("k", "gram"))
    twice = every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    flagged = staged(every.join(twice, "gram").groupBy("row").agg(F.collect_set("k").alias("ks")), "flagged")
    n_flagged = flagged.agg(F.sum(F.size("ks"))).first()[0] or 0

    rows = docs.select("row", _packed("data").alias("packed")).join(flagged, "row")
    strings, local = _sort_merge(rows, _flagged_segments, n_flagged, "segments")
    found = [local, strings.where("repeated").select("row", "a", "b")]

    # Anchors around which different strings remain, some of them found once.
    kinds = strings.where("string IS NOT NULL")
    open_grams = staged(kinds.groupBy("gram").agg(F.count("*").alias("n"), F.bool_and("repeated").alias("done"))
                        .where("n > 1 AND NOT done").select("gram", "n"), "open")
    small, large = open_grams.where(F.col("n") <= GROUP_STRINGS), open_grams.where(F.col("n") > GROUP_STRINGS)
    total = open_grams.agg(F.sum(F.when(F.col("n") <= GROUP_STRINGS, F.col("n"))),
                           F.sum(F.when(F.col("n") > GROUP_STRINGS, F.col("n")))).first()
    if total[0]:
        buckets = math.ceil(total[0] / GROUP_STRINGS)
        near = (kinds.join(small.select("gram"), "gram").select(
            F.pmod(F.xxhash64("gram"), F.lit(buckets)).alias("bucket"), "row", "a", "string"))
        found.append(near.groupBy("bucket").applyInPandas(_shared_windows, "row long, a long, b long"))
    if total[1]:
        wide = kinds.join(large.select("gram"), "gram").select("row", "a", "gram", "string").repartition("row", "a")
        windows, local = _sort_merge(wide, _windows, total[1] * (WINDOW // 2), "windows")
        found += [local, windows.where("repeated").select("row", "a", "b")]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans), one row
    for each row of ``docs``; kept is the remaining bytes, spans the removed
    byte ranges.

    Every byte inside a 200-byte string that starts anywhere else too is
    removed, judged on the input. Null text is an empty text. Repeated rows
    hold the same strings, so their long texts go. Text shorter than 200 bytes
    stays. Other columns are ignored; an empty table gives no rows.
    """
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).alias("doc_id"), data.alias("data"),
                       F.xxhash64(F.col(id_col), data).alias("row"))
    spans = repeats(rows.select("row", "data")).groupBy("row").agg(
        F.collect_list(F.struct("a", "b")).alias("runs"))

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
                  "spans array<struct<start:long,end:long>>")
    def cut(packed: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for raw, own in zip(packed, runs):
            text = _unpack(raw)
            parts, at, gone, cuts = [], 0, 0, []
            for a, b in sorted((x["a"], x["b"] + WINDOW) for x in own) if own is not None else ():
                if cuts and a <= cuts[-1][1]:
                    cuts[-1][1] = max(cuts[-1][1], b)
                else:
                    cuts.append([a, b])
            for a, b in cuts:
                parts.append(text[at:a])
                at, gone = b, gone + b - a
            kept = b"".join([*parts, text[at:]])
            out.append((len(text), gone, len(cuts), hashlib.sha256(kept).hexdigest(), kept,
                        [{"start": a, "end": b} for a, b in cuts]))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    whole = rows.select("doc_id", "row", _packed("data").alias("packed")).join(spans, "row", "left")
    return whole.select("doc_id", cut("packed", "runs").alias("c")).select("doc_id", "c.*")
