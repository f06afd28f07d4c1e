"""Near-duplicate groups by b-bit MinHash with exact confirmation.

A document's set holds its distinct five-word shingles. Of 1024 minima only the
two low bits are kept, packed as bit planes; bands of four full minima (of the
first 128) propose candidates, the packed planes give a collision-corrected
estimate by bit counts, and what passes is confirmed on the full sets.

Large buckets are not expanded into pairs. Documents with equal sets are one
class. In the first round each class is held against the smallest class of its
buckets only. Buckets that still hold more than one component are then met in
blocks of bounded size: first each member proposes its best partner in another
component, which joins nearly all of a group; then every pair that is still
between components is proposed, so no link between different sets is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import space_words, staged
from courierlake.llm.graph import components

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
N_HASHES = 1024
BAND_HASHES = 128
BAND_ROWS = 4            # 32 bands: a pair at 0.75 shares none with probability 5e-6
LOW_BITS = 2
# The estimate's standard deviation at 0.75 is 0.0163; 0.68 lies 4.3 of them below.
ESTIMATE_FLOOR = 0.68
BLOCK_MEMBERS = 512
GROUP_ROWS = 20_000
CHUNK_WORDS = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(0, 1 << 31, N_HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, N_HASHES, np.uint32)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2**64, kept for later texts."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(data: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a whole
    text; of the whole sequence when it is shorter; none without words.

    The hash is polynomial in the bytes of the shingle, so all shingles come
    from one prefix sum.
    """
    words = space_words(data or b"")
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    out = []
    for at in range(0, len(words) - size + 1, CHUNK_WORDS):
        part = words[at:at + CHUNK_WORDS + size - 1]
        ends = np.cumsum([len(w) + 1 for w in part])
        starts = ends - [len(w) + 1 for w in part]
        joined = np.frombuffer(b" ".join(part), np.uint8).astype(np.uint64) + np.uint64(1)
        power, unpower = _powers(len(joined) + 1)
        total = np.concatenate(([np.uint64(0)], np.cumsum(joined * power[:-1])))
        first, last = starts[:len(part) - size + 1], ends[size - 1:] - 1
        out.append(_mix((total[last] - total[first]) * unpower[first]))
    return np.unique(np.concatenate(out))


def linked(a: np.ndarray, b: np.ndarray, percent: int = THRESHOLD_PERCENT) -> bool:
    """100 * intersection >= percent * union; an empty set is linked with nothing."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and the bit planes (LOW_BITS * N_HASHES / 64 words) of a set."""
    minima = np.full(N_HASHES, np.iinfo(np.uint32).max, np.uint32)
    high = (own >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 64):
        np.minimum(minima, (high[at:at + 64, None] * _MUL + _ADD).min(axis=0), out=minima)
    minima = _mix(minima.astype(np.uint64))
    bands = minima[:BAND_HASHES].reshape(-1, BAND_ROWS)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = _mix(key * _BASE + bands[:, k])
    planes = [np.packbits(((minima >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)).view(np.int64)
              for k in range(LOW_BITS)]
    return key.view(np.int64), np.concatenate(planes)


def _sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    @F.pandas_udf("n_shingles long, set_hash binary, bands array<long>, planes array<long>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            rows = []
            for data in batch:
                own = shingle_set(data)
                bands, planes = sketch(own) if len(own) else (None, None)
                rows.append((len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(),
                             bands, planes))
            yield pd.DataFrame(rows, columns=["n_shingles", "set_hash", "bands", "planes"])

    return docs.select(F.col(id_col).alias("doc_id"),
                       make(F.col(text_col).cast("binary")).alias("s")).select("doc_id", "s.*")


def estimate(a: str, b: str):
    """Collision-corrected similarity of two plane arrays: hashes whose low bits
    all agree, less what agrees by chance."""
    n = N_HASHES // 64
    def differ(word):
        return F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), [
            F.col(a)[k * n + word].bitwiseXOR(F.col(b)[k * n + word]) for k in range(LOW_BITS)]))
    same = N_HASHES - reduce(lambda x, y: x + y, [differ(w) for w in range(n)])
    chance = 2.0 ** -LOW_BITS
    return (same / F.lit(float(N_HASHES)) - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose full sets are linked."""
    @F.pandas_udf("boolean")
    def check(left: pd.Series, right: pd.Series) -> pd.Series:
        last, own, out = None, None, []
        for a, b in zip(left, right):
            if a != last:
                last, own = a, shingle_set(a)
            out.append(linked(own, shingle_set(b)))
        return pd.Series(out, dtype=bool)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    one, two = texts.toDF("b", "text_b"), texts.toDF("a", "text_a")
    return pairs.join(one, "b").join(two, "a").where(check("text_a", "text_b")).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    component_id is the smallest id reachable over links, the own one included;
    kept marks the row with that id. Null text, or text without words: an empty
    set, linked with nothing. Fewer than five words: the whole sequence is one
    shingle. Rows that repeat an id are documents of their own sets, under the
    same id. A null id is kept on its own and links nothing. Other columns are ignored; an
    empty table gives no rows.
    """
    sketches = staged(_sketches(docs, id_col, text_col), "sketches")
    classes = staged(
        sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_hash")
        .agg(F.min("doc_id").alias("id"), F.any_value("bands").alias("bands"),
             F.any_value("planes").alias("planes")), "classes")
    planes = classes.select("id", "planes")
    members = classes.select("id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1")
    shared = staged(members.join(buckets, "key"), "buckets")

    star = shared.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    star = (star.join(planes.toDF("a", "planes_a"), "a").join(planes.toDF("b", "planes_b"), "b")
            .where(estimate("planes_a", "planes_b") >= ESTIMATE_FLOOR).select("a", "b").distinct())
    star = staged(star, "star")
    links = staged(_confirmed(star, docs, id_col, text_col), "links")
    labels = staged(components(links), "labels")

    tried = star
    for best in (True, False):
        more = staged(_between_components(shared, labels, classes, best).distinct()
                      .join(tried, ["a", "b"], "left_anti"), "between")
        if more.take(1):
            links = staged(links.unionByName(_confirmed(more, docs, id_col, text_col)), "links")
            labels = staged(components(links), "labels")
            tried = tried.unionByName(more)

    names = classes.select("set_hash", "id").join(labels.toDF("id", "label"), "id", "left").select(
        "set_hash", F.coalesce("label", "id").alias("component_id"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return (sketches.select("doc_id", "n_shingles", "set_hash").join(names, "set_hash", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNull(), F.lit(None))
                        .otherwise(F.coalesce(own, "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def _meet(frame: pd.DataFrame, best: bool) -> pd.DataFrame:
    """Pairs (a < b) of different labels that pass the estimate, bucket block by
    bucket block: each member's best partner, or every pair, in the first of
    the buckets that it shares."""
    frame = frame.sort_values(["key", "i", "j", "side", "id"], kind="stable")
    ids, labels, side = (frame[c].to_numpy() for c in ("id", "label", "side"))
    planes = np.stack(frame["planes"].to_list()).view(np.uint64)
    bands = np.stack(frame["bands"].to_list())
    key, i, j = (frame[c].to_numpy() for c in ("key", "i", "j"))
    cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    n_words, chance, out = N_HASHES // 64, 2.0 ** -LOW_BITS, []
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(frame)]):
        left = lo + np.flatnonzero(side[lo:hi] == 0)
        right = lo + np.flatnonzero(side[lo:hi] == 1)
        if not len(left) or not len(right):
            continue
        differ = np.zeros((len(left), len(right)), np.int64)
        for w in range(n_words):
            either = np.zeros_like(differ, np.uint64)
            for k in range(w, LOW_BITS * n_words, n_words):
                either |= planes[left, k][:, None] ^ planes[right, k][None, :]
            differ += np.bitwise_count(either)
        similar = ((N_HASHES - differ) / N_HASHES - chance) / (1 - chance)
        similar[(similar < ESTIMATE_FLOOR) | (labels[left][:, None] == labels[right][None, :])] = -1
        if not (similar >= 0).any():
            continue
        if best:
            x, y = np.arange(len(left)), similar.argmax(axis=1)
            u, v = similar.argmax(axis=0), np.arange(len(right))
            x, y = np.concatenate((x, u)), np.concatenate((y, v))
            keep = similar[x, y] >= 0
            x, y = left[x[keep]], right[y[keep]]
        else:
            x, y = np.nonzero(similar >= 0)
            x, y = left[x], right[y]
            first = (bands[x] == bands[y]).argmax(axis=1)
            keep = bands[x, first] == key[lo]
            x, y = x[keep], y[keep]
        out.append(np.unique(np.sort(np.stack((ids[x], ids[y]), axis=1), axis=1), axis=0))
    pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return pd.DataFrame(np.unique(pairs, axis=0), columns=["a", "b"])


def _between_components(shared: DataFrame, labels: DataFrame, classes: DataFrame, best: bool) -> DataFrame:
    """Candidate pairs of different components in buckets of three or more (the
    first round has met every pair of a bucket of two).

    In each bucket only the members outside its most common component look for
    partners, among all members: a bucket of one component and few strangers
    makes rows in proportion to its size. Both sides are cut into blocks of
    about BLOCK_MEMBERS by a hash of the id and met block against block, so a
    large bucket spreads over many tasks.
    """
    named = (shared.where("n > 2").join(labels.toDF("id", "label"), "id", "left")
             .select("key", "id", F.coalesce("label", "id").alias("label")))
    parts = named.groupBy("key", "label").agg(F.count("*").alias("m"))
    mixed = parts.groupBy("key").agg(
        F.max(F.struct("m", (-F.col("label")).alias("low"))).alias("top"), F.sum("m").alias("n"),
        F.count("*").alias("labels")).where("labels > 1")
    def blocks(n):
        return F.ceil(n / BLOCK_MEMBERS).cast("bigint")
    mixed = mixed.select("key", (-F.col("top.low")).alias("most"), blocks(F.col("n")).alias("all"),
                         blocks(F.col("n") - F.col("top.m")).alias("strangers"))
    own, zero = F.xxhash64("id"), F.lit(0).cast("bigint")
    rest = staged(named.join(mixed, "key"), "mixed")
    seekers = rest.where("label <> most").select(
        "key", "id", "label", F.lit(0).alias("side"), F.pmod(own, "strangers").alias("i"),
        F.explode(F.sequence(zero, F.col("all") - 1)).alias("j"))
    sought = rest.select("key", "id", "label", F.lit(1).alias("side"),
                         F.explode(F.sequence(zero, F.col("strangers") - 1)).alias("i"), F.pmod(own, "all").alias("j"))
    rest = staged(seekers.unionByName(sought), "rest")
    groups = rest.count() // GROUP_ROWS + 1
    rows = rest.join(classes.select("id", "planes", "bands"), "id").withColumn(
        "g", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)))

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        return _meet(frame, best)

    return rows.groupBy("g").applyInPandas(meet, "a long, b long")
