"""Prefix trie of conversations: who shares which first turns, and what that saves.

Conversations become paths of chained turn digests. Distinct paths are dealt by
range in path order, so every shard holds a contiguous piece of the trie. A
shard writes its piece as balanced parentheses: findclose delimits a subtree,
the rank of ``()`` pairs counts its leaves, and cumulative arrays over preorder
give its members and savings. Only nodes on the path between two shards (the
spine) stand in more than one; their partial counts are added up afterwards.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import staged
from courierlake.llm.parens import Parens

UNIT = 16                  # bytes of a digest in a path
SHARD_STEPS = 1 << 16      # turns of the distinct paths of a shard, in the mean
NO_ENDS = hashlib.sha256(b"").hexdigest()
# Fixed values of the rebuilt conversations: families of 100, heads of up to 5.
FAMILY, HEADS = 100, 6


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, steps): a conversation's turns in order (null first; ties by
    their digest), each with the digest of role and text and its code points.

    Rows without a conv_id belong to no conversation. Only digests are
    shuffled; a conversation's steps, some 60 bytes a turn, must fit a row.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    known = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.where(F.col("conv_id").isNotNull())
            .select("conv_id", F.struct("turn", F.substring(F.sha2(known.cast("binary"), 256), 1, 2 * UNIT).alias("digest"),
                                        F.length(text).cast("long").alias("n")).alias("s"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("steps")))


def branched(convs: DataFrame) -> DataFrame:
    """Every conversation behind the first turns of its family's first one: h of
    conversation c - c % 100 (all if it has fewer, none if it is absent), then
    its own after the first h, with h = crc32(decimal c) % 6. Only conversations
    with turns are known, so the rebuilt ones may have none."""
    c = F.col("conv_id")
    heads = convs.where(c % FAMILY == 0).select(c.alias("family"), F.slice("steps", 1, HEADS - 1).alias("head"))
    own = convs.withColumn("family", c - c % FAMILY).withColumn(
        "h", (F.crc32(c.cast("string").cast("binary")) % HEADS).cast("int"))
    head = F.expr("slice(coalesce(head, slice(steps, 1, 0)), 1, h)")
    return own.join(heads, "family", "left").select(
        "conv_id", F.concat(head, F.expr("slice(steps, h + 1, size(steps))")).alias("steps"))


def _paths(convs: DataFrame) -> DataFrame:
    """(conv_id, end, path, sizes): chained digests of the turns; ``end`` is the last."""
    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, joined, sizes = [], [], []
            for steps in batch["steps"].to_pylist():
                own, path = b"", []
                for s in steps:
                    own = hashlib.sha256(own + s["digest"].encode()).digest()[:UNIT]
                    path.append(own)
                ends.append(own)
                joined.append(b"".join(path))
                sizes.append([s["n"] for s in steps])
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], pa.array(ends, pa.binary()), pa.array(joined, pa.binary()),
                 pa.array(sizes, pa.list_(pa.int64()))], ["conv_id", "end", "path", "sizes"])

    return convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.transform(
        "steps", lambda s: F.struct(s["digest"].alias("digest"), s["n"].alias("n"))).alias("steps")).mapInArrow(
        chained, "conv_id long, end binary, path binary, sizes array<long>")


def _ends(paths: DataFrame) -> DataFrame:
    """(end, ends_sha256) of the ids that end at a node. A group's ids are
    hashed as they stream by in order, never gathered."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for end, conv in zip(batch["end"].to_pylist(), batch["conv_id"].to_pylist()):
                if end != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = end, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            yield _batch(out)
        if now is not None:
            yield _batch([(now, state.hexdigest())])

    def _batch(out: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()),
                                           pa.array([x[1] for x in out], pa.string())], ["end", "ends_sha256"])

    return paths.select("end", "conv_id").repartition("end").sortWithinPartitions("end", "conv_id").mapInArrow(
        hashed, "end binary, ends_sha256 string")


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share."""
    n = 0
    while n < min(len(a), len(b)) and a[n:n + UNIT] == b[n:n + UNIT]:
        n += UNIT
    return n // UNIT


def _bounds(ordered: DataFrame) -> DataFrame:
    """(shard, before, after): turns that a shard's first path shares with the
    path before, and its last one with the next; -1 where there is none. One
    row a shard."""
    ends = ordered.groupBy("shard").agg(F.min_by("path", "r").alias("first"), F.max_by("path", "r").alias("last"))
    w = Window.orderBy("shard")

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "shard": b["shard"],
                "before": [-1 if p is None else _common(p, f) for p, f in zip(b["prior"], b["first"])],
                "after": [-1 if n is None else _common(n, x) for n, x in zip(b["next"], b["last"])]})

    return ends.select("shard", "first", "last", F.lag("last").over(w).alias("prior"),
                       F.lead("first").over(w).alias("next")).mapInPandas(
        shared, "shard long, before int, after int")


_NODES = [("shard", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("spine", pa.bool_()),
          ("under_spine", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
          ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
          ("ends_sha256", pa.string())]
_SCHEMA = ", ".join(f"{n} {'long' if t == pa.int64() else 'boolean' if t == pa.bool_() else t}" for n, t in _NODES)


def shard_nodes(paths: list[bytes], sizes: list[list[int]], ends: list[int], lows: list[int],
                before: int = -1, after: int = -1) -> dict[str, list | np.ndarray]:
    """The nodes of a shard in preorder. ``paths`` are distinct and in order,
    ``ends`` and ``lows`` are the members that end there and the smallest.

    A node of depth ``before`` or less on the first path, or ``after`` or less
    on the last, is on the spine: its counts are those of this shard, and what
    counts once for a node is left to the first shard that has it.
    """
    bits, node, up, size, seq, stack, prior = [1], [b""], [-1], [0], [-1], [0], b""
    depth = [0]
    for k, path in enumerate(paths):
        keep = _common(prior, path)
        bits += [0] * (len(stack) - 1 - keep)
        del stack[keep + 1:]
        for d in range(keep, len(path) // UNIT):
            bits.append(1)
            up.append(stack[-1])
            stack.append(len(node))
            node.append(path[d * UNIT:(d + 1) * UNIT])
            size.append(sizes[k][d])
            depth.append(d + 1)
            seq.append(-1)
        seq[stack[-1]] = k
        prior = path
    bits += [0] * len(stack)
    last_path = np.array(stack)
    n = len(node)
    up, size, depth, seq = (np.array(x, np.int64) for x in (up, size, depth, seq))
    first_path = np.arange(len(paths[0]) // UNIT + 1)

    old = np.zeros(n, bool)          # an earlier shard has the node, too
    old[first_path[depth[first_path] <= before]] = True
    spine = old.copy()
    spine[last_path[depth[last_path] <= after]] = True

    tree = Parens(np.array(bits))
    opens = np.flatnonzero(tree.bits)
    closes = tree.findclose(opens)
    begin = tree.rank_open(opens)
    end = begin + (closes - opens + 1) // 2

    def over_subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[end] - total[begin]

    ending = seq >= 0
    here, low = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    here[ending], low[ending] = np.array(ends)[seq[ending]], np.array(lows)[seq[ending]]
    members = over_subtree(here)
    leaves = tree.rank_pairs(opens, closes)
    if after >= 0 and after == len(paths[-1]) // UNIT:
        leaves[last_path] -= 1       # the next shard goes on below the last node
    for d in range(int(depth.max()), 0, -1):
        at = np.flatnonzero(depth == d)
        np.minimum.at(low, up[at], low[at])
    children = np.bincount(up[1:][~old[1:]], minlength=n)[:n] if n > 1 else np.zeros(n, np.int64)
    return {"node": node, "up": up, "depth": depth, "seq": seq, "spine": spine, "low": low, "members": members,
            "children": children, "leaves": leaves, "saved": over_subtree((members - ~old) * size)}


def _shard(table: pa.Table) -> pa.Table:
    table = table.sort_by("r")
    shard, before, after = (table[c][0].as_py() for c in ("shard", "before", "after"))
    t = shard_nodes(table["path"].to_pylist(), table["sizes"].to_pylist(), table["n"].to_pylist(),
                    table["low"].to_pylist(), before, after)
    sha = np.array([*table["ends_sha256"].to_pylist(), NO_ENDS], object)[t["seq"]]
    up, spine, low = t["up"], t["spine"], t["low"]
    under = spine[up] & (up >= 0)
    node = np.array(t["node"] + [None], object)
    columns = [np.full(len(up), shard), node[:-1], np.where(up >= 0, node[up], None), spine, under, low, t["depth"],
               np.where(up >= 0, low[up], 0), t["members"], t["children"], t["leaves"], t["saved"], sha]
    out = [pa.array(c, kind) for c, (_, kind) in zip(columns, _NODES)]
    at = [name for name, _ in _NODES].index("parent_conv_id")
    out[at] = pa.array(columns[at], pa.int64(), mask=(up < 0) | under)
    return pa.table(out, [name for name, _ in _NODES])


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row for every distinct sequence of first turns of ``convs`` (conv_id,
    steps as in ``turns_of``; conv_ids are distinct): conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Equal turns have equal 128-bit digests. Null roles and texts are empty ones;
    repeated rows are turns of their own. Long texts count whole; other columns
    are ignored, whatever their names. Any number of copies is one path. No
    conversations give no rows, and conversations without turns only the root.
    """
    paths = staged(_paths(convs), "paths")
    distinct = paths.groupBy("end").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"),
                                        F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    every = staged(distinct.join(_ends(paths), "end").select("path", "sizes", "n", "low", "ends_sha256"), "sequences")
    steps = every.agg(F.sum(F.octet_length("path") / UNIT + 1)).first()[0] or 0
    ordered = staged(every.repartitionByRange(max(1, math.ceil(steps / SHARD_STEPS)), "path").sortWithinPartitions("path")
                     .withColumn("r", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("shard", F.shiftright("r", 33))
    nodes = staged(ordered.join(_bounds(ordered), "shard").groupBy("shard").applyInArrow(_shard, _SCHEMA), "nodes")

    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parts = nodes.where("spine")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    # A node's ids end in one shard; the others have the digest of none.
    ends = F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS))
    merged = staged(parts.groupBy("node", "depth", "parent").agg(
        F.min("conv_id").alias("conv_id"), *sums, ends.alias("ends_sha256")), "spine")
    name = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("named"))
    spine = merged.join(name, "parent", "left").withColumn("parent_conv_id", F.col("named"))
    # Every shard gets the few names of its own spine: no key is hotter than a shard.
    names = parts.select("shard", F.col("node").alias("parent")).join(name, "parent")
    below = nodes.where("not spine and under_spine").join(names, ["shard", "parent"]).withColumn(
        "parent_conv_id", F.col("named"))
    whole = nodes.where("not spine and not under_spine")
    return whole.select(*result).unionByName(below.select(*result)).unionByName(spine.select(*result))
