"""Merkle manifest of a table: one hash tree per group, one over the groups.

Leaves are dealt by range, so that every task holds a contiguous run of a
tree's leaves. A run gives the largest nodes that it holds whole; nodes that
several runs share are built from those in rounds over aligned blocks. For the
proofs (an octopus multiproof), each run computes the smallest set of
coordinates that all its leaves miss together, fetches these nodes in one join,
derives the shared interior nodes and expands every leaf's own path locally.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import staged

RUN_LEAVES = 1 << 14       # leaves of a run, in the mean
BLOCK_LEVELS = 8           # levels that a round over the shared nodes adds
_TOP = 64                  # levels of the tree over the groups start here
_SUBROOT, _ROOT = -1, -2   # "levels" under which a run gets the two roots

PATH = "array<struct<side:int,digest:string>>"
_NODES = "tree string, total long, level int, idx long, digest string"


def digest_of(*values: Column) -> Column:
    """H of the encoded values: ``-`` for null, else bytes, ``:``, value."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to. ``side`` is -1 for a sibling
    on the left, 1 on the right, 0 where the node is alone in its run."""
    def step(own: Column, s: Column) -> Column:
        joined = F.when(s["side"] < 0, F.concat(s["digest"], own)).when(
            s["side"] > 0, F.concat(own, s["digest"])).otherwise(own)
        return F.sha2(joined.cast("binary"), 256)
    return F.aggregate(path, leaf, step)


def parent(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def climb(start: int, digests: list[str], total: int) -> list[tuple[int, list[str]]]:
    """Per level, (first index, digests) of the nodes that lie whole in the
    leaves [start, start + len(digests)) of a tree of ``total`` leaves."""
    out = [(start, digests)]
    while total > 1 and digests:
        end = start + len(digests)
        low, high = start + (start & 1), end if end == total else end - (end & 1)
        digests = [parent(*digests[i - start:i - start + 2]) for i in range(low, high, 2)]
        start, total = low // 2, (total + 1) // 2
        out.append((start, digests))
    return out


def largest(levels: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the whole nodes whose parent is not whole."""
    for level, (start, digests) in enumerate(levels):
        up, above = levels[level + 1] if level + 1 < len(levels) else (0, [])
        for i, digest in enumerate(digests, start):
            if not up <= i // 2 < up + len(above):
                yield level, i, digest


def missing(start: int, end: int, total: int) -> Iterator[tuple[int, int]]:
    """The least coordinates (level, index) besides the leaves [start, end)
    from which every path of these leaves follows: a sibling is missing only
    where neither a leaf of the run nor another fetched node lies below it."""
    low, high, level = start, end - 1, 0
    while total > 1:
        if low & 1:
            yield level, low - 1
        if not high & 1 and high + 1 < total:
            yield level, high + 1
        low, high, total, level = low >> 1, high >> 1, (total + 1) >> 1, level + 1


def paths(start: int, digests: list[str], total: int, fetched: dict[tuple[int, int], str]) -> list[list[tuple[int, str | None]]]:
    """Every leaf's path of (side, sibling) to the root of its tree."""
    levels, low, size, end = [], start, total, start + len(digests)
    while size > 1:
        high = low + len(digests) - 1
        if (len(levels), low - 1) in fetched and low & 1:
            low, digests = low - 1, [fetched[len(levels), low - 1], *digests]
        if not high & 1 and high + 1 < size:
            digests = [*digests, fetched[len(levels), high + 1]]
        levels.append((low, digests))
        digests = [parent(*digests[i:i + 2]) for i in range(0, len(digests), 2)]
        low, size = low >> 1, (size + 1) >> 1
    out = []
    for at in range(start, end):
        path, i, size = [], at, total
        for first, own in levels:
            path.append((-1, own[i - 1 - first]) if i & 1 else (1, own[i + 1 - first]) if i + 1 < size else (0, None))
            i, size = i >> 1, (size + 1) >> 1
        out.append(path)
    return out


def _ranked(leaves: DataFrame, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The leaves in order with ``part`` and ``r`` (rising), and one row per
    run (tree, part) with its first position and the tree's size."""
    parts = max(1, math.ceil(leaves.count() / RUN_LEAVES))
    ranked = staged(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("r", F.monotonically_increasing_id()), name)
    ranked = ranked.withColumn("part", F.shiftright("r", 33))
    before = Window.partitionBy("tree").orderBy("part")
    runs = ranked.groupBy("tree", "part").agg(F.count("*").alias("size")).select(
        "tree", "part", "size", F.sum("size").over(Window.partitionBy("tree")).alias("total"),
        F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return ranked, staged(runs, f"{name}-runs")


def _tiles(table: pa.Table) -> pa.Table:
    """The largest whole nodes of one run."""
    table = table.sort_by("r")
    tree, total, start = (table[c][0].as_py() for c in ("tree", "total", "start"))
    out = [(tree, total, *n) for n in largest(climb(start, table["digest"].to_pylist(), total))]
    return _nodes(out)


def _nodes(rows: list[tuple]) -> pa.Table:
    types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string())
    names = ("tree", "total", "level", "idx", "digest")
    columns = zip(*rows) if rows else ([],) * len(names)
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], list(names))


def _block(top: int):
    """Nodes that a block's runs share, up to level ``top``."""
    def build(table: pa.Table) -> pa.Table:
        tree, total = table["tree"][0].as_py(), table["total"][0].as_py()
        given: dict[int, dict[int, str]] = {}
        for level, i, digest in zip(*(table[c].to_pylist() for c in ("level", "idx", "digest"))):
            given.setdefault(level, {})[i] = digest
        out = []
        for level in range(min(given), top):
            size = (total + (1 << level) - 1) >> level
            if size == 1:
                break
            own = given.get(level, {})
            for i in own:
                if not i & 1 and (i + 1 in own or i + 1 == size):
                    digest = parent(own[i], *([own[i + 1]] if i + 1 < size else []))
                    given.setdefault(level + 1, {})[i >> 1] = digest
                    out.append((tree, total, level + 1, i >> 1, digest))
        return _nodes(out)
    return build


def _tree(ranked: DataFrame, runs: DataFrame, name: str) -> DataFrame:
    """The nodes that no run holds below another whole node: the largest whole
    nodes of the runs, and all that lie above them, the roots included."""
    nodes = staged(ranked.select("tree", "part", "r", "digest").join(runs, ["tree", "part"])
                   .groupBy("tree", "part").applyInArrow(_tiles, _NODES), f"{name}-tiles")
    deepest = (runs.agg(F.max("total")).first()[0] or 1) - 1
    fresh, low, top = nodes, 0, max(1, RUN_LEAVES.bit_length() - 1) + BLOCK_LEVELS
    while low < deepest.bit_length():
        # Everything below ``low`` is merged; blocks of 2 ** top leaves are next.
        cover = nodes.where(F.col("level").between(low, top - 1))
        block = F.expr(f"shiftright(idx, {top} - level)").alias("block")
        fresh = staged(cover.groupBy("tree", block).applyInArrow(_block(top), _NODES), f"{name}-shared")
        nodes = nodes.unionByName(fresh)
        low, top = top, top + BLOCK_LEVELS
    return nodes


def _fetched(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, part, level, idx, digest): what every run misses."""
    def coordinates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(r.tree, r.part, *c) for r in batch.itertuples()
                   for c in missing(r.start, r.start + r.size, r.total)]
            yield pd.DataFrame(out, columns=["tree", "part", "level", "idx"])

    wanted = runs.select("tree", "part", "start", "size", "total").mapInPandas(
        coordinates, "tree string, part long, level int, idx long")
    return wanted.join(nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"])


def _expanded(ranked: DataFrame, runs: DataFrame, fetched: DataFrame) -> DataFrame:
    """ranked with ``position``, ``subroot``, ``root`` and ``path``."""
    kept = [f for f in ranked.schema.fields if f.name not in ("part",)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("r")
        start, total = (left[c][0].as_py() if len(left) else 0 for c in ("start", "total"))
        given = {(level, i): d for level, i, d in zip(*(right[c].to_pylist() for c in ("level", "idx", "digest")))}
        own = paths(start, left["digest"].to_pylist(), total, given) if len(left) else []
        top = [((0, None) if d is None else (-1 if i % 2 == 0 else 1, d))
               for (level, i), d in sorted(given.items()) if level >= _TOP]
        path = pa.array([[{"side": s, "digest": d} for s, d in p + top] for p in own],
                        pa.list_(pa.struct([("side", pa.int32()), ("digest", pa.string())])))
        n = len(left)
        return pa.table([left[f.name] for f in kept] + [
            pa.array(range(start, start + n), pa.int64()), pa.array([given.get((_SUBROOT, 0))] * n, pa.string()),
            pa.array([given.get((_ROOT, 0))] * n, pa.string()), path],
            [f.name for f in kept] + ["position", "subroot", "root", "path"])

    rows = ranked.join(runs.select("tree", "part", "start", "total"), ["tree", "part"])
    return rows.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part")).applyInArrow(
        expand, f"{schema}, position long, subroot string, root string, path {PATH}")


def _roots(nodes: DataFrame) -> DataFrame:
    return nodes.where("idx = 0 and shiftright(total - 1, level) = 0").select("tree", F.col("digest").alias("subroot"))


def manifest(docs: DataFrame, group_col: str = "lang", id_col: str = "doc_id",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, position, subroot, root, path, carried): the place of every
    row in the manifest and its proof; ``fold(leaf, path)`` gives the root.

    A leaf is ``digest_of`` the fields. In each group, leaves ascend by the id
    (null first; rows that repeat an id by leaf, equal rows in any order, for
    they are interchangeable); every two consecutive nodes have a parent, a
    last one alone has one too, until one node is left, the subroot. Subroots
    by group (null first, then by UTF-8 bytes) have the same tree above them.
    ``carry`` names expressions over ``docs`` that come back in the struct
    ``carried``; no other column of ``docs`` matters, whatever its name. Empty
    texts and very long ones are fields as any other, hashed whole and never
    shuffled: only digests move. An empty table gives no rows.
    """
    carried = F.struct(*[c.alias(n) for n, c in (carry or {}).items()]) if carry else F.lit(None).cast("string")
    leaves = staged(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"), digest_of(*[F.col(c) for c in fields]).alias("digest"),
        carried.alias("carried"), F.monotonically_increasing_id().alias("tie")), "leaves")
    ranked, runs = _ranked(leaves, ["tree", "id", "digest", "tie"], "manifest")
    nodes = _tree(ranked, runs, "manifest")

    # The same over the subroots, one leaf for each group.
    subroots = staged(_roots(nodes).select(F.lit("").alias("tree"), F.col("tree").alias("id"),
                                           F.col("subroot").alias("digest")), "subroots")
    top, top_runs = _ranked(subroots, ["tree", "id"], "groups")
    top_nodes = _tree(top, top_runs, "groups")
    root = _roots(top_nodes).first()  # one digest
    above = _expanded(top, top_runs, _fetched(top_runs, top_nodes).unionByName(top_runs.select(
        "tree", "part", F.lit(_ROOT).alias("level"), F.lit(0).cast("bigint").alias("idx"),
        F.lit(root and root["subroot"]).alias("digest"))))
    above = staged(above.select(F.col("id").alias("tree"), F.col("digest").alias("subroot"), "root", "position",
                                "path"), "above")

    # Levels over the groups: the sibling's index only tells its side.
    steps = F.transform("path", lambda s, k: F.struct(
        (k + _TOP).cast("int").alias("level"), F.when(s["side"] < 0, 0).otherwise(1).cast("bigint").alias("idx"),
        s["digest"].alias("digest")))
    ends = F.array(*[F.struct(F.lit(level).cast("int").alias("level"), F.lit(0).cast("bigint").alias("idx"),
                              F.col(c).alias("digest")) for level, c in ((_SUBROOT, "subroot"), (_ROOT, "root"))])
    shared = runs.select("tree", "part").join(above.select("tree", F.explode(F.concat(steps, ends)).alias("s")), "tree")
    fetched = _fetched(runs, nodes).unionByName(shared.select("tree", "part", "s.*"))
    return _expanded(ranked, runs, fetched).select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "position", "subroot", "root", "path", "carried")


def proof_digest(path: Column) -> Column:
    """H of a path's siblings, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.coalesce(s["digest"], F.lit(""))), "").cast("binary"), 256)
