"""Connected components of an undirected edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (a > b): hook neighbours to the smallest one.

    Minima are pre-aggregated and joined back, so a hub's neighbours are never
    gathered in one row.
    """
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        return around.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each node reaches. Only nodes with
    an edge to another node appear; null ends and loops are left out."""
    now = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
           .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a > b").distinct())
    before = None
    while True:
        now = staged(now, "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
        before = mark
        now = _star(_star(now, True).distinct(), False).where("a > b").distinct()
