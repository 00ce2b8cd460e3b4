"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.shared import Scratch


def component_roots(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns node, root: the smallest node reachable from every node that has an edge and is not a root.

    ``edges`` has columns a and b (longs, any order, repeats allowed). Alternating large-star and
    small-star rounds; each keeps at most as many edges as there were and is written to the shared
    folder. The driver sees one count and one checksum a round. Nodes with very many edges are
    combined before the shuffle, and their join is left to the skew split of adaptive execution.
    """
    now = scratch.save(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = scratch.save(small)
