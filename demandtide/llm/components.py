"""Connected components as Spark joins: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from demandtide.llm.storage import stored


def _star(links: DataFrame, least: DataFrame, name: str) -> DataFrame:
    # the minima are stored, so that the join deals both sides out anew and can split a node with many links
    return stored(links.join(stored(least, "least"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), name)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """id, component of every end of ``edges`` (a, b; longs): the smallest id that links reach.

    A large-star step hangs a node's larger neighbours on the smallest one, a
    small-star step its smaller neighbours and itself; both keep what is connected,
    and the number of edges never grows past one per node and step. Minima are partial
    aggregates and are joined back, so a node with many links is never gathered. Every
    step is stored; the loop ends when a round changes nothing. Nulls and loops are
    dropped; no edges give no rows.
    """
    # an edge points from the larger id a to the smaller id b
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _star(both.filter("v > u"), least, "large-star")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        own = down.select("u", F.col("u").alias("v")).distinct()
        edges = _star(down.unionByName(own), least, "small-star")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now.n, now.h) == mark:
            break
        mark = (now.n, now.h)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
