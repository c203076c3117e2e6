"""Connected components by alternating large and small stars, with nothing but joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from locusflow.operators.scaling import checkpointed


def settled(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """A checkpoint in as many partitions as its rows need, so that small tables don't spread over many tiny files."""
    done = checkpointed(df)
    return done.coalesce(1 + done.count() // rows)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node that is larger (large star) or not larger (small star) to the least one around."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    new = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return new.filter("a != b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``edges`` (``a, b``).

    Loops are left out, and so are edges with a null end; nodes without any edge are not returned. Every round is
    checkpointed; the rounds grow with the logarithm of the longest chain.
    """
    edges = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a != b").select("a", "b")
    edges, before = settled(edges), None
    for _ in range(most_rounds):
        edges = settled(_star(settled(_star(edges, True)), False))
        # settled when a round changes no edge
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)
        before = state
    raise RuntimeError("components did not settle")
