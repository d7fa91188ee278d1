"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written


def _stars(edges: DataFrame, *, large: bool) -> DataFrame:
    """One round of the star rewriting: neighbours move to the least node seen from each node.

    The large round moves the larger neighbours of a node and the small round the smaller ones.
    Both keep the components.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = near.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = near.join(least, F.col("a") == F.col("u"))
    if large:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all ends of ``edges (a, b)``; ``component`` is the least node.

    Large and small star rounds alternate until a round changes nothing, so long chains end after
    a number of rounds that grows with the logarithm of their length. Each round is written to the
    shared folder, and no node's links meet in one task.
    """
    state = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20)")).alias("s"))
    before = None
    while True:
        now = state.agg(mark.alias("m")).first()["m"]
        if now == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
        state = written(_stars(_stars(state, large=True), large=False))
