"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.session import checkpoint, release


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(node, comp) for every node of an edge; comp is the least node reachable.

    Every round links each neighbour greater than a node to the least neighbour
    (large star), then the smaller ones (small star), until no edge changes. A
    round costs shuffles of the edge table only and the table is written to the
    shared folder and the one before it deleted, so a lost executor repeats one round. Neighbour
    lists are never collected: a hub of any degree is a plain aggregation.
    Null ends and loops are ignored; an empty table gives an empty result.
    """
    now = checkpoint(
        edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).where("x > y").distinct()
    )
    last = None
    for _ in range(most):
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.where("x > y").distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        # each smaller neighbour goes to the least one, the node itself too
        small = large.join(low, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        before, now = now, checkpoint(small.unionByName(low.withColumnRenamed("m", "y")).distinct())
        release(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("x").alias("node"), F.col("y").alias("comp")).unionByName(
        now.select(F.col("y").alias("node"), F.col("y").alias("comp")).distinct()
    )
