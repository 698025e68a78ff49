"""Connected components of an edge table by alternating large-star and small-star
rounds; each round ends in a reliable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kiln.session import checkpoint_dir


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node;
    ``component`` is the smallest node reachable.  Repeated, reversed and self edges
    change nothing; edges with a null end are left out."""
    checkpoint_dir(edges.sparkSession)
    # larger end first
    cur = (edges.where(F.col(a) != F.col(b))
           .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
           .distinct().checkpoint())
    state = _state(cur)
    while state[0]:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        cur = small.union(low.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        last, state = state, _state(cur)
        if state == last:
            break
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
