"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.work import forget, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: long, not null); the
    component is its smallest node.

    Each round moves every node to the neighbour with the smallest hash (or leaves it), and
    keeps the edges between different targets. Hashes differ from round to round, so a
    constant share of the nodes goes in each round whatever the graph's shape, and long
    chains need no more rounds than stars. Aggregates are partial before the shuffle, so a
    hub costs no more than its tasks; rounds go through written tables.
    """
    left = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = left.select(F.col("a").alias("node")).unionAll(left.select(F.col("b").alias("node"))).distinct()
    owner = written(nodes.select("node", F.col("node").alias("at")), "owner")
    round_ = 0
    while not left.isEmpty():
        rank = lambda c, r=round_: F.struct(F.xxhash64(F.col(c), F.lit(r)).alias("h"), F.col(c).alias("n"))
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = written(
            both.groupBy("a").agg(F.min(rank("b")).alias("best")).select("a", F.least(rank("a"), "best")["n"].alias("to")), "move"
        )
        to_a, to_b = move.toDF("a", "to_a"), move.toDF("b", "to_b")
        joined = left.join(to_a, "a").join(to_b, "b").where("to_a != to_b")
        new_left = written(joined.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        new_owner = written(
            owner.join(move.toDF("at", "to"), "at", "left").select("node", F.coalesce("to", "at").alias("at")), "owner"
        )
        for old in (left, owner, move):
            forget(old)
        left, owner, round_ = new_left, new_owner, round_ + 1
    forget(left)
    smallest = owner.groupBy("at").agg(F.min("node").alias("component"))
    return owner.join(smallest, "at").select("node", "component")
