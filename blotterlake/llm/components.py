"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is a group-by and a join on node ids and is stored, so lineage stays short.  Nothing
but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blotterlake.llm.common import materialize


def _to_least(both: DataFrame, keep) -> DataFrame:
    """Connect the neighbours of each node that pass ``keep`` to the node's least neighbour or itself."""
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("least"))
    least = least.select("w", F.least("w", "least").alias("least"))
    joined = both.join(least, F.col("u") == F.col("w"))
    return joined.select(keep.alias("u"), F.col("least").alias("v")).where("u is not null and u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """From edges (u long, v long): every node that has a smaller one in its component, and the least."""
    edges = materialize(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, F.when(F.col("v") > F.col("u"), F.col("v")))
        # After a large star every edge leads down; small stars join a node's smaller neighbours.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        with_self = down.union(down.select("u", F.col("u").alias("v")).distinct())
        edges = materialize(_to_least(with_self, F.col("v")), "edges")
