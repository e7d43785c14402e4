"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is one node of the component, the same for all its nodes.

    In each round every node moves to the least of itself and its neighbours, in an order that each round draws anew
    from a hash, and edges between moved ends remain. Expected rounds are logarithmic in the longest path; each is
    written to the shared folder. Minima are taken map-side first and the joins have one row a key on one side, so a
    node with very many edges is split like any skewed key. Rows with a null end are ignored, as are loops.
    """
    left = stored(edges.select("a", "b").filter("a <> b"), "component-edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), c).alias("h"), F.col(c).alias("v"))  # noqa: B023,E731
        to = both.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a")))["v"].alias("to"))
        move = stored(to.withColumnRenamed("a", "node"), "component-moves")
        moves.append(move)
        left = stored(
            left.join(move.select(F.col("node").alias("a"), F.col("to").alias("a_to")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("to").alias("b_to")), "b")
            .filter("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            "component-edges",
        )
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).filter("false")
    roots = moves[-1].withColumnRenamed("to", "root")
    for move in reversed(moves[:-1]):
        above = roots.select(F.col("node").alias("to"), F.col("root").alias("top"))
        roots = move.join(above, "to", "left").select("node", F.coalesce("top", "to").alias("root"))
    return roots
