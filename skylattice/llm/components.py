"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylattice.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (``large``) or other smaller neighbours to its smallest neighbour.

    The neighbourhoods are not collected: the smallest neighbour is an
    aggregate, joined back to the rows, so that a hub of any degree is fine.
    """
    if large:
        pairs = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(low, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))
        )
    return out.where("a != b").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Each round writes the contracted edges to the checkpoint folder, where a
    lost executor finds them again. Rounds grow with the logarithm of the
    largest component; ``max_rounds`` only guards against endless loops and
    raises. Self-loops and repeated edges are harmless, an empty table gives none.
    """
    now = materialize(edges.select("a", "b").where("a != b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        now = materialize(_star(_star(now, True), False), "edges")
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
