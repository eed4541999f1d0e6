"""Connected components by alternating star operations.

Edges are rewritten until every node of a component points at its least node. In the large
step each node links its greater neighbours to the least of its neighbourhood, in
the small step itself and its lesser neighbours to the least. Both keep the components as
they are; about log(n) rounds are enough in practice. Minima are combined before the shuffle, and
the join that returns them to the edges reads stored frames, so a node with very many links
is split. Every round is written to the shared folder, so a lost executor costs at most
a round. The driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.frames import staged

MAX_ROUNDS = 100


def _rewritten(pairs: DataFrame, label: str, greater: bool) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` to the least node of the neighbourhood."""
    least = staged(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    joined = pairs.join(least, "u")
    if greater:
        linked = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return staged(linked.filter("u <> v").distinct(), label)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with a link.

    ``edges`` has two columns of the same type, ``a`` and ``b``; loops, repeated edges and
    either direction are allowed.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = staged(edges.filter("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _rewritten(both, "large", greater=True)
        low, high = F.least("u", "v"), F.greatest("u", "v")
        now = _rewritten(large.select(high.alias("u"), low.alias("v")).distinct(), "small", greater=False)
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
