"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum (partial aggregation) and a join; a node with very many edges
is split by the skew join.  Every round is stored, so a lost executor repeats one round; the
tables of a round go when the next is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disparo.llm.common import drop_stored, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(``node``, ``label``) for every node of an edge (``a``, ``b``: longs); the label is the
    least node of its component."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stored(e, "cc-edges")
    before = _state(e)
    if not before[0]:
        return e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .where("a <> b").distinct())
        large = stored(large, "cc-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        former, e = e, stored(small, "cc-small")
        drop_stored(former, large)
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
