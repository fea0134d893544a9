"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _centres(edges: DataFrame) -> DataFrame:
    """(a, b) plus the smallest neighbour ``m`` of ``a`` or ``a`` itself.  The
    minimum is pre-aggregated in every task and joined back, so a vertex with
    very many links is never gathered in one group."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").withColumn("m", F.least("a", "m"))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges(a, b)`` of any ordered type -> ``(node, root)``, one row for each
    node that has a link to another; ``root`` is the least node of its
    component.  Self links and repeated links are harmless."""
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .distinct())
    state = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_centres(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        c = _centres(large)
        small = (c.select("a", F.col("m").alias("b"))
                 .union(c.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .distinct())
        e = saved(small)
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
