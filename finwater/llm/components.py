"""Connected components of an edge table, by alternating star steps.

Large-star points every larger neighbour of a node at the smallest neighbour,
small-star does the same among the smaller ones; both keep the components, and
after about log(n) rounds every component is a star around its smallest node.
Each round is two grouped minima and two joins, whose hub nodes adaptive
execution may split, and is cut from its lineage with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finwater.session import ensure_checkpoint_dir


def _point_at_least(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the least of u and its v's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges``: ``root`` is the smallest node
    of its component. Loops and repeated edges do no harm; rows with a null
    end are left out; no edges give no rows."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    now, before = now.distinct().checkpoint(), None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _point_at_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        small = _point_at_least(large)
        small = small.select("v", "m").union(small.select("u", "m"))
        now = small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().checkpoint()
    else:
        raise RuntimeError("components: too many rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


__all__ = ["components"]
