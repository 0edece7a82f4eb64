"""Connected components of a large edge table by alternating stars, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _with_low(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """``pairs`` (u, ...) with ``low`` (u, ...), a table of one row per u.

    The join is on u and a hash of u: ``low`` is not partitioned by that, so both sides are shuffled for the join and
    adaptive execution can split the edges of a node that has very many of them."""
    dealt = pairs.withColumn("_deal", F.xxhash64("u"))
    return dealt.join(low.withColumn("_deal", F.xxhash64("u")), ["u", "_deal"]).drop("_deal")


def _hooked(pairs: DataFrame) -> DataFrame:
    """Both ways of every edge, with the smallest neighbour (or itself) of its first end."""
    both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_low(both, low)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_steps: int = 50) -> DataFrame:
    """(id, component) of every node with an edge; the component is its smallest id.

    Large star: every node hands its larger neighbours to its smallest one. Small star: every
    node hands its smaller neighbours and itself to the smallest. Edges shrink to stars in about
    log steps; only per-node minima are aggregated, and no component meets in one place. Edges
    with a NULL end and loops are ignored. Raises if the edges have not settled after ``max_steps``.
    The table of a step is removed when the next one is written."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u <> v").distinct())
    e = stored(e, "edges")
    mark = None
    for _ in range(max_steps):
        large = _hooked(e).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_low(large, low)
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, e = e, stored(small, "stars")
        discard(before)
        row = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"the components have not settled after {max_steps} steps")
    own = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    roots = e.select(F.col("v").alias("id")).distinct().join(own.select("id"), "id", "left_anti")
    out = stored(own.unionByName(roots.select("id", F.col("id").alias("component"))), "components")
    discard(e)
    return out
