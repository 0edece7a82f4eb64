"""Joins that stay splittable when one key holds a large share of the rows.

AQE splits a skewed shuffle partition only when both join inputs are shuffle stages of the
join itself. A side that is already partitioned on the key (it comes out of a ``groupBy`` on
it) is not one. ``join_splittable`` joins on the key and a hash of it, which no earlier
partitioning satisfies, so both sides are shuffled for this join: AQE may then split the
heavy partitions of the big side, or broadcast the small side by its measured bytes. Rows
whose key is NULL match nothing; their hash comes from ``spread`` columns, so they are dealt
over all partitions. No key is looked for, counted or capped, and no size is assumed.

``growing`` marks a side that grows with the data. Before a query runs, Spark knows no more of a table than the bytes of
its files, and ids in a row take a byte or less of a compressed column: sides of millions of rows look small enough
to broadcast, and each of them would be gathered in the driver's memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def growing(df: DataFrame) -> DataFrame:
    """``df`` as a side of its next join, which is then a sort-merge join: neither side goes through the driver, and AQE
    can split both."""
    return df.hint("merge")


def join_splittable(big: DataFrame, small: DataFrame, key: str, spread: Sequence[str], how: str = "inner") -> DataFrame:
    """``big.join(small, key, how)`` for ``how`` in inner/left."""
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    dealt = F.when(F.col(key).isNull(), F.xxhash64(*spread)).otherwise(F.xxhash64(key))
    left = big.withColumn("_deal", dealt)
    right = small.withColumn("_deal", F.xxhash64(key))
    return left.join(right, [key, "_deal"], how).drop("_deal")
