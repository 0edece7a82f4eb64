"""1-based position of each row in a global sort, computed without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into one task. Here
the frame is range-partitioned and sorted by Spark, written to the checkpoint folder (so the
partitions and their order are fixed and the lineage is cut), and each row's position is the
number of rows in earlier partitions plus its index within its own partition. Only one count
per partition travels to a single task, a table bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# monotonically_increasing_id() puts the partition index in the upper 31 bits.
_PARTITION_SHIFT = 33


def with_sort_position(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order).checkpoint(eager=True)
    tagged = ordered.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    index = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _PARTITION_SHIFT)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(*[F.col(c) for c in df.columns], (F.col("_off") + index + 1).alias(name)))
