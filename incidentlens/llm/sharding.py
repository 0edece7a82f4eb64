"""Sharding by global byte-size prefix sums, cut at equal targets: contiguous balanced shards.

The narrow rows (id, size, checksum) are range-partitioned by doc_id and written once; one
total per partition gives each partition its offset, a running sum inside the partition gives
each row its place, and a row goes to the shard in which the middle of its bytes falls.

Defined results: a NULL text has size 16 and the checksum of the empty text; repeated rows
follow each other; an empty table gives an empty result; input columns named like an output
are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, without

OUTPUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def prefix_sums(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``size``) plus ``bytes_before`` and ``rows_before`` in the global order.

    Rows equal in ``order`` are told apart by their place in the input, so one value that holds
    many rows is spread over many partitions."""
    told = rows.withColumn("_place", F.monotonically_increasing_id())
    ranged = told.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*order, "_place"]])
    kept = stored(ranged.withColumn("_pid", F.spark_partition_id()), "shard-rows")
    totals = kept.groupBy("_pid").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    bytes_before = rows_before = 0
    offsets = []
    for r in sorted(totals, key=lambda r: r["_pid"]):  # one row per partition, whatever the table
        offsets.append((r["_pid"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + r["b"], rows_before + r["n"]
    offs = rows.sparkSession.createDataFrame(offsets, "_pid int, _b long, _n long")
    inside = Window.partitionBy("_pid").orderBy(*[F.col(c).asc_nulls_first() for c in [*order, "_place"]])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (kept.join(F.broadcast(offs), "_pid")
            .withColumn("bytes_before", F.col("_b") + F.sum("size").over(upto) - F.col("size"))
            .withColumn("rows_before", F.col("_n") + F.row_number().over(inside) - 1)
            .withColumn("total_bytes", F.lit(bytes_before)).drop("_pid", "_b", "_n", "_place"))


def shard(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ...) without its text, with its shard and slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = prefix_sums(narrow, ["doc_id", "text_crc32", "size"])
    middle = (F.col("bytes_before") * 2 + F.col("size")) * F.lit(n_shards)
    placed = stored(placed.withColumn("shard", F.least(F.expr(f"{n_shards - 1}"),
                                                       F.floor(middle / (F.col("total_bytes") * 2))).cast("int")),
                    "shard-placed")
    first = placed.groupBy("shard").agg(F.min("rows_before").alias("_first"))  # n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("rows_before") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(without(table(spark, sf_dir, "documents"), *OUTPUT))
