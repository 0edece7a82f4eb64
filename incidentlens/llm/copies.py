"""Exact deduplication by two passes of a Bloom filter, DataFrame functions only.

The first pass hashes every key to ``PLACES`` cells and counts the keys of each cell; cells that
two or more rows hit form the filter, a bitmap. The second pass looks every row up in it: a key
that some other row has too has all its cells there, so a row with a cell missing is unlike any other
and passes straight through. Only the rest is shuffled by key and grouped; a chance hit is a group of one.

The filter has ``BITS_PER_ROW`` bits per row and place, at most ``MAX_BITS`` (32 MB), the proven
bound of what is broadcast. A table too large for that fills the filter, more rows take the
second way, and the result is the same. What is counted in the first pass are cell numbers, with
partial aggregation, never texts.

A group that holds more than 1 / ``HOT_SHARE`` of the rows is broadcast to them (there are fewer than
``HOT_SHARE`` such groups), so no task receives a large group; all others meet their rows in a shuffle.

Defined results: NULL and empty texts are equal to each other; of equal texts the row with the
largest doc_id stays, NULL being smaller than all; of rows that repeat both, exactly one stays (which
is not told apart); an empty table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Cells of a key, and bits of the filter per row and place.
PLACES, BITS_PER_ROW = 2, 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
#: Groups with more than this part of all rows are broadcast.
HOT_SHARE = 4096


def text_digest(text: Column | str) -> Column:
    """SHA-256 (lower-case hex) of the text in UTF-8 with A-Z lower-cased; NULL counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER).cast("binary"), 256)


def filter_bits(rows: int) -> int:
    """Bits of one place of the filter: a power of two that fits the rows, within the bounds."""
    bits = MIN_BITS
    while bits < rows * BITS_PER_ROW and bits < MAX_BITS // PLACES:
        bits *= 2
    return bits


def _cells(key: str, bits: int) -> list[Column]:
    """Cell numbers (from 1) of a key, each place in a range of its own."""
    return [F.pmod(F.xxhash64(F.col(key), F.lit(p)), F.lit(bits)) + F.lit(p * bits + 1) for p in range(PLACES)]


def repeat_filter(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap) of the cells that are hit twice or more."""
    cells = rows.select(F.explode(F.array(*_cells(key, bits))).alias("cell"))
    hit = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    return (hit.groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap")))


def key_filter(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap) of the cells of all keys of ``rows``."""
    cells = rows.select(F.explode(F.array(*_cells(key, bits))).alias("cell")).distinct()
    return (cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap")))


def with_verdict(rows: DataFrame, key: str, bits: int, repeats: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: all cells of the key are in the filter."""
    found = F.lit(True)
    for p, cell in enumerate(_cells(key, bits)):
        side = F.broadcast(repeats.select(F.col("bucket").alias(f"_bucket{p}"), F.col("bitmap").alias(f"_bits{p}")))
        rows = rows.withColumn(f"_cell{p}", cell)
        rows = rows.join(side, F.bitmap_bucket_number(f"_cell{p}") == F.col(f"_bucket{p}"), "left")
        at = F.bitmap_bit_position(f"_cell{p}")
        byte = F.substring(F.col(f"_bits{p}"), F.floor(at / 8).cast("int") + 1, F.lit(1))
        bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int"))
        found = found & F.coalesce(bit == 1, F.lit(False))
    rows = rows.withColumn("_maybe", found)
    return rows.drop(*[f"_{x}{p}" for p in range(PLACES) for x in ("cell", "bucket", "bits")])


def mark_repeats(rows: DataFrame, key: str, id_: str, row: str) -> DataFrame:
    """``rows`` with keep_id, group_size and kept: of the rows of one key, that of the largest ``id_`` is kept.

    ``row`` is a column that tells rows of one key and id apart and reads alike every time."""
    total = rows.count()
    bits = filter_bits(total)
    repeats = stored(repeat_filter(rows, key, bits), "copies-filter")
    told = with_verdict(rows, key, bits, repeats)
    single = (told.where("not _maybe").drop("_maybe")
              .withColumn("keep_id", F.col(id_)).withColumn("group_size", F.lit(1).cast("long")).withColumn("kept", F.lit(True)))
    groups = stored(told.where("_maybe").groupBy(key)
                    .agg(F.max(F.struct(F.col(id_).alias("id"), F.col(row).alias("row"))).alias("stays"), F.count("*").alias("size")),
                    "copies-groups")
    hot = F.col("size") * HOT_SHARE > F.lit(total)
    side = groups.withColumnRenamed(key, "_key")
    largest = F.broadcast(side.where(hot).select("_key", F.col("stays").alias("_stays"), F.col("size").alias("_size")))
    several = told.where("_maybe").drop("_maybe").join(largest, F.col(key) == F.col("_key"), "left").drop("_key")
    done = lambda df: (df.withColumn("keep_id", F.col("_stays.id")).withColumn("group_size", F.col("_size"))
                       .withColumn("kept", F.col("_stays.row") == F.col(row)).drop("_stays", "_size"))
    rest = (several.where("_size is null").drop("_stays", "_size")
            .join(side.where(~hot).select("_key", F.col("stays").alias("_stays"), F.col("size").alias("_size")),
                  F.col(key) == F.col("_key")).drop("_key"))
    return single.unionByName(done(several.where("_size is not null"))).unionByName(done(rest))


def exact_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text, ...)."""
    digests = docs.select("doc_id", text_digest("text").alias("text_sha256"), F.monotonically_increasing_id().alias("_row"))
    marked = mark_repeats(stored(digests, "copies-digests"), "text_sha256", "doc_id", "_row")
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: texts shared with no other row pass straight through."""
    columns = docs.columns
    rows = docs.withColumn("_key", text_digest("text"))
    bits = filter_bits(docs.count())
    repeats = stored(repeat_filter(rows.select("_key"), "_key", bits), "copies-filter")
    told = with_verdict(rows, "_key", bits, repeats)
    # the largest id of each key first, in a narrow aggregation; then one row of it
    stays = stored(told.where("_maybe").groupBy("_key").agg(F.max("doc_id").alias("_id")), "copies-groups")
    kept = told.where("_maybe").join(stays.withColumnRenamed("_key", "_k"), (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return told.where("not _maybe").select(columns).unionByName(kept.dropDuplicates(["_key"]).select(columns))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON g.text_sha256 = d.text_sha256"""


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_copies(without(table(spark, sf_dir, "documents"), "keep_id", "group_size", "kept", "text_sha256"))
