"""Manifest of an exported report: its part files in report order, with row counts and first and last keys.

A sorted report is written as one file per range of rows, so a reader that wants the whole report in order needs to
know the order of the files. ``write_manifest`` reads the written files once and adds one row per file under
``<path>/_manifest`` (a folder that Spark's readers skip). A part's number, rows and keys come from its content, never
from names that a job makes up; parts are cut by the bounds of the sort, which a rerun task finds again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes

#: The columns of the report order that the report shows.
KEYS = ("incident_ts", "incident_link", "incident_title", "student_link", "state_id", "school_abbreviation")
_READ = {"csv": {"header": "true", "multiLine": "true"}, "parquet": {}}


def read_parts(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    """The exported rows with ``part``, the number of their file (order within a file is kept, see ``place``)."""
    if fmt not in _READ:
        raise ValueError(f"unsupported export format {fmt!r}")
    df = spark.read.format(fmt).options(**_READ[fmt]).load(path)
    name = F.col("_metadata.file_name")
    part = F.regexp_extract(name, r"part-(\d+)", 1).cast("long") * 1_000_000
    part = part + F.coalesce(F.nullif(F.regexp_extract(name, r"-c(\d+)", 1), F.lit("")).cast("long"), F.lit(0))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", part.alias("part"), name.alias("file"), place.alias("place"))


def manifest_of(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """(position, file, n_rows, first_row, first_key, last_key) per part file, ``position`` from 1 in report order and
    ``first_row`` the position of its first row in the report."""
    rows = read_parts(spark, path, fmt)
    key = F.struct(*[F.col(f"`{codes.COLUMN_LABELS[c]}`").alias(c) for c in KEYS])
    files = rows.groupBy("part", "file").agg(F.count("*").alias("n_rows"), F.min_by(key, "place").alias("first_key"),
                                             F.max_by(key, "place").alias("last_key"))
    # one row per file from here on
    order = Window.orderBy("part")
    before = F.coalesce(F.sum("n_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.select(F.row_number().over(order).cast("long").alias("position"), "file", "n_rows", (before + 1).alias("first_row"),
                        "first_key", "last_key")


def write_manifest(spark: SparkSession, path: str, fmt: str = "csv") -> None:
    """Add the manifest to an exported report (JSON, one line per part file)."""
    manifest_of(spark, path, fmt).coalesce(1).sortWithinPartitions("position").write.mode("overwrite").json(f"{path}/_manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    key = ", ".join(f"{c}: string" for c in KEYS)
    return spark.read.schema(f"position long, file string, n_rows long, first_row long, first_key struct<{key}>, last_key struct<{key}>"
                             ).json(f"{path}/_manifest")


def with_positions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The exported rows under the report's column names, with ``report_pos``, their position in the report (from 1)."""
    files = read_manifest(spark, path).select("file", "first_row")
    rows = read_parts(spark, path, fmt).join(files, "file")
    place = Window.partitionBy("file").orderBy("place")
    shown = {label: c for c, label in codes.COLUMN_LABELS.items()}
    return rows.select(*[F.col(f"`{c}`").alias(shown[c]) for c in rows.columns if c in shown],
                       (F.row_number().over(place) + F.col("first_row") - 1).alias("report_pos"))


def read_rows(spark: SparkSession, path: str, first: int, last: int, fmt: str = "csv") -> DataFrame:
    """Rows ``first`` to ``last`` of the report (from 1), in order, reading only the files that hold them."""
    parts = read_manifest(spark, path).where((F.col("first_row") <= last) & (F.col("first_row") + F.col("n_rows") > first)).collect()
    if not parts:
        return spark.read.format(fmt).options(**_READ[fmt]).load(path).limit(0)
    start = {p["file"]: p["first_row"] for p in parts}
    rows = read_parts(spark, [f"{path}/{f}" for f in start], fmt)
    shift = F.create_map(*[F.lit(x) for kv in start.items() for x in kv])
    order = Window.partitionBy("file").orderBy("place")
    rows = rows.withColumn("_at", F.row_number().over(order) + shift[F.col("file")] - 1)
    return rows.where(F.col("_at").between(first, last)).orderBy("_at").drop("_at", "part", "file", "place")
