"""Mixing sources to target weights by capped water-filling.

Each source has a weight and a ceiling of ``max_epochs`` times its own size. Sources whose
share of the goal lies above their ceiling are clamped to it and the excess is shared again by
weight among the rest until nobody is above. A document is taken floor(target / size) times,
and once more if it belongs to the seeded fraction that fills the remainder.

Defined results: a NULL or empty text has size 0 and is taken like any other document of its
source; a NULL source is a source of its own, ordered last; an empty table gives an empty
result; repeated rows count each time; input columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, table, without

#: Hash buckets that one source is cut into to find where its fraction ends: only the rows of
#: one bucket (1/4096 of a source) are ever put in order.
BUCKETS = 4096


def source_order(sources: DataFrame) -> DataFrame:
    """Add ``position`` (0-based, by code point, NULL last) to a table of distinct sources.

    Sorted over partitions; only one row count per partition meets in one place."""
    placed = stored(sources.orderBy(F.col("source").asc_nulls_last())
                    .withColumn("_pid", F.spark_partition_id()), "source-order")
    sizes = sorted((r["_pid"], r["n"]) for r in placed.groupBy("_pid").agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for pid, n in sizes:
        offsets.append((pid, before))
        before += n
    offs = sources.sparkSession.createDataFrame(offsets, "_pid int, _before long")
    inside = Window.partitionBy("_pid").orderBy(F.col("source").asc_nulls_last())
    return (placed.join(F.broadcast(offs), "_pid")
            .withColumn("position", F.col("_before") + F.row_number().over(inside) - 1).drop("_pid", "_before"))


def water_level(sources: DataFrame, goal: float) -> float:
    """The level L with sum(min(cap, L * weight)) = goal, found by clamping and sharing again.

    One one-row aggregate over the source table per round; the clamped set only grows, so the
    rounds end when it stays the same (infinite level: every source is clamped)."""
    level, clamped = 0.0, -1
    while True:
        full = (F.col("cap") <= F.lit(level) * F.col("weight")) if level else F.lit(False)
        row = sources.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("cap"),
                          F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if row["n"] == clamped:
            return level
        if not row["weight"]:
            return math.inf
        clamped, level = row["n"], max(0.0, goal - (row["cap"] or 0.0)) / row["weight"]
        if level == 0.0:
            return level


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0,
        seed: int = 17) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source, ...) with ``size`` (words), ``source_size``,
    ``target`` (of its source), ``times`` (how often the mix takes it) and ``taken`` (words).

    The goal is ``share`` of all sizes; sources in order get ``weights``, repeating. Texts never
    move: only per-source sums and the rows of one bucket per source are shuffled."""
    # a hash that every SQL engine has: the first 60 bits of an MD5
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), 1, 15), 16, 10).cast("long")
    if "size" not in docs.columns or "text" in docs.columns:
        docs = without(docs, "size").withColumn("size", n_words("text"))
    rows = (without(docs, "source_size", "target", "times", "taken")
            .withColumn("_mix_h", h).withColumn("_mix_bucket", F.pmod("_mix_h", F.lit(BUCKETS)).cast("int")))
    # the source table: one row per source and bucket, then per source
    cells = stored(rows.groupBy("source", "_mix_bucket").agg(F.sum("size").alias("words")), "mix-cells")
    sources = source_order(cells.groupBy("source").agg(F.sum("words").alias("source_size")))
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    sources = stored(sources.withColumn("weight", F.element_at(pattern, (F.col("position") % len(weights) + 1).cast("int")))
                     .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))), "mix-sources")
    goal = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, goal)
    target = F.col("cap") if math.isinf(level) else F.least("cap", F.lit(level) * F.col("weight"))
    sources = (sources.withColumn("target", target)
               .withColumn("_mix_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
               .withColumn("_mix_rest", F.col("target") - F.col("_mix_whole") * F.col("source_size")))
    # the bucket of each source in which its fractional repetition ends
    run = Window.partitionBy("source").orderBy("_mix_bucket")
    upto = cells.withColumn("_upto", F.sum("words").over(run))
    ends = (upto.alias("c").join(sources.alias("s"), F.expr("c.source <=> s.source"))
            .select("s.source", "s.source_size", "s.target", "s._mix_whole", "s._mix_rest", "c._mix_bucket", "c._upto", "c.words"))
    ends = (ends.groupBy("source", "source_size", "target", "_mix_whole", "_mix_rest")
            .agg(F.max(F.when(F.col("_upto") <= F.col("_mix_rest"), F.col("_mix_bucket"))).alias("_mix_last"),
                 F.max(F.when(F.col("_upto") <= F.col("_mix_rest"), F.col("_upto"))).alias("_mix_filled"),
                 F.min(F.when(F.col("_upto") > F.col("_mix_rest"), F.col("_mix_bucket"))).alias("_mix_edge")))
    ends = stored(ends.withColumn("_mix_last", F.coalesce("_mix_last", F.lit(-1)))
                  .withColumn("_mix_filled", F.coalesce("_mix_filled", F.lit(0)).cast("double"))
                  .withColumnRenamed("source", "_mix_source"), "mix-ends")
    rows = rows.join(ends, F.expr("source <=> _mix_source"), "left")
    on_edge = F.coalesce(F.col("_mix_bucket") == F.col("_mix_edge"), F.lit(False))
    # inside the edge bucket: take documents in hash order while that brings the sum nearer
    order = Window.partitionBy("source").orderBy("_mix_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = rows.where(on_edge).withColumn(
        "_mix_more", (F.col("_mix_filled") + before + F.col("size") / 2 < F.col("_mix_rest")).cast("long"))
    plain = rows.where(~on_edge).withColumn(
        "_mix_more", ((F.col("_mix_rest") > 0) & (F.col("_mix_bucket") <= F.col("_mix_last"))).cast("long"))
    out = plain.unionByName(edge).withColumn("times", F.coalesce(F.col("_mix_whole") + F.col("_mix_more"), F.lit(0)))
    out = out.withColumn("taken", F.col("times") * F.col("size"))
    return out.drop(*[c for c in out.columns if c.startswith("_mix_")])


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix`` as often as it is taken."""
    copies = F.explode(F.expr("sequence(1, times)"))
    return mixed.where("times > 0").withColumn("_copy", copies).drop("_copy")


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('17:' || doc_id), 1, 15))::BIGINT AS h
  FROM documents),
src AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, [5.0::DOUBLE, 2.0, 1.0][1 + pos % 3] AS weight FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos
    FROM sized GROUP BY source)),
levels AS (  -- the level if exactly the sources with the smallest cap by weight are clamped
  SELECT (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM src) - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0))
      / sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight) AS level, any_value(a.cap / a.weight) AS upto
  FROM src a, src b GROUP BY a.source, a.pos),
fit AS (SELECT arg_min(level, upto) AS level FROM levels WHERE level < upto),
aims AS (SELECT s.*, least(cap, coalesce(level, 'infinity'::DOUBLE) * weight) AS target FROM src s, fit),
rates AS (SELECT *, floor(target / greatest(source_size, 1))::BIGINT AS whole,
    target - floor(target / greatest(source_size, 1)) * source_size AS rest FROM aims),
rows_ AS (
  SELECT d.*, r.source_size, r.target, r.whole, r.rest, d.h % {BUCKETS} AS bucket,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h % {BUCKETS}) AS upto_bucket,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h % {BUCKETS}, d.h, d.doc_id, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
marked AS (
  SELECT *, min(bucket) FILTER (upto_bucket > rest) OVER (PARTITION BY source) AS edge FROM rows_),
told AS (
  SELECT *, whole + CASE WHEN bucket = edge THEN (before + size / 2.0 < rest)::BIGINT
    ELSE (rest > 0 AND upto_bucket <= rest)::BIGINT END AS times FROM marked)
SELECT doc_id, size, source_size, target, (times * size)::BIGINT AS taken, times FROM told"""


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words("text").alias("size"))
    mixed = mix(stored(docs, "mix-sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "times")
