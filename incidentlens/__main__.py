"""Run one report as a Spark job and write it under its display labels.

    spark-submit --py-files incidentlens.zip run_report.py --tables /data/sis --scope school:7 \\
        --start 09/01/2024 --end 06/30/2025 --date-format MM/dd/yyyy --detailed --out /reports/school7

``--tables`` is a folder with one Parquet dataset per SIS table, or ``catalog:<db>[:<ps_db>]``
for catalog tables. ``--scope`` is ``district``, ``school:<id>`` or ``selection:<path>`` (a
Parquet dataset with a ``dcid`` column: the chosen students).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators.scope import District, School, Scope, Selection
from .operators.terms import DateWindow
from .plans.report import export, incident_report
from .session import apply_large_input_conf, apply_report_conf
from .sources.tables import SisTables


def parse_scope(spark: SparkSession, text: str) -> Scope:
    kind, _, arg = text.partition(":")
    if kind == "district":
        return District()
    if kind == "school":
        return School(int(arg))
    if kind == "selection":
        return Selection(spark.read.parquet(arg).select("dcid"))
    raise ValueError(f"unknown scope {text!r}")


def load_tables(spark: SparkSession, text: str) -> SisTables:
    if text.startswith("catalog:"):
        parts = text.split(":")
        return SisTables.from_catalog(spark, parts[1] or None, parts[2] if len(parts) > 2 else "ps")
    return SisTables.from_parquet_dir(spark, text)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="incidentlens", description=__doc__.split("\n")[0])
    p.add_argument("--tables", required=True)
    p.add_argument("--scope", default="district")
    p.add_argument("--start", required=True)
    p.add_argument("--end", required=True)
    p.add_argument("--date-format", default="yyyy-MM-dd")
    p.add_argument("--detailed", action="store_true")
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--mode", default="errorifexists")
    p.add_argument("--large", action="store_true", help="partition sizing for very large inputs (see session.py)")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("incidentlens").getOrCreate()
    apply_report_conf(spark)
    if args.large:
        apply_large_input_conf(spark)
    t = load_tables(spark, args.tables)
    scope = parse_scope(spark, args.scope)
    report = incident_report(t, scope, DateWindow(args.start, args.end, args.date_format), detailed=args.detailed)
    export(report, args.out, args.format, args.mode)


if __name__ == "__main__":
    main()
