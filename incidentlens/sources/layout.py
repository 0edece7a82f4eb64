"""Stores laid out for the reports: by month of the incident, and in buckets of the detail id.

``write_monthly`` partitions incidents, and what belongs to an incident, by the incident's month. A role or an action
names its detail by id, and that detail may belong to an incident of another month; so besides the details of a month's own
incidents, the store keeps the details that a month's roles and actions name. A report on some dates then reads the
files of their months and no others, and no detail is missed.

``write_bucketed`` saves the tables that meet by detail id in buckets of it, as catalog tables: the join of a
role or an action to its detail then needs no shuffle of the details, which are the larger side.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.terms import DateWindow
from .tables import SCHEMAS, SisTables

MONTH = "incident_month"
#: Tables whose rows belong to an incident.
OF_INCIDENTS = ("incident_detail", "incident_action", "incident_person_role")
#: Column that names a detail by its id.
NAMES_DETAIL = {"incident_action": "action_incident_detail_id", "incident_person_role": "role_incident_detail_id"}
#: Tables saved in buckets, and the column that deals them.
BUCKETED = {"incident_detail": "incident_detail_id", **NAMES_DETAIL}


def month_of(ts: Column | str) -> Column:
    """Year and month of a timestamp as one number, such as 199612."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def _number(day: dt.date) -> int:
    return day.year * 100 + day.month


def _write(df: DataFrame, path: str, spread: str, files: int) -> None:
    """Partitioned by month, every month dealt over ``files`` files by a hash of ``spread``."""
    deal = F.pmod(F.hash(spread), F.lit(files))
    df.repartition(MONTH, deal).write.partitionBy(MONTH).parquet(path)


def named_details(t: SisTables, months: DataFrame) -> DataFrame:
    """Details named by roles and actions, once for each month that names them, with the month and ``earlier_month``,
    the last one before it that names the same detail (NULL: none)."""
    named = None
    for name, column in NAMES_DETAIL.items():
        of = getattr(t, name).select("incident_id", F.col(column).alias("incident_detail_id")).join(months, "incident_id")
        named = of if named is None else named.unionByName(of)
    named = named.select("incident_detail_id", MONTH).where(f"incident_detail_id is not null and {MONTH} is not null").distinct()
    before = F.lag(MONTH).over(Window.partitionBy("incident_detail_id").orderBy(MONTH))
    named = named.withColumn("earlier_month", before)
    return t.incident_detail.join(named, "incident_detail_id").select(*SCHEMAS["incident_detail"].names, "earlier_month", MONTH)


def write_monthly(t: SisTables, path: str, files_per_month: int = 8) -> None:
    """Store ``t`` under ``path``: tables of incidents by month, all others as they are.

    ``incident_id`` is the key of incidents; rows of an unknown incident are stored without a month."""
    incident = t.incident.withColumn(MONTH, month_of("incident_ts"))
    _write(incident, f"{path}/incident", "incident_id", files_per_month)
    months = incident.select("incident_id", MONTH)
    for name in OF_INCIDENTS:
        _write(getattr(t, name).join(months, "incident_id", "left"), f"{path}/{name}", "incident_id", files_per_month)
    _write(named_details(t, months), f"{path}/named_detail", "incident_detail_id", files_per_month)
    for name in SCHEMAS:
        df = getattr(t, name)
        if name != "incident" and name not in OF_INCIDENTS and df is not None:
            df.write.parquet(f"{path}/{name}")


def monthly_tables(spark: SparkSession, path: str, window: DateWindow) -> SisTables:
    """The tables of a monthly store for reports within ``window``: what belongs to incidents is read from the files of the
    window's months only. ``incident_detail`` itself stays whole, for steps that go by neither."""
    first, last = _number(window.date(window.start)), _number(window.date(window.end))

    def read(name: str, schema: str, **more: str) -> DataFrame:
        extra = "".join(f", {c} {kind}" for c, kind in more.items())
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[schema])
        return spark.read.schema(f"{columns}{extra}, {MONTH} int").parquet(f"{path}/{name}")

    within = F.col(MONTH).between(first, last)
    only = {n: read(n, n).where(within).select(*SCHEMAS[n].names) for n in ("incident", *OF_INCIDENTS)}
    # a detail that several of the months name is read in the first of them
    named = read("named_detail", "incident_detail", earlier_month="int").where(within)
    named = named.where(F.col("earlier_month").isNull() | (F.col("earlier_month") < first)).select(*SCHEMAS["incident_detail"].names)
    others = SisTables.from_parquet_dir(spark, path)
    return replace(others, incident=only["incident"], incident_action=only["incident_action"],
                   incident_person_role=only["incident_person_role"], own_detail=only["incident_detail"], named_detail=named)


def write_bucketed(t: SisTables, database: str, path: str, buckets: int = 64) -> None:
    """Save ``t`` as catalog tables of ``database`` with files under ``path``; those that meet by detail id in buckets of it."""
    for name in SCHEMAS:
        df = getattr(t, name)
        if df is None:
            continue
        writer = df.write
        if name in BUCKETED:
            key = BUCKETED[name]
            deal = F.coalesce(F.col(key), F.xxhash64("incident_id"))  # rows without an id are dealt over all tasks
            writer = df.repartition(buckets, deal).write.bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{path}/{name}").saveAsTable(f"{database}.{name}")
