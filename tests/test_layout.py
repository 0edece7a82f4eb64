"""Stores by month and in buckets, reports in a batch, exports with a manifest, and counts of what is left out."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest

from incidentlens.operators.scope import District, School, Selection
from incidentlens.operators.terms import DateWindow
from incidentlens.functions import codes
from incidentlens.plans import catalog, manifest, report, steps
from incidentlens.plans.batch import ReportBatch
from incidentlens.plans.watch import ReportWatch
from incidentlens.sources import layout
from incidentlens.sources.tables import SisTables

from .conftest import SF_SMALL
from .test_plans import _tree, at_scale, plan_of  # noqa: F401 - a fixture

WINDOW = DateWindow(dt.date(2020, 9, 1), dt.date(2021, 6, 30))
D, TS = dt.date, dt.datetime


def rows(df):
    return [tuple(r) for r in df.collect()]


def spoil_other_months(path, keep):
    """Replace the files of all months but ``keep`` by text that is no Parquet file."""
    n = 0
    for folder, _, files in os.walk(path):
        if layout.MONTH in folder and not any(f"{layout.MONTH}={m}" in folder for m in keep):
            for f in files:
                with open(f"{folder}/{f}", "w") as out:
                    out.write("not a table")
                n += 1
    return n


@pytest.mark.parametrize("detailed", [False, True])
def test_one_month_reads_only_its_files(spark, tmp_path, detailed):
    t = catalog.tables(spark, SF_SMALL)
    layout.write_monthly(t, f"{tmp_path}/store", files_per_month=1)
    window = DateWindow(dt.date(1997, 3, 1), dt.date(1997, 3, 31))
    want = [rows(report.incident_report(t, s, window, detailed=detailed)) for s in (District(), School(7), Selection())]
    assert want[0] and spoil_other_months(tmp_path / "store", [199703]) > 100
    stored = layout.monthly_tables(spark, f"{tmp_path}/store", window)
    assert [rows(report.incident_report(stored, s, window, detailed=detailed)) for s in (District(), School(7), Selection())] == want
    plan = plan_of(report.incident_report(stored, District(), window))
    scans = [b for b in plan.split("\n\n") if "Scan parquet" in b.split("\n")[0] and "incident_id" in b.split("Output")[-1]]
    assert scans and all(f"{layout.MONTH}" in b.split("PartitionFilters")[1].split("\n")[0] for b in scans)


def test_details_of_other_months_are_found(make_tables, spark, tmp_path):
    """A role and an action of May name details of an incident of March; April and May name one detail."""
    t = make_tables(
        incident=[(k, f"I{k}", TS(2021, k, 5), 3, 100, 101) for k in (3, 4, 5)] + [(9, "no day", None, 3, 100, 101)],
        incident_detail=[(10 * k + 1, k, 10, None) for k in (3, 4, 5)] + [(37, 3, 21, None), (38, 3, 30, 501), (99, None, 20, None)],
        incident_action=[(4, 38, "x", None, None, 1, 1), (5, 38, "y", None, None, 1, 1), (5, None, "z", None, None, 1, 1), (77, 38, "q", None, None, 1, 1)],
        incident_person_role=[(4, 7, 37), (5, 7, 37), (5, 8, 99), (3, 8, None), (77, 7, 37)])
    layout.write_monthly(t, f"{tmp_path}/store", files_per_month=2)
    for first, last in ((4, 4), (5, 5), (4, 5)):
        window = DateWindow(dt.date(2021, first, 1), dt.date(2021, last, 28))
        stored = layout.monthly_tables(spark, f"{tmp_path}/store", window)
        want = rows(report.incident_report(t, District(), window, detailed=True))
        assert rows(report.incident_report(stored, District(), window, detailed=True)) == want and want
        named = stored.named_detail.groupBy("incident_detail_id").count().where("count > 1")
        assert named.count() == 0


def test_bucketed_details_are_not_shuffled(spark, tmp_path, at_scale):  # noqa: F811
    t = catalog.tables(spark, SF_SMALL)
    spark.sql(f"CREATE DATABASE buckets LOCATION '{tmp_path}/db'")
    try:
        layout.write_bucketed(t, "buckets", f"{tmp_path}/tables", buckets=8)
        b = SisTables.from_catalog(spark, "buckets", "buckets")
        for scope in (School(7), District()):
            df = report.incident_report(b, scope, catalog.WINDOW)
            tree, met = _tree(df), 0
            for at, (depth, line) in enumerate(tree):
                if "Scan parquet" not in line or "buckets.incident_detail[incident_detail_id" not in line:
                    continue
                for d, above in reversed(tree[:at]):  # from the scan up to its join
                    if d < depth:
                        depth = d
                        assert "Exchange" not in above
                        if "SortMergeJoin" in above:
                            met += 1
                            break
            assert met == 2  # roles and actions
            assert rows(df) == rows(report.incident_report(t, scope, catalog.WINDOW)) != []
    finally:
        spark.sql("DROP DATABASE buckets CASCADE")


def test_batch_gives_the_same_reports_and_leaves_nothing(spark):
    t = catalog.tables(spark, SF_SMALL)
    with ReportBatch(t, catalog.WINDOW) as batch:
        for scope in (Selection(), School(7), District()):
            for detailed in (False, True):
                df = batch.report(scope, detailed)
                assert rows(df) == rows(report.incident_report(t, scope, catalog.WINDOW, detailed=detailed)) != []
                plan = plan_of(df)
                assert batch.path in plan.replace("file:", "") and "incident_action" not in plan
        path = batch.path
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    with ReportBatch(t, catalog.WINDOW, detailed=False) as batch, pytest.raises(ValueError, match="without the details"):
        batch.report(District(), detailed=True)


def test_a_failed_batch_leaves_nothing(spark, make_tables, monkeypatch):
    t = make_tables()
    made = []
    monkeypatch.setattr(ReportBatch, "close", lambda self, close=ReportBatch.close: (made.append(self.path), close(self)))
    monkeypatch.setattr("incidentlens.plans.batch.students.student_facts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ReportBatch(t, WINDOW)
    assert made and not os.path.exists(made[0])


def test_batch_is_cheaper_than_separate_reports(spark):
    t = catalog.tables(spark, "/root/testdata/sf0.01")
    scopes = [(s, d) for s in (Selection(), School(7), District()) for d in (False, True)]
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    for s, d in scopes:
        noop(report.incident_report(t, s, catalog.WINDOW, detailed=d))
    start = time.perf_counter()
    for s, d in scopes:
        noop(report.incident_report(t, s, catalog.WINDOW, detailed=d))
    apart = time.perf_counter() - start
    start = time.perf_counter()
    with ReportBatch(t, catalog.WINDOW) as batch:
        for s, d in scopes:
            noop(batch.report(s, d))
    together = time.perf_counter() - start
    print(f"apart {apart:.1f} s, together {together:.1f} s")
    assert together < apart


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_manifest_gives_the_report_in_order(spark, tmp_path, fmt):
    t = catalog.tables(spark, SF_SMALL)
    df = report.incident_report(t, District(), catalog.WINDOW)
    want = [tuple(v if v != "" else None for v in r) for r in rows(df)]
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name in ("one", "two"):
            report.export(df, f"{tmp_path}/{name}", fmt, manifest=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
    got = manifest.read_manifest(spark, f"{tmp_path}/one").orderBy("position").collect()
    assert len(got) > 1 and [r["position"] for r in got] == list(range(1, len(got) + 1))
    assert sum(r["n_rows"] for r in got) == len(want)
    back = []
    for r in got:
        part = spark.read.format(fmt).options(**manifest._READ[fmt]).load(f"{tmp_path}/one/{r['file']}")
        part = rows(part.select(*[f"`{codes.COLUMN_LABELS[c]}`" for c in codes.BASE_COLUMNS]))
        assert r["first_row"] == len(back) + 1 and len(part) == r["n_rows"]
        for key, row in ((r["first_key"], part[0]), (r["last_key"], part[-1])):
            assert tuple(key) == tuple(row[codes.BASE_COLUMNS.index(c)] for c in manifest.KEYS)
        back += part
    assert back == want
    again = manifest.read_manifest(spark, f"{tmp_path}/two").orderBy("position").collect()
    assert [tuple(r)[2:] for r in again] == [tuple(r)[2:] for r in got]
    some = manifest.read_rows(spark, f"{tmp_path}/one", 40, 333, fmt)
    assert rows(some.select(*[f"`{codes.COLUMN_LABELS[c]}`" for c in codes.BASE_COLUMNS])) == want[39:333]
    assert manifest.read_rows(spark, f"{tmp_path}/one", 10 ** 9, 10 ** 9, fmt).count() == 0
    assert len([json.loads(x) for f in os.listdir(tmp_path / "one" / "_manifest") if f.endswith(".json")
                for x in open(tmp_path / "one" / "_manifest" / f)]) == len(got)


def test_watch_counts_what_is_left_out(make_tables):
    t = make_tables(
        incident=lambda r: r + [(2, "Lost", TS(2020, 10, 6), 99, 100, 101), (3, "No school", TS(2020, 10, 6), None, 100, 101),
                                (4, "Twice", TS(2020, 10, 6), 3, 100, 101), (4, "Twice", TS(2020, 10, 6), 3, 100, 101),
                                (5, "Out of range", TS(2019, 10, 6), 99, 100, 101), (6, "No type", TS(2020, 10, 6), 99, 100, 101)],
        incident_detail=lambda r: r + [(20 + k, k, 10, None) for k in (2, 3, 4, 5)],
        incident_person_role=lambda r: r + [(1, 70, 12), (1, 71, None), (2, 7, None), (5, 70, None), (4, 8, 12), (4, None, 12)],
        students=lambda r: r + [(8, 1008, 5008, "S8", "Roe, Rick", 4, D(2011, 3, 4), None, "City", "MA", "02000")])
    watch = ReportWatch()
    watched = rows(report.incident_report(t, District(), WINDOW, watch=watch))
    assert watched == rows(report.incident_report(t, District(), WINDOW)) != []
    assert watch.counts() == {"unknown_school": 2, "repeated_incidents": 1, "repeated_students": 1, "unknown_students": 3}
    watch = ReportWatch()
    report.incident_report(t, School(3), WINDOW, watch=watch).collect()
    assert watch.counts() == {"unknown_school": 1, "repeated_incidents": 0, "repeated_students": 0}


def test_steps_are_unchanged_by_a_monthly_store(spark, tmp_path, make_tables):
    t = make_tables()
    layout.write_monthly(t, f"{tmp_path}/store")
    stored = layout.monthly_tables(spark, f"{tmp_path}/store", WINDOW)
    for step in (steps.person_role, steps.action_code, steps.incident_location):
        assert rows(step(stored)) == rows(step(t))
