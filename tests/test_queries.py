"""Registered queries against their DuckDB oracles, plus report properties, on sf0.001."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from incidentlens.checks.compare import compare, duck_connect
from incidentlens.operators.scope import District
from incidentlens.plans import catalog, report

from .conftest import SF_SMALL

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 40
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_fixtures_tell_right_from_wrong(spark):
    """Shared student numbers, schools and staff listed twice, duplicate selections, students without dcid."""
    t = catalog.tables(spark, SF_SMALL)
    twice = lambda df, c: df.groupBy(c).count().where("count > 1").count() > 0
    assert twice(t.students, "student_number") and twice(t.schools, "school_number") and twice(t.teachers, "id")
    assert twice(t.current_selection, "dcid") and t.students.where("dcid is null").count() > 0
    sf = "/root/testdata/sf0.01"
    ranked = QUERIES["ranked_results"](spark, sf)
    assert ranked.where("row_num > 1").count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], con)
    assert r["names_ok"], (r["spark_schema"], r["duck_schema"])
    assert r["types_ok"], (r["spark_schema"], r["duck_schema"])
    assert r["rows_spark"] == r["rows_duck"]
    assert r["values_ok"], (r["only_spark"], r["only_duck"])


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["student_link", "state_id", "dob"]
    assert df.count() > 0


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_one_row_per_incident_and_student_number(spark):
    t = catalog.tables(spark, SF_SMALL)
    rows = report.report_rows(t, District(), catalog.WINDOW)
    assert rows.groupBy("incident_id", "student_number").count().where("count > 1").count() == 0


def test_scoped_reports_are_subsets_of_district(spark):
    district = _bag(QUERIES["report_district"](spark, SF_SMALL))
    for name in ("report_school", "report_selection"):
        part = _bag(QUERIES[name](spark, SF_SMALL))
        assert part and not (part - district)


def test_result_independent_of_shuffle_partitions(spark):
    base = _bag(QUERIES["report_district_detailed"](spark, SF_SMALL))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _bag(QUERIES["report_district_detailed"](spark, SF_SMALL))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = _bag(QUERIES["report_district_detailed"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == one == many


def test_report_is_sorted_and_position_matches(spark):
    df = QUERIES["report_district"](spark, SF_SMALL)
    ordered = [tuple(r) for r in df.collect()]
    placed = QUERIES["report_order"](spark, SF_SMALL).orderBy("report_pos").collect()
    assert [r["report_pos"] for r in placed] == list(range(1, len(ordered) + 1))
    assert [tuple(r)[:-1] for r in placed] == ordered


def test_labelled_export(spark, tmp_path):
    df = QUERIES["report_school"](spark, SF_SMALL)
    report.export(df, str(tmp_path / "csv"), "csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns[:3] == ["Student Number", "State ID", "SPED"]
    assert back.count() == df.count()


def test_command_line_job(spark, tmp_path):
    from incidentlens.__main__ import main

    t = catalog.tables(spark, SF_SMALL)
    t.write_parquet(str(tmp_path / "sis"))
    out = tmp_path / "out"
    main(["--tables", str(tmp_path / "sis"), "--scope", "school:7", "--start", "01/01/1996", "--end", "12/31/2000",
          "--date-format", "MM/dd/yyyy", "--out", str(out)], spark=spark)
    back = spark.read.option("header", True).csv(str(out))
    assert back.count() == QUERIES["report_school"](spark, SF_SMALL).count() > 0


def test_optional_tables_may_be_missing(spark, tmp_path):
    from incidentlens.sources.tables import REQUIRED_TABLES, SisTables

    t = catalog.tables(spark, SF_SMALL)
    for name in REQUIRED_TABLES:
        getattr(t, name).write.parquet(str(tmp_path / name))
    partial = SisTables.from_parquet_dir(spark, str(tmp_path))
    assert partial.person is None
    assert report.incident_report(partial, District(), catalog.WINDOW).count() > 0
    with pytest.raises(ValueError, match="studentcontactassoc"):
        report.incident_report(partial, District(), catalog.WINDOW, detailed=True)


def test_large_input_settings_keep_results(spark):
    from incidentlens.session import LARGE_INPUT_CONF, apply_large_input_conf

    base = _bag(QUERIES["report_school"](spark, SF_SMALL))
    saved = {k: spark.conf.get(k, None) for k in LARGE_INPUT_CONF}
    try:
        apply_large_input_conf(spark)
        assert _bag(QUERIES["report_school"](spark, SF_SMALL)) == base
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_catalog_loader_reads_views(spark):
    from incidentlens.sources.tables import REQUIRED_TABLES, SisTables

    t = catalog.tables(spark, SF_SMALL)
    for name in REQUIRED_TABLES:
        getattr(t, name).createOrReplaceTempView(name)
    try:
        from_views = SisTables.from_catalog(spark, database=None, ps_database=None)
        assert from_views.person is None
        assert _bag(report.incident_report(from_views, District(), catalog.WINDOW)) == \
            _bag(report.incident_report(t, District(), catalog.WINDOW))
    finally:
        for name in REQUIRED_TABLES:
            spark.catalog.dropTempView(name)


@pytest.mark.parametrize("n,parts", [(0, 3), (1, 1), (997, 7)])
def test_sort_position_is_dense_and_ordered(spark, n, parts):
    from incidentlens.operators.position import with_sort_position

    df = spark.range(n).repartition(parts).select((F.col("id") * 7 % 1000).alias("k"), F.col("id"))
    got = [(r["k"], r["id"], r["pos"]) for r in with_sort_position(df, [F.col("k").desc(), F.col("id")], "pos")
           .orderBy("pos").collect()]
    want = sorted(((r["k"], r["id"]) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(k, i) for k, i, _ in got] == want
    assert [p for _, _, p in got] == list(range(1, n + 1))
