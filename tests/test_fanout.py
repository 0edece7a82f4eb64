"""Factorised counts against the joined product, and the SQL steps with bound parameters."""

from __future__ import annotations

import datetime as dt

import pytest

from incidentlens.operators import fanout
from incidentlens.operators.scope import District, School, Selection
from incidentlens.operators.terms import DateWindow
from incidentlens.plans import sqlsteps, steps

WINDOW = DateWindow(dt.date(2020, 9, 1), dt.date(2021, 6, 30))
D, TS = dt.date, dt.datetime


def test_every_set_multiplies(make_tables):
    """Two terms (squared), two categories, two resolutions, three plans, codes with ties, two roles, two extension
    rows (cubed), two schools of one number, two names of one teacher."""
    t = make_tables(
        terms=lambda r: r + [(2, "Z", D(2020, 10, 1), D(2020, 12, 31), 0, 1), (3, "no", D(2020, 10, 1), D(2020, 12, 31), 0, 2)],
        incident_detail=lambda r: r + [(14, 1, 10, None), (15, 1, 30, 501), (16, 1, 30, None), (17, 1, 21, None)],
        incident_action=[(1, 13, "Resolved", None, None, 1, 1), (1, 15, None, None, None, 1, 1), (1, 16, None, None, None, 1, 1)],
        incident_lu_sub_code=lambda r: r + [(31, 500, "SUSP", "again")],
        incident_person_role=lambda r: r + [(1, 7, 17), (1, 8, 99)],
        u_def_ext_students=lambda r: r + [(1007, "no", None)],
        schools=lambda r: r + [(3, "NORTH 2")], teachers=lambda r: r + [(100, "Smith, A.")])
    got = {(r["student_number"]): (r["source_rows"], r["ties_at_first"]) for r in fanout.fanout_counts(t, District(), WINDOW).collect()}
    # terms 2 * 2, categories 2, resolutions 2 (one is NULL), plans 3, schools 2, creators 2, modifiers 1
    factor = 2 * 2 * 2 * 2 * 3 * 2 * 2
    student7, student8 = 2 * 2 * 2 ** 3, 1 * 1 * 1  # participations * roles * extension rows cubed
    assert got == {5007: (factor * student7 * 4, factor * student7 * 2), 5008: (factor * 4, factor * 2)}
    assert student8 == 1
    ranges = [(r["action_short_desc"], r["first_row"], r["last_row"]) for r in
              fanout.row_number_ranges(t, School(4), WINDOW).orderBy("first_row").collect()]
    assert ranges == [("SUSP", 1, 2 * factor), ("DET", 2 * factor + 1, 3 * factor), (None, 3 * factor + 1, 4 * factor)]


def test_midnight_of_a_terms_last_day(make_tables):
    late, midnight = TS(2020, 10, 5, 9, 0), TS(2020, 10, 5)
    for ts, n in ((late, 1), (midnight, 4)):
        t = make_tables(terms=lambda r: r + [(2, "Z", D(2020, 10, 1), D(2020, 10, 5), 0, 1)],
                        incident=[(1, "Fight", ts, 3, 100, 101)])
        assert [r["source_rows"] for r in fanout.fanout_counts(t, District(), WINDOW).collect()] == [n]


def test_no_group_without_a_source_row(make_tables):
    assert fanout.fanout_counts(make_tables(schools=[(4, "SOUTH")]), District(), WINDOW).count() == 0
    assert fanout.fanout_counts(make_tables(incident_action=[]), District(), WINDOW).collect()[0]["ties_at_first"] == 1
    t = make_tables()
    assert fanout.fanout_counts(t, Selection(t.students.where("dcid = 1008").select("dcid")), WINDOW).count() == 0


def test_products_beyond_64_bits_raise(spark, make_tables):
    many = spark.range(3_000_000).selectExpr("cast(1007 as long) studentsdcid", "'yes' sped", "'no' el")
    t = make_tables()
    t = type(t).from_frames({**{n: getattr(t, n) for n in t.__dataclass_fields__}, "u_def_ext_students": many})
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        fanout.fanout_counts(t, District(), WINDOW).collect()


def test_sql_steps_equal_the_frame_steps(make_tables):
    t = make_tables()
    args = sqlsteps.parameters("09/01/2020", "06/30/2021", "MM/dd/yyyy")
    want = steps.incident_date_range(t, DateWindow("09/01/2020", "06/30/2021", "MM/dd/yyyy"))
    assert sqlsteps.run(t, "incident_date_range", args).collect() == want.collect() != []
    assert (sqlsteps.run(t, "scope_school", sqlsteps.parameters(school_id="3")).collect()
            == steps.scope_students(t, School(3)).collect() != [])


@pytest.mark.parametrize("text", ["2020-09-01' OR 1=1 --", "'); DROP TABLE x", "", ":end_date", "{incident}", "2020-13-01"])
def test_hostile_dates_are_values(make_tables, text):
    t = make_tables()
    with pytest.raises(Exception, match="not a date of the form"):
        sqlsteps.run(t, "incident_date_range", sqlsteps.parameters(text, "2021-06-30")).collect()


def test_hostile_schools_and_missing_parameters(make_tables):
    t = make_tables()
    with pytest.raises(ValueError):
        sqlsteps.parameters(school_id="3 OR 1=1")
    assert sqlsteps.run(t, "scope_school", {"school_id": 99}).count() == 0
    with pytest.raises(ValueError, match="needs the parameters"):
        sqlsteps.run(t, "scope_school", {})
    with pytest.raises(ValueError, match="needs the parameters"):
        sqlsteps.run(t, "scope_school", {"school_id": 3, "start_date": "x"})
