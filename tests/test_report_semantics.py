
from __future__ import annotations

import datetime as dt

import pytest

from incidentlens.operators.scope import District, School, Selection
from incidentlens.operators.terms import DateWindow
from pyspark.sql import functions as F

from incidentlens.plans.report import incident_report

D, TS = dt.date, dt.datetime
WINDOW = DateWindow(D(2020, 9, 1), D(2021, 6, 30))


def rows(t, scope=None, window=WINDOW, detailed=False):
    return [r.asDict() for r in incident_report(t, scope or District(), window, detailed=detailed).collect()]


def test_base_row(make_tables):
    (r,) = rows(make_tables())
    assert r == {
        "student_link": "<a href=/admin/students/home.html?frn=0011007 target=_blank>5007</a>",
        "state_id": "S7", "sped_code": "Yes", "english_learner_code": "Former", "incident_ts": "2020-10-05",
        "incident_link": "<a href=/admin/incidents/incidentlog.html?id=1 target=_blank>1</a>",
        "incident_title": "Fight", "person_role": "Offender", "action_short_desc": "SUSP",
        "action_resolved_desc": "Resolved", "incident_category": "Violence", "action_plan_begin_dt": "10-06-2020",
        "action_plan_end_dt": "10-08-2020", "duration_assigned": "2", "duration_actual": "2",
        "created_by_name": "Smith, Ann", "last_modified_by_name": "Jones, Bob", "school_abbreviation": "NORTH"}


def test_range_end_is_midnight_of_last_day(make_tables):
    t = make_tables(incident=[(1, "a", TS(2020, 10, 5, 0, 0), 3, 100, 101), (2, "b", TS(2020, 10, 5, 10, 0), 3, 100, 101)],
                    incident_detail=lambda r: r + [(21, 2, 10, None), (22, 2, 20, None)],
                    incident_person_role=[(1, 7, 12), (2, 7, 22)])
    got = rows(t, window=DateWindow(D(2020, 9, 1), D(2020, 10, 5)))
    assert [r["incident_title"] for r in got] == ["a"]


def test_term_last_day_is_midnight_too(make_tables):
    t = make_tables(terms=[(1, "Y", D(2020, 9, 1), D(2020, 10, 5), 0, 1)],
                    incident=[(1, "a", TS(2020, 10, 5, 10, 0), 3, 100, 101)])
    assert rows(t) == []


def test_terms_filtered_to_district_full_year(make_tables):
    t = make_tables(terms=[(1, "SEM", D(2020, 9, 1), D(2021, 6, 30), 0, 2), (2, "SCH", D(2020, 9, 1), D(2021, 6, 30), 3, 1)])
    assert rows(t) == []


def test_overlapping_terms_do_not_duplicate(make_tables):
    t = make_tables(terms=lambda r: r + [(2, "OV", D(2020, 10, 1), D(2020, 12, 1), 0, 1)])
    assert len(rows(t)) == 1


def test_text_dates_with_format_and_bad_text_raises(make_tables):
    t = make_tables()
    assert len(rows(t, window=DateWindow("09/01/2020", "06/30/2021", "MM/dd/yyyy"))) == 1
    with pytest.raises(Exception):
        rows(t, window=DateWindow("2020-13-45", "06/30/2021", "MM/dd/yyyy"))


def test_unknown_school_and_missing_type_drop_the_incident(make_tables):
    assert rows(make_tables(incident=[(1, "Fight", TS(2020, 10, 5, 9, 0), 99, 100, 101)])) == []
    assert rows(make_tables(incident_detail=lambda r: [x for x in r if x[0] != 11])) == []


def test_two_actions_code_is_greatest_plan_is_smallest_tuple(make_tables):
    t = make_tables(
        incident_lu_sub_code=[(30, 500, "A", "x"), (30, 501, "B", "y")],
        incident_detail=lambda r: r + [(14, 1, 30, 501)],
        incident_action=[(1, 13, "Resolved", D(2020, 10, 6), D(2020, 10, 9), 3, None),
                         (1, 14, "Open", D(2020, 10, 6), D(2020, 10, 8), None, 1)])
    (r,) = rows(t)
    assert r["action_short_desc"] == "B"
    assert (r["action_plan_begin_dt"], r["action_plan_end_dt"], r["duration_assigned"], r["duration_actual"]) == \
        ("10-06-2020", "10-08-2020", "N/A", "1")
    assert r["action_resolved_desc"] == "Open"


def test_action_without_detail_still_gives_plan_and_resolution(make_tables):
    t = make_tables(incident_action=[(1, 999, "Resolved", None, D(2020, 10, 8), 4, None)])
    (r,) = rows(t)
    assert r["action_short_desc"] is None
    assert (r["action_plan_begin_dt"], r["action_plan_end_dt"], r["duration_assigned"], r["duration_actual"]) == \
        ("N/A", "10-08-2020", "4", "N/A")


def test_no_action_gives_na(make_tables):
    (r,) = rows(make_tables(incident_action=[]))
    assert r["action_short_desc"] is None
    assert {r[c] for c in ("action_resolved_desc", "action_plan_begin_dt", "action_plan_end_dt",
                           "duration_assigned", "duration_actual")} == {"N/A"}


def test_null_short_desc_never_beats_a_value(make_tables):
    t = make_tables(incident_lu_sub_code=[(30, 500, None, "x"), (30, 501, "DET", "y")],
                    incident_detail=lambda r: r + [(14, 1, 30, 501)],
                    incident_action=lambda r: r + [(1, 14, None, None, None, None, None)])
    assert rows(t)[0]["action_short_desc"] == "DET"


def test_shared_student_number_gives_one_row(make_tables):
    t = make_tables(students=lambda r: [r[0], (8, 1008, 5007, "S8", "Roe, Rick", 4, D(2011, 3, 4), None, "C", "MA", "0")],
                    incident_person_role=[(1, 7, 12), (1, 8, 15)],
                    incident_detail=lambda r: r + [(15, 1, 21, None)])
    got = rows(t)
    assert len(got) == 1
    # roles Offender (student 7) and Victim (student 8): the smallest role wins
    assert got[0]["person_role"] == "Offender" and got[0]["state_id"] == "S7"


def test_several_roles_pick_smallest_and_missing_role_is_null(make_tables):
    t = make_tables(incident_person_role=[(1, 7, 12), (1, 7, 15)], incident_detail=lambda r: r + [(15, 1, 21, None)])
    assert rows(t)[0]["person_role"] == "Offender"
    t = make_tables(incident_person_role=[(1, 7, 999)])
    assert rows(t)[0]["person_role"] is None


def test_two_extension_rows_still_one_row(make_tables):
    t = make_tables(u_def_ext_students=lambda r: r + [(1007, "no", "ref")])
    got = rows(t)
    assert len(got) == 1
    assert (got[0]["sped_code"], got[0]["english_learner_code"]) == ("No", "Former")


def test_missing_extension_row_is_unknown(make_tables):
    got = rows(make_tables(u_def_ext_students=[]))
    assert (got[0]["sped_code"], got[0]["english_learner_code"]) == ("Unknown", "Unknown")


def test_scopes(make_tables):
    t = make_tables(incident_person_role=[(1, 7, 12), (1, 8, 12)])
    assert len(rows(t)) == 2
    assert [r["state_id"] for r in rows(t, School(3))] == ["S7"]          # the student's school, not the incident's
    assert [r["state_id"] for r in rows(t, School(4))] == ["S8"]
    assert [r["state_id"] for r in rows(t, Selection())] == ["S7"]
    dup = make_tables(incident_person_role=[(1, 7, 12), (1, 8, 12)], current_selection=[(1007,), (1007,)])
    assert rows(dup, Selection()) == rows(t, Selection())


def test_null_student_number_grouped_and_sorted_last(make_tables):
    t = make_tables(students=[(7, 1007, None, None, "A", 3, None, None, None, None, None),
                              (8, 1008, None, None, "B", 3, None, None, None, None, None),
                              (9, 1009, 1, "S9", "C", 3, None, None, None, None, None)],
                    incident_person_role=[(1, 7, 12), (1, 8, 12), (1, 9, 12)])
    got = rows(t)
    assert [r["state_id"] for r in got] == ["S9", None]


def test_link_sorts_as_text(make_tables):
    t = make_tables(incident=[(9, "x", TS(2020, 10, 5, 9), 3, 100, 101), (10, "x", TS(2020, 10, 5, 8), 3, 100, 101)],
                    incident_detail=[(91, 9, 10, None), (101, 10, 10, None)],
                    incident_person_role=[(9, 7, 91), (10, 7, 101)])
    got = rows(t)
    assert [r["incident_link"][-6:-4] for r in got] == ["10", ">9"]


def test_newest_date_first_then_link_order(make_tables):
    t = make_tables(incident=[(1, None, TS(2020, 10, 5, 9), 3, 100, 101), (2, "z", TS(2020, 10, 5, 9), 3, 100, 101),
                              (3, "a", TS(2020, 11, 5, 9), 3, 100, 101)],
                    incident_detail=[(11, 1, 10, None), (21, 2, 10, None), (31, 3, 10, None)],
                    incident_person_role=[(1, 7, 12), (2, 7, 12), (3, 7, 12)])
    got = rows(t)
    assert [r["incident_link"][-5:-4] for r in got] == ["3", "1", "2"]


def test_detailed_columns_and_guardians(make_tables):
    (r,) = rows(make_tables(), detailed=True)
    assert (r["dob"], r["student_lastfirst"], r["mother_name"], r["father_name"]) == \
        ("2010-01-02", "Doe, Jane", "Doe, Mary", "Doe, John")
    assert r["address_full"] == "1 Main, Town, MA 01000"


def test_guardian_edge_cases(make_tables):
    # person row missing -> ', '; lower-case 'father' does not match; no row -> 'Guardian not listed'
    t = make_tables(person=[(51, "Doe", "John")], codeset=[(1, "Mother"), (2, "father")])
    (r,) = rows(t, detailed=True)
    assert (r["mother_name"], r["father_name"]) == (", ", "Guardian not listed")


def test_missing_street_keeps_separator(make_tables):
    t = make_tables(incident_person_role=[(1, 8, 12)])
    (r,) = rows(t, detailed=True)
    assert r["address_full"] == ", City, MA 02000"


def test_detailed_base_columns_equal_base_report(make_tables):
    t = make_tables(incident_person_role=[(1, 7, 12), (1, 8, 12)])
    base = rows(t)
    detailed = rows(t, detailed=True)
    assert [{k: r[k] for k in base[0]} for r in detailed] == base


def test_duplicate_term_rows_change_nothing(make_tables):
    # the source joins terms twice (inner); duplicates only repeat rows that ROW_NUMBER collapses
    t = make_tables(incident_person_role=[(1, 7, 12), (1, 8, 12)])
    doubled = make_tables(incident_person_role=[(1, 7, 12), (1, 8, 12)], terms=lambda r: r + r)
    assert rows(doubled) == rows(t)


def test_input_row_order_changes_nothing(make_tables):
    from pyspark.sql import functions as F

    base = make_tables(incident_person_role=[(1, 7, 12), (1, 8, 12), (1, 7, 15)],
                       incident_detail=lambda r: r + [(15, 1, 21, None), (16, 1, 30, 501)],
                       incident_action=lambda r: r + [(1, 16, "Open", None, None, 1, 1)])
    shuffled = type(base)(**{f: (df.orderBy(F.rand(7)) if df is not None else None)
                             for f, df in base.__dict__.items()})
    assert rows(shuffled) == rows(base)


@pytest.mark.parametrize("window", [None, DateWindow(D(2020, 9, 1), D(2021, 6, 30)), DateWindow(D(2020, 10, 5), D(2021, 1, 2))])
def test_term_join_on_midnight_and_overlap(spark, window):
    from incidentlens.operators.terms import within_terms

    terms = spark.createDataFrame([(D(2020, 9, 1), D(2020, 10, 5)), (D(2020, 10, 5), D(2020, 12, 1)),
                                   (D(2021, 1, 1), D(2021, 1, 2))], "FirstDay date, LastDay date")
    inc = spark.createDataFrame([(1, TS(2020, 10, 5, 10)), (2, TS(2020, 8, 31, 23)), (3, TS(2021, 1, 2, 0)),
                                 (4, TS(2021, 1, 2, 0, 0, 1)), (5, TS(2020, 12, 31, 23))],
                                "incident_id long, incident_ts timestamp_ntz")
    got = sorted(r[0] for r in within_terms(inc, "incident_ts", terms, "incident_id", window).collect())
    assert got == [1, 3]


def test_student_without_dcid_has_no_guardian_row(make_tables):
    # the source joins contacts on dcid: a NULL dcid matches nothing, so the names stay NULL
    t = make_tables(students=lambda r: [(7, None) + r[0][2:], r[1]])
    (r,) = rows(t, detailed=True)
    assert (r["mother_name"], r["father_name"]) == (None, None)
    assert (r["sped_code"], r["english_learner_code"]) == ("Unknown", "Unknown")
    assert r["student_link"] == "<a href=/admin/students/home.html?frn=001 target=_blank>5007</a>"


def test_many_terms_an_open_end_and_a_busy_day(spark):
    from incidentlens.operators.terms import within_terms

    many = [(D(2000 + i % 30, 1, 1), D(2000 + i % 30, 3, 1)) for i in range(3000)] + [(D(2022, 5, 1), D(9999, 12, 31))]
    terms = spark.createDataFrame(many, "FirstDay date, LastDay date")
    inc = spark.range(5000).select("id", F.when(F.col("id") < 4000, F.lit(TS(2022, 6, 1, 9))).when(
        F.col("id") < 4500, F.lit(TS(2021, 2, 1, 0))).otherwise(F.lit(TS(2021, 7, 1, 9))).cast("timestamp_ntz").alias("ts"))
    assert within_terms(inc, "ts", terms, "id").count() == 4500
    assert within_terms(inc, "ts", terms, "id", DateWindow(D(2021, 1, 1), D(2022, 12, 31))).count() == 4500


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_date_text_raises_whatever_the_session(spark, make_tables, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ValueError, match="garbage"):
            incident_report(make_tables(), District(), "garbage", "2021-06-30")
        assert incident_report(make_tables(), District(), "09/01/2020", "06/30/2021", "MM/dd/yyyy").count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_code_listed_under_several_types_does_not_multiply(make_tables):
    t = make_tables(incident_lu_sub_code=lambda r: r + [(31, 500, "ZZZ", "other type")])
    (r,) = rows(t)
    assert r["action_short_desc"] == "ZZZ"


def test_duplicate_staff_and_schools(make_tables):
    from incidentlens.plans import steps

    t = make_tables(teachers=lambda r: r + [(100, "Adams, Al")], schools=lambda r: r + [(3, "EAST")])
    assert steps.staff_names(t).count() == 3
    assert steps.incident_school(t).count() == 2
    assert steps.incident_staff(t).count() == 2
    (r,) = rows(t)
    assert (r["created_by_name"], r["school_abbreviation"]) == ("Adams, Al", "EAST")
