"""What is moved between tasks: ids and short columns, and source rows once for each grouping."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest

from incidentlens.operators import incidents
from incidentlens.operators.scope import District
from incidentlens.operators.terms import DateWindow
from incidentlens.plans.report import report_rows
from incidentlens.sources.fixtures import derive_frames

from .conftest import SF_SMALL

WINDOW = DateWindow(dt.date(2020, 9, 1), dt.date(2021, 6, 30))


@pytest.fixture()
def shuffled_joins(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().splitlines()


def test_lines_are_dealt_before_they_are_grouped(spark):
    lines = plan(derive_frames(spark, SF_SMALL)["incident_action"])
    shuffles = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(shuffles) == 1
    assert not any("Aggregate" in line for line in lines[shuffles[0]:])


def test_only_ids_of_actions_go_to_the_details(make_tables, shuffled_joins):
    lines = plan(incidents.action_facts(make_tables()))
    at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(incident_detail_id" in line]
    assert at
    for i in at:
        below = next(line for line in lines[i + 1:] if "Project" in line)
        assert "action_resolved_desc" not in below and "duration_actual" not in below


def test_the_choice_of_a_participant_carries_no_profile(make_tables, shuffled_joins):
    chosen = [line for line in plan(report_rows(make_tables(), District(), WINDOW, detailed=True))
              if "partial_min" in line and "person_role" in line]
    assert chosen
    assert not any("mother_name" in line or "street" in line for line in chosen)


def test_profile_of_a_repeated_student_is_one_of_its_rows(make_tables):
    def shown(*more):
        t = make_tables(students=lambda rows: [*rows, *[(*rows[0][:1], dcid, *rows[0][2:7], street, *rows[0][8:]) for dcid, street in more]])
        rows = report_rows(t, District(), WINDOW, detailed=True).collect()
        return [(r["student_number"], r["dcid"], r["sped_code"], r["street"], r["mother_name"]) for r in rows]

    assert shown((1007, "0 Other"), (1007, "0 Other")) == [(5007, 1007, "Yes", "0 Other", "Doe, Mary")]
    # a row without a dcid has no program, and comes first by it
    assert shown((1007, "0 Other"), (None, "9 Last")) == [(5007, None, "Unknown", "9 Last", None)]


def test_actions_keep_code_resolution_and_plan_apart(make_tables):
    t = make_tables(incident_action=[
        (1, 13, None, dt.date(2020, 10, 7), None, 1, None), (1, 99, "Open", dt.date(2020, 10, 6), None, None, 2),
        (1, None, "Resolved", None, None, None, None), (2, 99, "Open", None, None, None, None), (None, 13, "Open", None, None, 1, 1)])
    found = {r["incident_id"]: tuple(r)[1:] for r in incidents.action_facts(t).collect()}
    assert found[1] == ("SUSP", "Open", dt.date(2020, 10, 6), None, None, 2)
    assert found[2] == (None, "Open", None, None, None, None)
