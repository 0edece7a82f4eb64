"""The incident report: one row per (incident, student_number), base (18 columns) or detailed (27).

Plan shape (all lazy; Catalyst and AQE choose the physical joins):

1. incidents in range and term, with a participant in scope -> the keys of the report
2. details and actions of these -> category, action code, resolution + plan (partial aggregates)
3. incident facts               -> joins on incident_id (co-partitioned by the reductions)
4. student facts in scope       -> program codes (+ profile, guardians)
5. participations + roles       -> one min(struct) per (incident_id, student_number)
6. join facts (a join that AQE can split), format, sort on the six report keys
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, exprs
from ..operators import incidents, participants, students
from ..operators.scope import District, School, Scope, Selection
from ..operators.joins import growing, join_splittable
from ..operators.terms import DateWindow
from ..sources.tables import SisTables
from .manifest import write_manifest
from .watch import ReportWatch


def _window(start, end, fmt) -> DateWindow:
    if isinstance(start, DateWindow):
        return start
    return DateWindow(start, end, fmt)


def report_order() -> list[Column]:
    """Final sort: incident date (text) descending, then link, title, student number, state id,
    school; NULLs placed as the source database places them (last ascending, first descending)."""
    return [F.col("incident_ts").desc_nulls_first(), F.col("incident_link").asc_nulls_last(),
            F.col("incident_title").asc_nulls_last(), F.col("student_number").asc_nulls_last(),
            F.col("state_id").asc_nulls_last(), F.col("school_abbreviation").asc_nulls_last()]


def incident_display(facts: DataFrame) -> list[Column]:
    """Formatted incident-level columns of a report row."""
    return [
        exprs.date_text("incident_ts", codes.INCIDENT_DATE_MASK).alias("incident_ts"),
        exprs.incident_link("incident_id").alias("incident_link"),
        F.col("incident_title"),
        F.col("action_short_desc"),
        exprs.or_na("action_resolved_desc").alias("action_resolved_desc"),
        F.col("incident_category"),
        exprs.or_na(exprs.date_text("action_plan_begin_dt", codes.PLAN_DATE_MASK)).alias("action_plan_begin_dt"),
        exprs.or_na(exprs.date_text("action_plan_end_dt", codes.PLAN_DATE_MASK)).alias("action_plan_end_dt"),
        exprs.or_na("duration_assigned").alias("duration_assigned"),
        exprs.or_na("duration_actual").alias("duration_actual"),
        F.col("created_by_name"),
        F.col("last_modified_by_name"),
        F.col("school_abbreviation"),
    ]


def report_rows(t: SisTables, scope: Scope, window: DateWindow, detailed: bool = False,
                watch: ReportWatch | None = None) -> DataFrame:
    """Unsorted report rows with every output column plus ``incident_id``, ``student_number`` and ``dcid``."""
    stu = students.student_facts(t, scope, detailed)
    in_window = incidents.incidents_in_window(t, window).select("incident_id")
    # a school or selection scope keeps few students: drop other participations before the role lookup
    scoped = None if isinstance(scope, District) else scope.students(t).select(F.col("id").alias("student_id"))
    parts = participants.participations(t, in_window, scoped)
    # the incidents the report can show: details and actions of all others are left unread by the reductions
    keys = growing(in_window) if scoped is None else participants.taking_part(t, in_window, scoped)
    facts = incidents.incident_facts(t, window, keys, watch)
    counted = stu if watch is None else watch.over_students(stu)
    return report_rows_of(parts, counted, facts, detailed, watch if scoped is None else None, stu)


def report_rows_of(parts: DataFrame, stu: DataFrame, facts: DataFrame, detailed: bool = False,
                   watch: ReportWatch | None = None, profiles: DataFrame | None = None) -> DataFrame:
    """Report rows of participations with roles, student facts and incident facts; ``profiles`` are the student facts
    that details of students come from, where those of ``stu`` are counted as they run."""
    joined = parts.join(growing(stu), "student_id") if watch is None else watch.over_participations(parts, stu)
    chosen = participants.choose_per_student_number(joined, ["state_id"])
    if detailed:
        chosen = participants.with_profile(chosen, stu if profiles is None else profiles, ["state_id"], students.PROFILE_FIELDS)
    rows = join_splittable(chosen, growing(facts), "incident_id", ["student_number"])
    student_cols = [exprs.student_link("dcid", "student_number").alias("student_link"), F.col("state_id")]
    if detailed:
        student_cols += [F.col(c) for c in students.PROFILE_FIELDS]
    return rows.select("incident_id", "student_number", "dcid", *student_cols,
                       "sped_code", "english_learner_code", "person_role", *incident_display(rows))


def incident_report(t: SisTables, scope: Scope, start: dt.date | str | DateWindow, end: dt.date | str | None = None,
                    fmt: str = "yyyy-MM-dd", detailed: bool = False, watch: ReportWatch | None = None) -> DataFrame:
    """The report, sorted, with the source's columns in the source's order (all text).

    With ``watch``, what the report leaves out is counted while it runs."""
    columns = codes.DETAIL_COLUMNS if detailed else codes.BASE_COLUMNS
    rows = report_rows(t, scope, _window(start, end, fmt), detailed, watch)
    return rows.orderBy(*report_order()).select(*columns)


def selection_report(t: SisTables, chosen: DataFrame | None, start, end=None, fmt="yyyy-MM-dd", detailed=False):
    return incident_report(t, Selection(chosen), start, end, fmt, detailed)


def school_report(t: SisTables, school_id: int, start, end=None, fmt="yyyy-MM-dd", detailed=False):
    return incident_report(t, School(school_id), start, end, fmt, detailed)


def district_report(t: SisTables, start, end=None, fmt="yyyy-MM-dd", detailed=False):
    return incident_report(t, District(), start, end, fmt, detailed)


def labelled(report: DataFrame) -> DataFrame:
    """Rename report columns to their display labels (by meaning; see ``codes.COLUMN_LABELS``)."""
    return report.withColumnsRenamed({c: codes.COLUMN_LABELS[c] for c in report.columns if c in codes.COLUMN_LABELS})


def export(report: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists", manifest: bool = False) -> None:
    """Write a report under its display labels: CSV with a header row, or Parquet.

    Each task writes its own part file in sort order; no data passes through the driver. With ``manifest`` the
    order of the files, their rows and keys are added (see ``manifest``).
    """
    out = labelled(report)
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported export format {fmt!r}")
    if manifest:
        write_manifest(report.sparkSession, path, fmt)
