"""

Steps that the source defines as plain joins or projections keep bag semantics (every
source row, duplicates included). Steps whose source form is a fan-out followed by "keep
one" are given in their reduced form — one row per key with the tie-break's choice — which
is what the reports actually use; emitting the fan-out itself would mean materialising
every pair within a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, exprs
from ..operators import incidents, participants, students
from ..operators.joins import join_splittable
from ..operators.position import with_sort_position
from ..operators.scope import District, Scope
from ..operators.terms import DateWindow, within_terms, year_terms
from ..sources.tables import SisTables
from . import report

# -- sources, parameters, scope -------------------------------------------------------------


def year_terms_step(t: SisTables) -> DataFrame:
    return year_terms(t.terms)


def incident_date_range(t: SisTables, window: DateWindow) -> DataFrame:
    """Incidents whose timestamp lies in the window (text dates parsed with the window's format)."""
    return t.incident.where(window.contains(F.col("incident_ts"))).select("incident_id", "incident_ts")


def incident_in_term(t: SisTables) -> DataFrame:
    """All incidents inside at least one full-year district term (range semi join)."""
    return within_terms(t.incident.select("incident_id", "incident_ts"), "incident_ts", year_terms(t.terms), "incident_id")


def scope_students(t: SisTables, scope: Scope) -> DataFrame:
    return scope.students(t).select(F.col("id").alias("student_id"), "dcid", "student_number", "schoolid")


# -- incident side ------------------------------------------------------------------------------


def incident_category(t: SisTables) -> DataFrame:
    """Every (incident, type detail) pair with its category (inner joins, bag semantics)."""
    return (t.incident.select("incident_id")
            .join(t.incident_detail.select("incident_id", "incident_detail_id", "lu_code_id"), "incident_id")
            .join(incidents.type_codes(t), "lu_code_id")
            .select("incident_id", "incident_detail_id", "incident_category"))


def incident_location(t: SisTables) -> DataFrame:
    """Retired field: location description of each location detail of an incident (composite-key lookup)."""
    loc_codes = t.incident_lu_code.where(F.col("code_type") == codes.LOCATION_CODE).select("lu_code_id")
    sub = t.incident_lu_sub_code.select("lu_code_id", "lu_sub_code_id", F.col("long_desc").alias("location_description"))
    return (t.incident.select("incident_id")
            .join(t.incident_detail.select("incident_id", "lu_code_id", "lu_sub_code_id"), "incident_id")
            .join(loc_codes, "lu_code_id")
            .join(sub, ["lu_code_id", "lu_sub_code_id"])
            .select("incident_id", "location_description"))


def action_resolution(t: SisTables) -> DataFrame:
    """Distinct (incident, resolution) pairs."""
    return t.incident_action.select("incident_id", "action_resolved_desc").distinct()


def action_code(t: SisTables) -> DataFrame:
    """Every action with a detail, and its sub code's short description (lookup by sub code only)."""
    sub = t.incident_lu_sub_code.select("lu_sub_code_id", "short_desc")
    act = t.incident_action.select("incident_id", F.col("action_incident_detail_id").alias("incident_detail_id"))
    return (act.join(t.incident_detail.select("incident_detail_id", "lu_sub_code_id"), "incident_detail_id")
            .join(sub, "lu_sub_code_id", "left")
            .select("incident_id", F.col("lu_sub_code_id").alias("action_code"), F.col("short_desc").alias("action_short_desc")))


def action_plan(t: SisTables) -> DataFrame:
    """Every action's plan, dates as MM-DD-YYYY text."""
    return t.incident_action.select(
        "incident_id",
        exprs.date_text("action_plan_begin_dt", codes.PLAN_DATE_MASK).alias("action_plan_begin_dt"),
        exprs.date_text("action_plan_end_dt", codes.PLAN_DATE_MASK).alias("action_plan_end_dt"),
        "duration_assigned", "duration_actual")


def action_plan_choice(t: SisTables) -> DataFrame:
    """Per incident with actions: the chosen plan tuple (typed), smallest ascending with nulls last."""
    return incidents.action_summary(t).select("incident_id", *incidents.PLAN_FIELDS)


def incident_base(t: SisTables, window: DateWindow) -> DataFrame:
    """One row per incident in range, in a term and with a type detail (reduced category/resolution)."""
    inc = incidents.incidents_in_window(t, window)
    keys = inc.select("incident_id")
    res = (t.incident_action.join(keys, "incident_id", "left_semi")
           .groupBy("incident_id").agg(F.min("action_resolved_desc").alias("action_resolved_desc")))
    return (inc.join(incidents.incident_categories(t, keys), "incident_id")
            .join(res, "incident_id", "left")
            .select("incident_id", "incident_title",
                    exprs.date_text("incident_ts", codes.INCIDENT_DATE_MASK).alias("incident_ts"),
                    F.col("incident_ts").alias("incident_ts_raw"), "school_number", "created_by", "last_modified_by",
                    "incident_category", "action_resolved_desc"))


def action_plan_display(t: SisTables, window: DateWindow) -> DataFrame:
    """Per reportable incident: the chosen plan as shown (text, 'N/A' when missing)."""
    base = incident_base(t, window).select("incident_id")
    plan = incidents.action_summary(t, incidents.incidents_in_window(t, window).select("incident_id"))
    return base.join(plan, "incident_id", "left").select(
        "incident_id",
        exprs.or_na(exprs.date_text("action_plan_begin_dt", codes.PLAN_DATE_MASK)).alias("action_plan_begin_dt"),
        exprs.or_na(exprs.date_text("action_plan_end_dt", codes.PLAN_DATE_MASK)).alias("action_plan_end_dt"),
        exprs.or_na("duration_assigned").alias("duration_assigned"),
        exprs.or_na("duration_actual").alias("duration_actual"))


def action_resolution_display(t: SisTables, window: DateWindow) -> DataFrame:
    return incident_base(t, window).select("incident_id", exprs.or_na("action_resolved_desc").alias("action_resolved_desc"))


def incident_school(t: SisTables) -> DataFrame:
    """Incident -> the incident's school abbreviation (inner: unknown school drops the incident; a
    number listed twice gives two rows)."""
    names = t.schools.select("school_number", F.col("abbreviation").alias("school_abbreviation"))
    return t.incident.select("incident_id", "school_number").join(names, "school_number") \
        .select("incident_id", "school_abbreviation")


def incident_staff(t: SisTables) -> DataFrame:
    """Incident -> creator and last modifier (left joins, one row per combination of listed names)."""
    inc = t.incident.select("incident_id", "created_by", "last_modified_by")
    creator = t.teachers.select(F.col("id").alias("created_by"), F.col("lastfirst").alias("created_by_name"))
    modifier = t.teachers.select(F.col("id").alias("last_modified_by"), F.col("lastfirst").alias("last_modified_by_name"))
    out = join_splittable(inc, creator, "created_by", ["incident_id"], "left")
    return (join_splittable(out, modifier, "last_modified_by", ["incident_id"], "left")
            .select("incident_id", "created_by_name", "last_modified_by_name"))


def staff_names(t: SisTables) -> DataFrame:
    """Every staff row: id and name."""
    return t.teachers.select("id", "lastfirst")


def incident_link(t: SisTables) -> DataFrame:
    return t.incident.select("incident_id", exprs.incident_link("incident_id").alias("incident_link"))


# -- student side -------------------------------------------------------------------------------


def _students_ext(t: SisTables) -> DataFrame:
    return t.students.join(t.u_def_ext_students, F.col("dcid") == F.col("studentsdcid"), "left")


def student_base(t: SisTables) -> DataFrame:
    """Students with their raw extension codes (left join: one row per extension row)."""
    return _students_ext(t).select(F.col("id").alias("student_id"), "student_number", "dcid",
                                   F.col("state_studentnumber").alias("state_id"),
                                   F.col("lastfirst").alias("student_lastfirst"), "sped", "el", "schoolid")


def sped_code(t: SisTables) -> DataFrame:
    return _students_ext(t).select(F.col("id").alias("student_id"), exprs.sped_code("sped").alias("sped_code"))


def english_learner_code(t: SisTables) -> DataFrame:
    return _students_ext(t).select(F.col("id").alias("student_id"),
                                   exprs.english_learner_code("el").alias("english_learner_code"))


def student_profile(t: SisTables) -> DataFrame:
    return t.students.select(
        F.col("id").alias("student_id"), "dcid",
        exprs.date_text("dob", codes.INCIDENT_DATE_MASK).alias("dob"), F.col("lastfirst").alias("student_lastfirst"),
        "street", "city", "state", "zip", exprs.full_address("street", "city", "state", "zip").alias("address_full"))


def student_link(t: SisTables) -> DataFrame:
    return t.students.select(F.col("id").alias("student_id"),
                             exprs.student_link("dcid", "student_number").alias("student_link"))


def student_contacts(t: SisTables) -> DataFrame:
    """Per student dcid: mother and father names, 'Guardian not listed' when absent."""
    dcids = t.students.select("dcid").distinct()
    names = students.guardian_names(t)
    return dcids.join(names, "dcid", "left").select(
        F.col("dcid").alias("studentdcid"),
        *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(codes.GUARDIAN_NOT_LISTED)).alias(c)
          for c in ("mother_name", "father_name")])


def _state_sped(t: SisTables) -> DataFrame:
    t.require("s_ma_stu_sped_x")
    return t.students.join(t.s_ma_stu_sped_x, F.col("dcid") == F.col("studentsdcid"), "left")


def sped_level_of_need(t: SisTables) -> DataFrame:
    """Retired field: level-of-need code and label from the state SPED table."""
    return _state_sped(t).select(
        F.col("id").alias("student_id"), F.col("levelofneed").alias("levelofneed_code"),
        exprs.recode("levelofneed", codes.LEVEL_OF_NEED_CODES, codes.RETIRED_DEFAULT, lower=False,
                     null_label=codes.NO_SPED_DATA).alias("levelofneed_label"))


def primary_disability(t: SisTables) -> DataFrame:
    """Retired field: primary disability code and label from the state SPED table."""
    return _state_sped(t).select(
        F.col("id").alias("student_id"), F.col("primarydisability").alias("primarydisability_code"),
        exprs.recode("primarydisability", codes.PRIMARY_DISABILITY_CODES, codes.RETIRED_DEFAULT, lower=False,
                     null_label=codes.NO_SPED_DATA).alias("primarydisability_label"))


# -- participants and roles ----------------------------------------------------------------------


def person_role(t: SisTables) -> DataFrame:
    """Every participation with a resolvable role detail (inner joins, any code type)."""
    ipr = t.incident_person_role
    return (ipr.join(participants.role_lookup(t), "role_incident_detail_id")
            .select("incident_id", F.col("studentid").alias("student_id"), "person_role"))


def person_role_in_scope(t: SisTables, scope: Scope) -> DataFrame:
    """Roles of participants enrolled in scope (inner join to the scoped students)."""
    stu = scope.students(t).select(F.col("id").alias("student_id"))
    return person_role(t).join(stu, "student_id").select("incident_id", "student_id", "person_role")


def _report_participants(t: SisTables, window: DateWindow) -> DataFrame:
    keys = incident_base(t, window).select("incident_id")
    parts = participants.participations(t, keys)
    stu = t.students.select(F.col("id").alias("student_id"), "student_number")
    return parts.join(stu, "student_id")


def participants_step(t: SisTables, window: DateWindow) -> DataFrame:
    """Distinct (incident, student) pairs of participations in reportable incidents."""
    return _report_participants(t, window).select("incident_id", "student_id", "student_number").distinct()


def participant_role(t: SisTables, window: DateWindow) -> DataFrame:
    """Per participating (incident, student): the chosen role (smallest, NULL when none)."""
    return participants.participant_roles(_report_participants(t, window))


def top_action_per_student(t: SisTables, scope: Scope, window: DateWindow) -> DataFrame:
    """Per (incident, student_number) of the report: the top action code."""
    return report.report_rows(t, scope, window).select("incident_id", "student_number", "action_short_desc")


def ranked_results(t: SisTables, scope: Scope, window: DateWindow) -> DataFrame:
    """Best row per (incident, student) numbered within (incident, student_number) by the tie-break.

    The source numbers its full fan-out; here each student's candidates are first reduced to
    one row (role = smallest), then the window ranks the students sharing a number.
    """
    facts = incidents.incident_facts(t, window)
    stu = students.student_facts(t, scope)
    keys = incidents.incidents_in_window(t, window).select("incident_id")
    roles = participants.participant_roles(participants.participations(t, keys))
    rows = roles.join(stu, "student_id").join(facts.select("incident_id", "action_short_desc"), "incident_id")
    order = [F.col(c).asc_nulls_last() for c in participants.TIE_BREAK]
    ranked = participants.rank_within_student_number(rows, order)
    return ranked.select("incident_id", "student_id", "student_number", "dcid",
                         exprs.student_link("dcid", "student_number").alias("student_link"),
                         "person_role", "sped_code", "english_learner_code", "action_short_desc", "row_num")


def report_order(t: SisTables, window: DateWindow) -> DataFrame:
    """The district report with each row's 1-based position in the report order."""
    rows = report.report_rows(t, District(), window)
    placed = with_sort_position(rows, report.report_order(), "report_pos")
    return placed.select(*codes.BASE_COLUMNS, "report_pos")


def report_labelled(t: SisTables, window: DateWindow) -> DataFrame:
    """The district report under its display labels (what ``report.export`` writes)."""
    return report.labelled(report.incident_report(t, District(), window))
