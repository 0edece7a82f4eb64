"""Per-incident facts: category, action code, resolution, action plan, school and staff.

The source reports join every type detail, every resolution, every action code and every
action plan of an incident to every participant and keep one row per (incident, student)
with ``ROW_NUMBER``. Those sets are independent of one another, and the smallest tuple of a
Cartesian product is the tuple of per-set minima, so each set is reduced to one value per

* action code: greatest non-null ``short_desc`` (the source ranks by it, descending, nulls last);
* category, resolution: smallest non-null value (our tie-break: ascending, nulls last);
* action plan: the smallest (begin, end, assigned, actual) tuple, ascending, nulls last per member.

Each reduction is a ``groupBy(incident_id)`` with map-side partial aggregation, so an
incident holding a third of all rows is collapsed per task before the shuffle. With ``keys``
(the incidents a report can show) details and actions are semi-joined to them first, so a
report over a month or one school does not reduce the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, exprs
from ..sources.tables import SisTables
from .joins import growing, join_splittable
from .terms import DateWindow, within_terms, year_terms

PLAN_FIELDS = ("action_plan_begin_dt", "action_plan_end_dt", "duration_assigned", "duration_actual")


def incidents_in_window(t: SisTables, window: DateWindow) -> DataFrame:
    """Incidents in the run's date range and inside a full-year district term."""
    inc = t.incident.where(window.contains(F.col("incident_ts")))
    return within_terms(inc, "incident_ts", year_terms(t.terms), "incident_id", window)


def type_codes(t: SisTables) -> DataFrame:
    return (t.incident_lu_code.where(F.col("code_type") == codes.INCIDENT_TYPE_CODE)
            .select("lu_code_id", "incident_category"))


def _of(df: DataFrame, keys: DataFrame | None) -> DataFrame:
    return df if keys is None else df.join(keys.select("incident_id"), "incident_id", "left_semi")


def incident_categories(t: SisTables, keys: DataFrame | None = None) -> DataFrame:
    """One row per incident that has at least one type detail: its smallest category.

    A code listed twice is reduced to its smallest category before it meets the details."""
    listed = type_codes(t).groupBy("lu_code_id").agg(F.min("incident_category").alias("incident_category"))
    detail = _of(t.details_of_incidents().select("incident_id", "lu_code_id").join(listed, "lu_code_id"), keys)
    return detail.groupBy("incident_id").agg(F.min("incident_category").alias("incident_category"))


def sub_code_names(t: SisTables) -> DataFrame:
    """Sub code -> its greatest description (looked up by sub code only, as in the source); a NULL
    description cannot win a ``max`` and is left out."""
    return (t.incident_lu_sub_code.where(F.col("short_desc").isNotNull())
            .groupBy("lu_sub_code_id").agg(F.max("short_desc").alias("short_desc")))


def action_codes(t: SisTables, keys: DataFrame | None = None) -> DataFrame:
    """One row per incident with a described action code: the greatest. Only ids meet the details."""
    act = _of(t.incident_action.select("incident_id", F.col("action_incident_detail_id").alias("incident_detail_id")), keys)
    # a detail may belong to another incident than the action that names it, so it is met by its id only;
    # its sub code is looked up afterwards, for the report's actions
    detail = t.details_by_id().where(F.col("lu_sub_code_id").isNotNull()).select("incident_detail_id", "lu_sub_code_id")
    act = join_splittable(act.join(growing(detail), "incident_detail_id"), sub_code_names(t), "lu_sub_code_id", ["incident_id"])
    return act.groupBy("incident_id").agg(F.max("short_desc").alias("action_short_desc"))


def action_facts(t: SisTables, keys: DataFrame | None = None) -> DataFrame:
    """One row per incident with actions: greatest action code, smallest resolution and smallest plan tuple (typed).

    Resolutions and plans are reduced where the actions of an incident are; only ids go to the details and back."""
    met = action_summary(t, keys).join(growing(action_codes(t, keys)), "incident_id", "left")
    return met.select("incident_id", "action_short_desc", "action_resolved_desc", *PLAN_FIELDS)


def action_summary(t: SisTables, keys: DataFrame | None = None) -> DataFrame:
    """One row per incident with actions: smallest resolution and smallest plan tuple (typed)."""
    plan = exprs.nulls_last_key(*PLAN_FIELDS)
    agg = (_of(t.incident_action, keys).groupBy("incident_id")
           .agg(F.min("action_resolved_desc").alias("action_resolved_desc"), F.min(plan).alias("_plan")))
    return agg.select("incident_id", "action_resolved_desc", *_plan_columns())


def _plan_columns() -> list:
    return [F.col(f"_plan.v{i}").alias(name) for i, name in enumerate(PLAN_FIELDS)]


def with_school(df: DataFrame, t: SisTables, watch=None) -> DataFrame:
    """Inner join to the incident's school; a number listed twice keeps its smallest abbreviation,
    so an incident never gets two report rows (the source would keep an arbitrary one)."""
    names = t.schools.groupBy("school_number").agg(F.min("abbreviation").alias("school_abbreviation"))
    if watch is None:
        return join_splittable(df, names, "school_number", ["incident_id"])
    names = names.withColumn("_found", F.lit(True))
    met = join_splittable(watch.numbered(df, "incident_id"), names, "school_number", ["incident_id"], "left")
    return watch.over_incidents(met.withColumn("_known", F.coalesce("_found", F.lit(False))).drop("_found"))


def with_staff(df: DataFrame, t: SisTables) -> DataFrame:
    """Creator and last modifier names (two left joins to the same staff table, one name per id:
    the smallest when an id is listed twice). Incidents never modified are spread, not gathered."""
    staff = t.teachers.groupBy("id").agg(F.min("lastfirst").alias("lastfirst"))
    creator = staff.select(F.col("id").alias("created_by"), F.col("lastfirst").alias("created_by_name"))
    modifier = staff.select(F.col("id").alias("last_modified_by"), F.col("lastfirst").alias("last_modified_by_name"))
    out = join_splittable(df, creator, "created_by", ["incident_id"], "left")
    return join_splittable(out, modifier, "last_modified_by", ["incident_id"], "left")


def incident_facts(t: SisTables, window: DateWindow, keys: DataFrame | None = None, watch=None) -> DataFrame:
    """One row per reportable incident with every incident-level report value (typed).

    Reportable: in range, in a term, with a type detail, at a known school (the incident's
    school) and, with ``keys``, one of them. Incidents without actions keep NULL action values.
    """
    inc = incidents_in_window(t, window).select(
        "incident_id", "incident_title", "incident_ts", "school_number", "created_by", "last_modified_by")
    pruned = growing(inc.select("incident_id")) if keys is None else keys
    facts = (growing(inc).join(incident_categories(t, pruned), "incident_id")
             .join(growing(action_facts(t, pruned)), "incident_id", "left"))
    return with_staff(with_school(facts, t, watch), t)
