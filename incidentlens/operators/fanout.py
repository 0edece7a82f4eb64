"""How many rows the source's joined product has, and how its row numbers fall, without building it.

The source joins every term, type detail, resolution, action code, action plan, role and staff name of an incident
to every participation and numbers the product within (incident, student number) by action code. The joined sets are
independent of one another, so the size of a group is the product of the sizes of the sets, and the rows with one
action code are that product with the number of that code's rows in place of all. Each set is counted in
one aggregation per incident, participation or student; only counts are joined.

Numbers are whole; a product beyond 64 bits raises (ANSI arithmetic) and never wraps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import SisTables
from .incidents import type_codes
from .joins import join_splittable
from .scope import Scope
from .terms import DAY_PARTS, DateWindow, year_terms


def term_counts(incidents: DataFrame, terms: DataFrame, window: DateWindow) -> DataFrame:
    """``incidents`` (incident_id, incident_ts, ...) inside a term, with ``n_terms``, the terms they lie in.

    Terms are expanded into their days, clipped to the window. A term that ends on an incident's day covers
    it only at midnight, so ends are counted apart."""
    low, high = window.start_col, window.end_col
    spans = (terms.where("FirstDay <= LastDay").select(F.greatest("FirstDay", low).alias("_a"), F.least("LastDay", high).alias("_b"),
                                                       F.col("LastDay").alias("_last")).where("_a <= _b"))
    days = (spans.select(F.explode(F.sequence("_a", "_b")).alias("_day"), "_last").groupBy("_day")
            .agg(F.count("*").alias("_n"), F.count_if(F.col("_last") == F.col("_day")).alias("_ends"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(DAY_PARTS - 1))).alias("_part")))
    dealt = incidents.where(window.contains(F.col("incident_ts")))
    dealt = dealt.withColumn("_day", F.to_date("incident_ts")).withColumn("_part", F.pmod(F.hash("incident_id"), F.lit(DAY_PARTS)))
    late = F.col("incident_ts") > F.col("_day")
    met = dealt.join(days, ["_day", "_part"]).withColumn("n_terms", F.col("_n") - F.when(late, F.col("_ends")).otherwise(0))
    return met.where("n_terms > 0").drop("_day", "_part", "_n", "_ends")


def _times(df: DataFrame, counted: DataFrame, key: str, name: str, outer: bool) -> DataFrame:
    """``df`` with ``name``, the rows that a join to ``counted`` (key, name) gives; an outer join gives one at least."""
    out = join_splittable(df, counted, key, ["incident_id"], "left" if outer else "inner")
    return out.withColumn(name, F.coalesce(name, F.lit(1))) if outer else out


def incident_factor(t: SisTables, window: DateWindow) -> DataFrame:
    """(incident_id, factor): rows that each participation row of a reportable incident is joined to, but
    for action codes, roles and the student's own rows."""
    inc = term_counts(t.incident.select("incident_id", "incident_ts", "school_number", "created_by", "last_modified_by"),
                      year_terms(t.terms), window)
    types = t.incident_detail.select("incident_id", "lu_code_id").join(type_codes(t), "lu_code_id")
    types = types.groupBy("incident_id").agg(F.count("*").alias("n_types"))
    actions = t.incident_action.groupBy("incident_id", "action_resolved_desc").agg(F.count("*").alias("_k"))
    actions = actions.groupBy("incident_id").agg(F.count("*").alias("n_resolutions"), F.sum("_k").alias("n_plans"))
    schools = t.schools.groupBy("school_number").agg(F.count("*").alias("n_schools"))
    names = t.teachers.groupBy("id").agg(F.count("*").alias("_k"))
    inc = inc.join(types, "incident_id").join(actions, "incident_id", "left")
    inc = _times(inc, schools, "school_number", "n_schools", False)
    for who in ("created_by", "last_modified_by"):
        inc = _times(inc, names.select(F.col("id").alias(who), F.col("_k").alias(f"n_{who}")), who, f"n_{who}", True)
    one = lambda c: F.coalesce(c, F.lit(1))
    # terms are joined twice: to the incident, and again to its timestamp
    return inc.select("incident_id", (F.col("n_terms") * F.col("n_terms") * F.col("n_types") * one("n_resolutions") * one("n_plans")
                                      * F.col("n_schools") * F.col("n_created_by") * F.col("n_last_modified_by")).alias("factor"))


def action_code_counts(t: SisTables) -> DataFrame:
    """(incident_id, action_short_desc, n): rows of each action code; a code without a description counts as NULL."""
    subs = t.incident_lu_sub_code.groupBy("lu_sub_code_id", "short_desc").agg(F.count("*").alias("_k"))
    act = t.incident_action.select("incident_id", F.col("action_incident_detail_id").alias("incident_detail_id"))
    act = act.join(t.incident_detail.select("incident_detail_id", "lu_sub_code_id"), "incident_detail_id")
    act = act.groupBy("incident_id", "lu_sub_code_id").agg(F.count("*").alias("_a")).join(subs, "lu_sub_code_id", "left")
    return (act.groupBy("incident_id", F.col("short_desc").alias("action_short_desc"))
            .agg(F.sum(F.col("_a") * F.coalesce("_k", F.lit(1))).alias("n")))


def participation_rows(t: SisTables, scope: Scope) -> DataFrame:
    """(incident_id, student_number, rows): joined rows of all participations of the number's students.

    A participation is joined to every role of its (incident, student), and the student's extension rows
    come in three times (the student, the SPED step and the EL step)."""
    names = t.incident_lu_code.groupBy("lu_code_id").agg(F.count("*").alias("_k"))
    details = (t.incident_detail.select(F.col("incident_detail_id").alias("role_incident_detail_id"), "lu_code_id").join(names, "lu_code_id")
               .groupBy("role_incident_detail_id").agg(F.sum("_k").alias("_k")))
    parts = (t.incident_person_role.join(details, "role_incident_detail_id", "left")
             .groupBy("incident_id", F.col("studentid").alias("student_id"))
             .agg(F.count("*").alias("_n"), F.sum(F.coalesce("_k", F.lit(0))).alias("_roles")))
    ext = t.u_def_ext_students.groupBy("studentsdcid").agg(F.count("*").alias("_e"))
    stu = scope.students(t).select(F.col("id").alias("student_id"), "student_number", "dcid")
    stu = stu.join(ext, stu["dcid"] == F.col("studentsdcid"), "left").withColumn("_e", F.coalesce("_e", F.lit(1)))
    met = join_splittable(parts, stu.select("student_id", "student_number", "_e"), "student_id", ["incident_id"])
    each = F.col("_n") * F.greatest("_roles", F.lit(1)) * F.col("_e") * F.col("_e") * F.col("_e")
    return met.groupBy("incident_id", "student_number").agg(F.sum(each).alias("rows"))


def row_number_ranges(t: SisTables, scope: Scope, window: DateWindow) -> DataFrame:
    """(incident_id, student_number, action_short_desc, first_row, last_row): the row numbers that the source
    gives to the rows of each action code of a group, action codes descending, NULL last.

    Within one code the source's order is arbitrary, so a range says all there is to say; ``first_row = 1`` marks the
    code of the row that is kept. An incident without actions has one range, of no code."""
    # ranges of one copy of the set of action rows; a group repeats each code's rows ``times`` times
    codes = action_code_counts(t)
    order = Window.partitionBy("incident_id").orderBy(F.desc_nulls_last("action_short_desc"))
    codes = codes.withColumn("_before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    codes = codes.select("incident_id", "action_short_desc", F.coalesce("_before", F.lit(0)).alias("_before"), "n")
    groups = join_splittable(participation_rows(t, scope), incident_factor(t, window), "incident_id", ["student_number"])
    groups = groups.select("incident_id", "student_number", (F.col("rows") * F.col("factor")).alias("_times"))
    met = join_splittable(groups, codes, "incident_id", ["student_number"], "left")
    before, n = F.coalesce("_before", F.lit(0)), F.coalesce("n", F.lit(1))
    return met.select("incident_id", "student_number", "action_short_desc", (before * F.col("_times") + 1).alias("first_row"),
                      ((before + n) * F.col("_times")).alias("last_row"))


def fanout_counts(t: SisTables, scope: Scope, window: DateWindow) -> DataFrame:
    """(incident_id, student_number, source_rows, ties_at_first): rows the source numbers in each group, and how
    many of them could be its first (those of the first action code)."""
    ranges = row_number_ranges(t, scope, window)
    return ranges.groupBy("incident_id", "student_number").agg(
        F.max("last_row").alias("source_rows"), F.max(F.when(F.col("first_row") == 1, F.col("last_row"))).alias("ties_at_first"))
