"""Participants: one chosen student row per (incident, student_number).

The source keeps, per (incident_id, student_number), the first row of a window ordered by the
action code. After the per-incident reductions every candidate row of such a group carries
the same incident values, so the only choice left is *which participating student and role*
— it matters when two students share a ``student_number`` or a student has several roles.
That choice is one ``min`` over a struct ordered like our tie-break (role, SPED, EL, dcid, id;
ascending, nulls last): a hash-partitioned aggregation with map-side partial aggregation,
so an incident with a third of all participants is spread over ``student_number`` and
reduced per task; no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs
from ..sources.tables import SisTables
from .joins import growing

TIE_BREAK = ("person_role", "sped_code", "english_learner_code", "dcid", "student_id")


def role_lookup(t: SisTables) -> DataFrame:
    """Role detail id -> role name (any code type, as in the source)."""
    names = t.incident_lu_code.select("lu_code_id", F.col("incident_category").alias("person_role"))
    return (t.details_by_id().select(F.col("incident_detail_id").alias("role_incident_detail_id"), "lu_code_id")
            .join(names, "lu_code_id")
            .select("role_incident_detail_id", "person_role"))


def taking_part(t: SisTables, incident_keys: DataFrame, student_keys: DataFrame) -> DataFrame:
    """The given incidents in which one of the given students (a ``student_id`` column) takes part."""
    ipr = t.incident_person_role.select("incident_id", F.col("studentid").alias("student_id"))
    ipr = ipr.join(student_keys.select("student_id"), "student_id", "left_semi")
    return growing(incident_keys).join(ipr.select("incident_id"), "incident_id", "left_semi").select("incident_id")


def participations(t: SisTables, incident_keys: DataFrame | None = None,
                   student_keys: DataFrame | None = None) -> DataFrame:
    """Participation rows with their role (NULL when the role detail or code is missing).

    With ``incident_keys`` / ``student_keys`` (a ``student_id`` column) only participations of
    those incidents / students are read: left-semi joins done before the role lookup, so the
    shuffle to the detail table carries only rows that can reach the report. The detail is met by
    its id before its code is looked up: details stored in buckets of the id are then not shuffled,
    and codes are looked up for the report's rows only. A detail whose code is missing gives a NULL role.
    """
    ipr = t.incident_person_role
    if student_keys is not None:  # the fewer rows
        ipr = ipr.join(student_keys.select(F.col("student_id").alias("studentid")), "studentid", "left_semi")
    if incident_keys is not None:
        ipr = ipr.join(growing(incident_keys.select("incident_id")), "incident_id", "left_semi")
    detail = t.details_by_id().select(F.col("incident_detail_id").alias("role_incident_detail_id"), "lu_code_id")
    names = t.incident_lu_code.select("lu_code_id", F.col("incident_category").alias("person_role"))
    return (ipr.join(growing(detail), "role_incident_detail_id", "left").join(names, "lu_code_id", "left")
            .select("incident_id", F.col("studentid").alias("student_id"), "person_role"))


def participant_roles(parts: DataFrame) -> DataFrame:
    """(incident_id, student_id) -> smallest non-null role (NULL if none)."""
    return parts.groupBy("incident_id", "student_id").agg(F.min("person_role").alias("person_role"))


def choose_per_student_number(joined: DataFrame, payload: Sequence[str]) -> DataFrame:
    """One row per (incident_id, student_number): the participant with the smallest tie-break key.

    ``joined`` holds participations with their student: ``student_id``, ``student_number`` and the tie-break columns;
    ``payload`` lists further student columns to keep from the chosen row.
    """
    best = F.struct(exprs.nulls_last_key(*TIE_BREAK).alias("k"), F.struct(*payload).alias("p"))
    chosen = joined.groupBy("incident_id", "student_number").agg(F.min(best).alias("_best"))
    return chosen.select("incident_id", "student_number",
                         *[F.col(f"_best.k.v{i}").alias(c) for i, c in enumerate(TIE_BREAK)],
                         *[F.col(f"_best.p.{c}").alias(c) for c in payload])


def with_profile(chosen: DataFrame, stu: DataFrame, known: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``chosen`` with further ``fields`` of each row's student, from ``stu`` (``student_facts``).

    The student's row is met by all that the choice has of it (``known``: further columns chosen with it); of several
    such rows, the one with the smallest fields. So the choice itself carries short columns only."""
    keys = ["student_number", *[c for c in TIE_BREAK if c not in ("person_role", "student_id")], *known]
    rows = (stu.groupBy(F.col("student_id").alias("_student"), *[F.col(c).alias(f"_{c}") for c in keys])
            .agg(F.min(F.struct(*fields)).alias("_profile")))
    same = F.col("student_id") == F.col("_student")
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return chosen.join(growing(rows), same).select(*chosen.columns, *[F.col(f"_profile.{c}").alias(c) for c in fields])


def rank_within_student_number(rows: DataFrame, order: Sequence) -> DataFrame:
    """The source's ``ROW_NUMBER() OVER (PARTITION BY incident_id, student_number ORDER BY ...)``.

    Used on already reduced rows (one per incident and student), where groups hold a handful
    of rows; filtering ``row_num = 1`` is planned with a partial per-group limit before the
    shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy("incident_id", "student_number").orderBy(*order)
    return rows.withColumn("row_num", F.row_number().over(w))
