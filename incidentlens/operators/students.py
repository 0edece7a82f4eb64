"""Per-student facts: program codes, profile and guardians.

``id`` is the student key of participation rows, ``dcid`` the key of the extension,
selection and contact tables, and ``student_number`` the displayed number the report groups
on; the three are never interchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, exprs
from ..sources.tables import SisTables
from .joins import growing
from .scope import Scope

PROFILE_FIELDS = ("dob", "student_lastfirst", "mother_name", "father_name", "street", "city", "state", "zip",
                  "address_full")


def program_codes(t: SisTables) -> DataFrame:
    """``studentsdcid`` -> decoded SPED and EL codes (smallest decode if a student has several rows)."""
    return (t.u_def_ext_students
            .select("studentsdcid", exprs.sped_code("sped").alias("sped_code"),
                    exprs.english_learner_code("el").alias("english_learner_code"))
            .groupBy("studentsdcid")
            .agg(F.min("sped_code").alias("sped_code"), F.min("english_learner_code").alias("english_learner_code")))


def guardian_names(t: SisTables, students: DataFrame | None = None) -> DataFrame:
    """``dcid`` -> mother and father names (``LAST, FIRST``) from the contact tables.

    Only 'Mother'/'Father' relationships can contribute (the match is case-sensitive); a
    contact whose person row is missing still counts and yields ``', '``. With ``students``,
    only their contacts are read. Students with no such contact get no row here; the caller
    fills in 'Guardian not listed'.
    """
    t.require("studentcontactassoc", "studentcontactdetail", "person", "codeset")
    rel = (t.codeset.where(F.col("description").isin(codes.MOTHER, codes.FATHER))
           .select(F.col("codesetid").alias("relationshiptypecodesetid"), "description"))
    assoc = t.studentcontactassoc.select("studentcontactassocid", F.col("studentdcid").alias("dcid"), "personid")
    if students is not None:
        assoc = assoc.join(growing(students.select("dcid")), "dcid", "left_semi")
    person = t.person.select(F.col("id").alias("personid"), "lastname", "firstname")
    named = (assoc.join(growing(t.studentcontactdetail.join(rel, "relationshiptypecodesetid")), "studentcontactassocid")
             .join(growing(person), "personid", "left")
             .select("dcid", "description", exprs.person_name("lastname", "firstname").alias("name")))
    return named.groupBy("dcid").agg(
        F.max(F.when(F.col("description") == codes.MOTHER, F.col("name"))).alias("mother_name"),
        F.max(F.when(F.col("description") == codes.FATHER, F.col("name"))).alias("father_name"))


def _listed(name: str) -> Column:
    """The guardian name, or 'Guardian not listed'. A student without a ``dcid`` has no contact
    row at all in the source (its join key is NULL), so the name stays NULL there."""
    listed = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(codes.GUARDIAN_NOT_LISTED))
    return F.when(F.col("dcid").isNotNull(), listed).alias(name)


def student_facts(t: SisTables, scope: Scope, detailed: bool = False) -> DataFrame:
    """One row per student in scope with everything the report shows about the student.

    ``id`` is the table's primary key, so the decodes are joined per row by ``dcid``. The result
    is then shuffled by ``id`` for the participation join, which leaves that join with two
    shuffle stages and lets AQE split a student who appears in a third of all participations.
    """
    stu = scope.students(t)
    base = (stu.join(growing(program_codes(t)), stu["dcid"] == F.col("studentsdcid"), "left")
            .select(F.col("id").alias("student_id"), "student_number", "dcid",
                    F.col("state_studentnumber").alias("state_id"),
                    F.col("lastfirst").alias("student_lastfirst"),
                    F.coalesce("sped_code", F.lit(codes.SPED_DEFAULT)).alias("sped_code"),
                    F.coalesce("english_learner_code", F.lit(codes.EL_DEFAULT)).alias("english_learner_code"),
                    "dob", "street", "city", "state", "zip"))
    if not detailed:
        return base.drop("dob", "street", "city", "state", "zip")
    guardians = guardian_names(t, stu)
    return (base.join(growing(guardians), "dcid", "left")
            .select("student_id", "student_number", "dcid", "state_id", "sped_code", "english_learner_code",
                    exprs.date_text("dob", codes.INCIDENT_DATE_MASK).alias("dob"), "student_lastfirst",
                    _listed("mother_name"), _listed("father_name"), "street", "city", "state", "zip",
                    exprs.full_address("street", "city", "state", "zip").alias("address_full")))
