"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Every query reads the whole test data under ``sf_dir`` (SIS tables derived from it) with the
fixed run parameters of FIXTURES.md: range 1996-01-01..2000-12-31, school 7, selection =
``current_selection``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks import oracle
from ..operators import fanout
from ..operators.scope import District, School, Selection
from ..operators.terms import DateWindow
from ..session import checkpoint_dir
from ..sources import layout
from ..sources.fixtures import REPORT_END, REPORT_SCHOOL, REPORT_START, materialize, publish
from ..sources.tables import SCHEMAS, SisTables
from . import manifest, report, sqlsteps, steps
from .batch import ReportBatch
from .watch import ReportWatch

WINDOW = DateWindow(dt.date.fromisoformat(REPORT_START), dt.date.fromisoformat(REPORT_END))
SCOPES = {"selection": lambda: Selection(), "school": lambda: School(REPORT_SCHOOL), "district": lambda: District()}


class StoredTables(SisTables):
    """SIS tables derived from the test data, each stored once as Parquet in the session's
    checkpoint folder (see ``fixtures.materialize``) when a query first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        object.__setattr__(self, "_source", (spark, sf_dir, f"{checkpoint_dir(spark).rstrip('/')}/fixtures"))

    def __getattribute__(self, name: str):
        if name not in SCHEMAS:
            return object.__getattribute__(self, name)
        spark, sf_dir, root = self._source
        stored = materialize(spark, sf_dir, root, [name])
        return spark.read.schema(SCHEMAS[name]).parquet(f"{stored}/{name}")


    def root(self) -> str:
        """The folder of this test data's stored tables."""
        spark, sf_dir, root = self._source
        return materialize(spark, sf_dir, root, [])


def tables(spark: SparkSession, sf_dir: str) -> SisTables:
    return StoredTables(spark, sf_dir)


def _report(scope: str, detailed: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report.incident_report(tables(spark, sf_dir), SCOPES[scope](), WINDOW, detailed=detailed)

    run.__name__ = f"report_{scope}{'_detailed' if detailed else ''}"
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

for _scope in SCOPES:
    for _detailed in (False, True):
        _name = f"report_{_scope}{'_detailed' if _detailed else ''}"
        QUERIES[_name] = _report(_scope, _detailed)
ORACLE_SQL.update(oracle.queries_sql())

TEXT_WINDOW = DateWindow("01/01/1996", "12/31/2000", "MM/dd/yyyy")
_DATES = {"start_date": "01/01/1996", "end_date": "12/31/2000", "date_format": "MM/dd/yyyy"}
_STEPS: dict[str, Callable[[SisTables], DataFrame]] = {
    "year_terms": steps.year_terms_step,
    "incident_date_range": lambda t: steps.incident_date_range(t, TEXT_WINDOW),
    "incident_in_term": steps.incident_in_term,
    "scope_school": lambda t: steps.scope_students(t, School(REPORT_SCHOOL)),
    "scope_selection": lambda t: steps.scope_students(t, Selection()),
    "incident_category": steps.incident_category,
    "incident_location": steps.incident_location,
    "action_resolution": steps.action_resolution,
    "action_code": steps.action_code,
    "action_plan": steps.action_plan,
    "action_plan_choice": steps.action_plan_choice,
    "incident_base": lambda t: steps.incident_base(t, WINDOW),
    "action_plan_display": lambda t: steps.action_plan_display(t, WINDOW),
    "action_resolution_display": lambda t: steps.action_resolution_display(t, WINDOW),
    "incident_school": steps.incident_school,
    "incident_staff": steps.incident_staff,
    "staff_names": steps.staff_names,
    "incident_link": steps.incident_link,
    "student_base": steps.student_base,
    "sped_code": steps.sped_code,
    "english_learner_code": steps.english_learner_code,
    "student_profile": steps.student_profile,
    "student_link": steps.student_link,
    "student_contacts": steps.student_contacts,
    "sped_level_of_need": steps.sped_level_of_need,
    "primary_disability": steps.primary_disability,
    "person_role": steps.person_role,
    "person_role_in_scope": lambda t: steps.person_role_in_scope(t, School(REPORT_SCHOOL)),
    "participants": lambda t: steps.participants_step(t, WINDOW),
    "participant_role": lambda t: steps.participant_role(t, WINDOW),
    "top_action_per_student": lambda t: steps.top_action_per_student(t, District(), WINDOW),
    "ranked_results": lambda t: steps.ranked_results(t, District(), WINDOW),
    "report_order": lambda t: steps.report_order(t, WINDOW),
    "report_labelled": lambda t: steps.report_labelled(t, WINDOW),
    "fanout_counts": lambda t: fanout.fanout_counts(t, District(), WINDOW),
    "row_number_ranges": lambda t: fanout.row_number_ranges(t, District(), WINDOW),
    "sql_incident_date_range": lambda t: sqlsteps.run(t, "incident_date_range", sqlsteps.parameters(**_DATES)),
    "sql_scope_school": lambda t: sqlsteps.run(t, "scope_school", sqlsteps.parameters(school_id=REPORT_SCHOOL)),
    "sql_incidents_of_school": lambda t: sqlsteps.run(t, "incidents_of_school", sqlsteps.parameters(**_DATES, school_id=REPORT_SCHOOL)),
}


MONTH = oracle.ONE_MONTH


def report_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The district report of one month from a store by month (``layout.write_monthly``)."""
    t = tables(spark, sf_dir)
    path = publish(spark, f"{t.root()}/by-month", lambda at: layout.write_monthly(t, at, files_per_month=1))
    window = DateWindow(*map(dt.date.fromisoformat, MONTH))
    return report.incident_report(layout.monthly_tables(spark, path, window), District(), window)


def report_school_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The school report from catalog tables in buckets of the detail id (``layout.write_bucketed``)."""
    t = tables(spark, sf_dir)
    root = t.root()
    database = f"sis_buckets_{root.rsplit('-', 1)[1]}"
    if not spark.catalog.databaseExists(database) or not all(spark.catalog.tableExists(f"{database}.{n}") for n in SCHEMAS):
        path = f"{root}/buckets-{uuid.uuid4().hex}"  # a catalog of its own session, files of its own
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}/db'")
        layout.write_bucketed(t, database, path, buckets=8)
    return report.incident_report(SisTables.from_catalog(spark, database, database), School(REPORT_SCHOOL), WINDOW)


def report_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and incidents of all six reports, run from one batch whose files are gone afterwards."""
    out = []
    with ReportBatch(tables(spark, sf_dir), WINDOW) as batch:
        for scope, make in SCOPES.items():
            for detailed in (False, True):
                df = batch.report(make(), detailed)
                n = df.agg(F.count("*"), F.count_distinct("incident_link"), F.count_distinct("student_link")).first()
                out.append((f"report_{scope}{'_detailed' if detailed else ''}", *n))
    return spark.createDataFrame(out, "report string, n_rows long, n_incidents long, n_students long")


def report_exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The district report as exported, each row with the position that the export's manifest gives it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/exports/{uuid.uuid4().hex}"
    report.export(report.incident_report(tables(spark, sf_dir), District(), WINDOW), path, "parquet", manifest=True)
    return manifest.with_positions(spark, path, "parquet")


def report_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the district report leaves out, counted while it is written."""
    watch = ReportWatch()
    report.incident_report(tables(spark, sf_dir), District(), WINDOW, watch=watch).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([watch.counts()], "unknown_school long, repeated_incidents long, unknown_students long, repeated_students long")


QUERIES.update({f.__name__: f for f in (report_month, report_school_bucketed, report_batch, report_exported, report_watch)})


def _step(name: str, fn: Callable[[SisTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables(spark, sf_dir))

    run.__name__ = name
    return run


for _name, _fn in _STEPS.items():
    QUERIES[_name] = _step(_name, _fn)
ORACLE_SQL.update(oracle.steps_sql())
