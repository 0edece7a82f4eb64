"""Several reports of one date window from one computation of what they share.

The incidents of the window with all their values, and the participations with their roles, do not depend on who is
asked for. ``ReportBatch`` computes both once, writes them to the shared checkpoint folder and gives any report from there;
a scope then only filters. The files live as long as the batch: leaving the ``with`` block removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import incidents, participants, students
from ..operators.joins import growing
from ..operators.scope import District, Scope
from ..operators.terms import DateWindow
from ..session import checkpoint_dir
from ..sources.tables import SisTables
from . import report


class ReportBatch:
    """Reports over ``t`` within ``window``; use as a context manager, or call ``close`` after the last action."""

    def __init__(self, t: SisTables, window: DateWindow, detailed: bool = True):
        self.t, self.window, self.detailed = t, window, detailed
        self.spark = t.incident.sparkSession
        self.path = f"{checkpoint_dir(self.spark).rstrip('/')}/reports/{uuid.uuid4().hex}"
        try:
            self.facts = self._store("facts", incidents.incident_facts(t, window))
            keys = self.facts.select("incident_id")
            self.parts = self._store("participations", participants.participations(t, keys).distinct())
            self.students = self._store("students", students.student_facts(t, District(), detailed))
        except BaseException:
            self.close()
            raise

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def rows(self, scope: Scope, detailed: bool = False) -> DataFrame:
        """Unsorted report rows, as ``report.report_rows`` gives them."""
        if detailed and not self.detailed:
            raise ValueError("the batch was made without the details of students")
        stu, parts = self.students, self.parts
        if not isinstance(scope, District):
            stu = stu.join(growing(scope.students(self.t).select(F.col("id").alias("student_id"))), "student_id", "left_semi")
        return report.report_rows_of(parts, stu, self.facts, detailed)

    def report(self, scope: Scope, detailed: bool = False) -> DataFrame:
        """The report, sorted, with the columns of ``report.incident_report``."""
        columns = codes.DETAIL_COLUMNS if detailed else codes.BASE_COLUMNS
        return self.rows(scope, detailed).orderBy(*report.report_order()).select(*columns)

    def close(self) -> None:
        """Remove the batch's files; its reports cannot be run any more."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def __enter__(self) -> "ReportBatch":
        return self

    def __exit__(self, *_) -> None:
        self.close()
