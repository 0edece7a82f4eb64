"""What a report run leaves out, counted while it runs.

Inner joins drop incidents of unknown schools and participations of unknown students without a word, and a
key listed twice multiplies rows. ``ReportWatch`` counts these with ``DataFrame.observe`` as rows pass, without a
job of its own; the numbers are there when the report has been written or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..operators.joins import growing


class ReportWatch:
    """Counts of one report run:

    ``unknown_school`` incidents that could be shown but for their school; ``repeated_incidents`` rows beyond the first of an
    incident id; ``unknown_students`` participations (one for each of their roles) in the window's incidents whose student is not in
    the student table, counted by reports on the whole district (others read their own students' only);
    ``repeated_students`` rows beyond the first of a student id."""

    def __init__(self):
        self.incidents, self.students, self.participations = Observation(), Observation(), Observation()
        self._district = False

    def over_incidents(self, df: DataFrame) -> DataFrame:
        """``df`` joined to schools by an outer join: count, and drop what has no school.

        Rows are numbered where they are already together by incident, and dealt anew behind the count: the sort of a
        report samples the stage in front of it, which would count twice."""
        seen = df.observe(self.incidents, F.count_if(~F.col("_known")).alias("unknown_school"),
                          F.count_if(F.col("_known") & (F.col("_nth") > 1)).alias("repeated_incidents"))
        return seen.where("_known").drop("_known", "_nth").repartition(F.xxhash64("incident_id"))

    @staticmethod
    def numbered(df: DataFrame, key: str) -> DataFrame:
        return df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0))))

    def over_students(self, df: DataFrame) -> DataFrame:
        df = self.numbered(df, "student_id")
        return df.observe(self.students, F.count_if(F.col("_nth") > 1).alias("repeated_students")).drop("_nth")

    def over_participations(self, parts: DataFrame, students: DataFrame) -> DataFrame:
        """Participations joined to the district's students, those of unknown ones counted."""
        self._district = True
        met = parts.join(growing(students.withColumn("_known", F.lit(True))), "student_id", "left")
        return met.observe(self.participations, F.count_if(F.col("_known").isNull()).alias("unknown_students")).where("_known").drop("_known")

    def counts(self) -> dict[str, int]:
        """The numbers, after an action on the report."""
        out = {**self.incidents.get, **self.students.get}
        return out | (self.participations.get if self._district else {})
