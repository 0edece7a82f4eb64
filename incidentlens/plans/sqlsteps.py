"""Steps in SQL whose run parameters are named markers.

The text is fixed; dates, their format and the school reach it as bound values (``spark.sql(..., args=)``), tables as
DataFrames. A parameter is a value whatever it holds, so no text can change the statement; one that
is not a date, or not a whole number, raises.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..sources.tables import SisTables

#: A bound date: text by the format that comes with it, or an error.
_DAY = """coalesce(cast(try_to_timestamp(:{0}, :date_format) AS date),
    cast(raise_error(concat('not a date of the form ', :date_format, ': ', :{0})) AS date))"""
START, END = _DAY.format("start_date"), _DAY.format("end_date")

TEXTS: dict[str, str] = {
    "incident_date_range": f"""
SELECT incident_id, incident_ts FROM {{incident}} WHERE incident_ts BETWEEN {START} AND {END}""",
    "scope_school": """
SELECT id AS student_id, dcid, student_number, schoolid FROM {students} WHERE schoolid = :school_id""",
    # each is one statement for a client that holds no DataFrame code
    "incidents_of_school": f"""
SELECT i.incident_id, i.incident_ts, count(DISTINCT s.student_number) AS n_students
FROM {{incident}} i JOIN {{incident_person_role}} r ON r.incident_id = i.incident_id JOIN {{students}} s ON s.id = r.studentid
WHERE i.incident_ts BETWEEN {START} AND {END} AND s.schoolid = :school_id
  AND EXISTS (SELECT 1 FROM {{terms}} y WHERE y.portion = 1 AND y.schoolid = 0 AND i.incident_ts BETWEEN y.FirstDay AND y.LastDay)
GROUP BY i.incident_id, i.incident_ts""",
}


def parameters(start_date: str | None = None, end_date: str | None = None, date_format: str = "yyyy-MM-dd",
               school_id: int | str | None = None) -> dict[str, object]:
    """Values for the markers. A school given as text must be a whole number."""
    out: dict[str, object] = {}
    if start_date is not None or end_date is not None:
        out |= {"start_date": str(start_date), "end_date": str(end_date), "date_format": date_format}
    if school_id is not None:
        out["school_id"] = int(school_id)
    return out


def run(t: SisTables, name: str, args: Mapping[str, object]) -> DataFrame:
    """The named step over ``t``. Markers without a value, and values without a marker, raise."""
    text = TEXTS[name]
    needed = {a for a in ("start_date", "end_date", "date_format", "school_id") if f":{a}" in text}
    if needed != set(args):
        raise ValueError(f"{name} needs the parameters {sorted(needed)}; given: {sorted(args)}")
    used = {n: getattr(t, n) for n in ("incident", "incident_person_role", "students", "terms") if f"{{{n}}}" in text}
    spark = next(iter(used.values())).sparkSession
    return spark.sql(text, args=dict(args), **used)
