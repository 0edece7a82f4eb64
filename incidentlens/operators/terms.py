"""Date range and school-year terms.

An incident counts when its timestamp lies in the run's date range and in at least one
full-year district term. Both tests are ``BETWEEN`` a timestamp and two dates, so the upper
bound is midnight at the start of the last day: an incident at 10:00 on the last day is out.
That is the source behaviour and is kept (never cast the timestamp to a date first).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A day's incidents are dealt over this many join keys, so one busy day is not one task.
DAY_PARTS = 16


@dataclass(frozen=True)
class DateWindow:
    """Inclusive date range of a report run.

    ``start``/``end`` are ``datetime.date`` values, or text parsed with ``fmt`` (a Spark
    datetime pattern such as ``yyyy-MM-dd`` or ``MM/dd/yyyy``). Text is parsed once, when the
    window is first used; text that does not parse raises, whatever the session's ANSI setting.
    """

    start: dt.date | str
    end: dt.date | str
    fmt: str = "yyyy-MM-dd"

    def _bound(self, value: dt.date | str) -> Column:
        return F.lit(self.date(value))

    def date(self, value: dt.date | str) -> dt.date:
        if isinstance(value, dt.datetime):
            return value.date()
        if isinstance(value, dt.date):
            return value
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise ValueError("text dates need an active Spark session")
        parsed = spark.range(1).select(F.try_to_timestamp(F.lit(value), F.lit(self.fmt)).cast("date").alias("d")).first()["d"]
        if parsed is None:
            raise ValueError(f"{value!r} is not a date of the form {self.fmt!r}")
        return parsed

    @property
    def start_col(self) -> Column:
        return self._bound(self.start)

    @property
    def end_col(self) -> Column:
        return self._bound(self.end)

    def contains(self, ts: Column) -> Column:
        return ts.between(self.start_col, self.end_col)


def year_terms(terms: DataFrame) -> DataFrame:
    """District-level full-year terms (``portion = 1`` at school 0)."""
    return (terms.where((F.col("portion") == 1) & (F.col("schoolid") == 0))
            .select("dcid", "abbreviation", "FirstDay", "LastDay", "schoolid"))


def within_terms(df: DataFrame, ts_col: str, terms: DataFrame, spread: str, window: DateWindow | None = None) -> DataFrame:
    """Rows of ``df`` whose ``ts_col`` lies between ``FirstDay`` and ``LastDay`` of some term.

    A left-semi join: a row inside two overlapping terms is kept once, and no term column is
    carried. Each term is expanded into its days and, per day, only the latest last day of the
    terms covering it is kept: an incident on day ``d`` is inside some term exactly when
    ``ts <= that latest last day`` (midnight). The expansion is clipped to ``window`` or, without
    one, to the days ``df`` has, so an open-ended term adds no more days than the run can meet;
    the last day compared with stays the term's own. ``spread`` names a column whose hash deals
    one day's rows over ``DAY_PARTS`` keys.
    """
    if window is None:
        span = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
        low, high = (F.to_date(span.select(c).scalar()) for c in ("lo", "hi"))
    else:
        low, high = window.start_col, window.end_col
    spans = (terms.select(F.greatest("FirstDay", low).alias("_first"), F.least("LastDay", high).alias("_until"),
                          F.col("FirstDay").alias("_from"), F.col("LastDay").alias("_last"))
             .where(F.col("_from").isNotNull() & F.col("_last").isNotNull() & (F.col("_first") <= F.col("_until"))))
    days = (spans.select(F.explode(F.sequence("_first", "_until")).alias("_day"), "_last")
            .groupBy("_day").agg(F.max("_last").alias("_last"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(DAY_PARTS - 1))).alias("_part")))
    cond = ((F.to_date(F.col(ts_col)) == F.col("_day")) & (F.pmod(F.hash(spread), F.lit(DAY_PARTS)) == F.col("_part"))
            & (F.col(ts_col) <= F.col("_last")))
    return df.join(days, cond, "left_semi")
