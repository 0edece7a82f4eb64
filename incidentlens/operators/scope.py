"""Which students a report covers: a chosen selection, one school, or the whole district.

The scope is applied once, to the student table, where the source reports repeat it in
every student step. A school scope is a plain filter (pushed to the Parquet scan); a
selection is a left-semi join on ``dcid``, so a selection listing a student twice cannot
duplicate report rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import SisTables
from .joins import growing


class Scope:
    name = "scope"

    def students(self, t: SisTables) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class District(Scope):
    name = "district"

    def students(self, t: SisTables) -> DataFrame:
        return t.students


@dataclass(frozen=True)
class School(Scope):
    """Students enrolled at one school (the student's school, not the incident's)."""

    school_id: int
    name = "school"

    def students(self, t: SisTables) -> DataFrame:
        return t.students.where(F.col("schoolid") == F.lit(self.school_id))


@dataclass(frozen=True)
class Selection(Scope):
    """Students whose ``dcid`` is listed in ``chosen`` (a DataFrame with a ``dcid`` column).

    When ``chosen`` is None, the bundle's ``current_selection`` table is used.
    """

    chosen: DataFrame | None = None
    name = "selection"

    def students(self, t: SisTables) -> DataFrame:
        chosen = self.chosen if self.chosen is not None else t.current_selection
        if chosen is None:
            raise ValueError("a selection scope needs a DataFrame of chosen dcids")
        return t.students.join(growing(chosen.select("dcid")), "dcid", "left_semi")
