from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from incidentlens.session import build_session  # noqa: E402
from incidentlens.sources.tables import SCHEMAS, SisTables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="incidentlens-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


D = dt.date
TS = dt.datetime


def base_rows() -> dict[str, list[tuple]]:
    """A tiny consistent school system: one term, one school, two students, one incident."""
    return {
        "terms": [(1, "Y", D(2020, 9, 1), D(2021, 6, 30), 0, 1)],
        "incident": [(1, "Fight", TS(2020, 10, 5, 9, 0), 3, 100, 101)],
        "incident_detail": [
            (11, 1, 10, None),      # type detail
            (12, 1, 20, None),      # role detail (Offender)
            (13, 1, 30, 500),       # action detail
        ],
        "incident_lu_code": [(10, "incidenttypecode", "Violence"), (20, "participantcode", "Offender"),
                             (21, "participantcode", "Victim"), (30, "actioncode", "Action")],
        "incident_lu_sub_code": [(30, 500, "SUSP", "Suspension"), (30, 501, "DET", "Detention")],
        "incident_action": [(1, 13, "Resolved", D(2020, 10, 6), D(2020, 10, 8), 2, 2)],
        "incident_person_role": [(1, 7, 12)],
        "students": [(7, 1007, 5007, "S7", "Doe, Jane", 3, D(2010, 1, 2), "1 Main", "Town", "MA", "01000"),
                     (8, 1008, 5008, "S8", "Roe, Rick", 4, D(2011, 3, 4), None, "City", "MA", "02000")],
        "u_def_ext_students": [(1007, "yes", "Former"), (1008, "REF", "yes-p")],
        "schools": [(3, "NORTH"), (4, "SOUTH")],
        "teachers": [(100, "Smith, Ann"), (101, "Jones, Bob")],
        "current_selection": [(1007,)],
        "studentcontactassoc": [(1, 1007, 50), (2, 1007, 51)],
        "studentcontactdetail": [(1, 1), (2, 2)],
        "person": [(50, "Doe", "Mary"), (51, "Doe", "John")],
        "codeset": [(1, "Mother"), (2, "Father")],
        "s_ma_stu_sped_x": [(1007, "01", "05")],
    }


@pytest.fixture()
def make_tables(spark):
    def make(**changes) -> SisTables:
        rows = base_rows()
        for name, value in changes.items():
            rows[name] = value(rows[name]) if callable(value) else value
        return SisTables.from_frames({n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()})

    return make
