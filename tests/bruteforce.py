"""The reports without any reduction, in plain Python over lists of tuples (see conftest.base_rows).

Every participant row of an incident meets every type detail, resolution, role, action code and
plan, every school and staff row; the smallest of these combinations by the tie-break is kept for
each (incident, student number). Only for tables of a handful of rows."""

from __future__ import annotations

import itertools

from incidentlens.functions import codes
from incidentlens.sources.tables import SCHEMAS


class Low:
    """A sort key: ascending, NULL last."""

    def __init__(self, v):
        self.k = (v is None, v)

    def __lt__(self, o):
        return self.k < o.k if not (self.k[0] and o.k[0]) else False

    def __eq__(self, o):
        return self.k == o.k


class High(Low):
    """Descending, NULL last."""

    def __lt__(self, o):
        return self.k[0] < o.k[0] if self.k[0] != o.k[0] else (not self.k[0] and self.k[1] > o.k[1])


def _dicts(rows: dict[str, list[tuple]]) -> dict[str, list[dict]]:
    return {n: [dict(zip(SCHEMAS[n].fieldNames(), r)) for r in rs] for n, rs in rows.items()}


def _decode(value, table, default):
    return next((label for keys, label in table if value is not None and value.lower() in keys), default)


def _text(*parts) -> str:
    return "".join("" if p is None else str(p) for p in parts)


def _midnight(d):
    import datetime as dt

    return dt.datetime(d.year, d.month, d.day)


def report(rows: dict[str, list[tuple]], scope: str, detailed: bool, school: int, first, last) -> list[tuple]:
    t = _dicts(rows)
    within = lambda ts, a, b: a is not None and b is not None and _midnight(a) <= ts <= _midnight(b)
    chosen = {r["dcid"] for r in t["current_selection"]}
    best: dict[tuple, tuple] = {}
    for part in t["incident_person_role"]:
        for inc, stu in itertools.product(t["incident"], t["students"]):
            if part["incident_id"] != inc["incident_id"] or part["studentid"] != stu["id"]:
                continue
            if scope == "school" and stu["schoolid"] != school or scope == "selection" and stu["dcid"] not in chosen:
                continue
            ts = inc["incident_ts"]
            if not within(ts, first, last) or not any(
                    y["schoolid"] == 0 and y["portion"] == 1 and within(ts, y["FirstDay"], y["LastDay"]) for y in t["terms"]):
                continue
            details = {d["incident_detail_id"]: d for d in t["incident_detail"]}
            listed = [c for d in t["incident_detail"] if d["incident_id"] == inc["incident_id"]
                      for c in t["incident_lu_code"] if c["lu_code_id"] == d["lu_code_id"]]
            categories = [c["incident_category"] for c in listed if c["code_type"] == "incidenttypecode"]
            schools = [h["abbreviation"] for h in t["schools"] if h["school_number"] == inc["school_number"]]
            actions = [a for a in t["incident_action"] if a["incident_id"] == inc["incident_id"]]
            action_codes = [s["short_desc"] for a in actions if (d := details.get(a["action_incident_detail_id"]))
                            for s in ([s for s in t["incident_lu_sub_code"] if s["lu_sub_code_id"] == d["lu_sub_code_id"]]
                                      or [{"short_desc": None}])]
            plans = [(a["action_plan_begin_dt"], a["action_plan_end_dt"], a["duration_assigned"], a["duration_actual"])
                     for a in actions]
            roles = [c["incident_category"] for q in t["incident_person_role"]
                     if q["incident_id"] == inc["incident_id"] and q["studentid"] == stu["id"]
                     and (d := details.get(q["role_incident_detail_id"]))
                     for c in t["incident_lu_code"] if c["lu_code_id"] == d["lu_code_id"]]
            ext = [x for x in t["u_def_ext_students"] if stu["dcid"] is not None and x["studentsdcid"] == stu["dcid"]]
            speds = [_decode(x["sped"], codes.SPED_CODES, codes.SPED_DEFAULT) for x in ext]
            els = [_decode(x["el"], codes.EL_CODES, codes.EL_DEFAULT) for x in ext]
            staff = lambda who: [w["lastfirst"] for w in t["teachers"] if w["id"] == who]
            for code, plan, role, category, done, sped, el, abbr, made, changed in itertools.product(
                    action_codes or [None], plans or [(None,) * 4], roles or [None], categories,
                    {a["action_resolved_desc"] for a in actions} or {None}, speds or [codes.SPED_DEFAULT],
                    els or [codes.EL_DEFAULT], schools, staff(inc["created_by"]) or [None],
                    staff(inc["last_modified_by"]) or [None]):
                order = (High(code), *map(Low, plan), Low(role), Low(sped), Low(el), Low(stu["dcid"]), Low(stu["id"]),
                         Low(category), Low(done), Low(abbr), Low(made), Low(changed))
                key = (inc["incident_id"], stu["student_number"])
                if key not in best or order < best[key][0]:
                    best[key] = (order, inc, stu, code, plan, role, category, done, sped, el, abbr, made, changed)
    return [_row(t, *found, detailed=detailed) for found in best.values()]


def _row(t, _, inc, stu, code, plan, role, category, done, sped, el, abbr, made, changed, detailed) -> tuple:
    na = lambda v: "N/A" if v is None else str(v)
    plan_day = lambda d: "N/A" if d is None else d.strftime("%m-%d-%Y")
    guardians = {}
    for who in ("Mother", "Father"):
        names = []
        for g in t["studentcontactassoc"]:
            kinds = [k["description"] for r in t["studentcontactdetail"] if r["studentcontactassocid"] == g["studentcontactassocid"]
                     for k in t["codeset"] if k["codesetid"] == r["relationshiptypecodesetid"]]
            if g["studentdcid"] == stu["dcid"] and who in kinds:
                people = [p for p in t["person"] if p["id"] == g["personid"]] or [{"lastname": None, "firstname": None}]
                names += [_text(p["lastname"], ", ", p["firstname"]) for p in people]
        guardians[who] = None if stu["dcid"] is None else (max(names) if names else codes.GUARDIAN_NOT_LISTED)
    out = {
        "student_link": _text("<a href=/admin/students/home.html?frn=001", stu["dcid"], " target=_blank>",
                              stu["student_number"], "</a>"),
        "incident_link": _text("<a href=/admin/incidents/incidentlog.html?id=", inc["incident_id"], " target=_blank>",
                               inc["incident_id"], "</a>"),
        "state_id": stu["state_studentnumber"], "sped_code": sped, "english_learner_code": el, "person_role": role,
        "incident_ts": inc["incident_ts"].strftime("%Y-%m-%d"), "incident_title": inc["incident_title"],
        "action_short_desc": code, "action_resolved_desc": na(done), "incident_category": category,
        "action_plan_begin_dt": plan_day(plan[0]), "action_plan_end_dt": plan_day(plan[1]), "duration_assigned": na(plan[2]),
        "duration_actual": na(plan[3]), "created_by_name": made, "last_modified_by_name": changed, "school_abbreviation": abbr,
        "dob": stu["dob"] and stu["dob"].strftime("%Y-%m-%d"), "student_lastfirst": stu["lastfirst"],
        "mother_name": guardians["Mother"], "father_name": guardians["Father"], "street": stu["street"], "city": stu["city"],
        "state": stu["state"], "zip": stu["zip"],
        "address_full": _text(stu["street"], ", ", stu["city"], ", ", stu["state"], " ", stu["zip"]),
    }
    return tuple(out[c] for c in (codes.DETAIL_COLUMNS if detailed else codes.BASE_COLUMNS))
