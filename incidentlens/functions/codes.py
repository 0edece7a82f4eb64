"""Decode tables and fixed texts the reports must reproduce exactly.

FIXED VALUES — these strings must equal the source reports' values for the output to match.
They are listed in their natural order; keys are compared after lower-casing where noted.
"""

from __future__ import annotations

# ---- FIXED VALUES: program status decodes (input lower-cased before lookup) ----
SPED_CODES = [
    (("yes",), "Yes"),
    (("no",), "No"),
    (("ref",), "Referral"),
]
SPED_DEFAULT = "Unknown"

EL_CODES = [
    (("frmr", "former"), "Former"),
    (("no",), "No"),
    (("no-p",), "No-P"),
    (("ref",), "Referral"),
    (("yes",), "Yes"),
    (("yes-p",), "Yes-P"),
]
EL_DEFAULT = "Unknown"

# ---- FIXED VALUES: retired state special-education fields (exact match, not lower-cased) ----
NO_SPED_DATA = "No SPED Data"

LEVEL_OF_NEED_CODES = [
    (("500",), "Does not apply to student (500)"),
    (("01",), "Low - Less than 2 hours of service per week (01)"),
    (("02",), "Low - 2 hours or more of services per week (02)"),
    (("03",), "Moderate (03)"),
    (("04",), "High (04)"),
]

PRIMARY_DISABILITY_CODES = [
    (("500",), "Does not apply to student (500)"),
    (("01",), "Intellectual (01)"),
    (("02",), "Sensory/Hard of Hearing or Deaf (02)"),
    (("03",), "Communication (03)"),
    (("04",), "Sensory/Vision Impairment or Blind (04)"),
    (("05",), "Emotional (05)"),
    (("06",), "Physical (06)"),
    (("07",), "Health (07)"),
    (("08",), "Specific Learning Disabilities (08)"),
    (("09",), "Sensory/Deafblind (09)"),
    (("10",), "Multiple Disabilities (10)"),
    (("11",), "Autism (11)"),
    (("12",), "Neurological (12)"),
    (("13",), "Developmental Delay (13)"),
]
RETIRED_DEFAULT = "Unknown"

# ---- FIXED VALUES: lookup selectors, guardians, placeholders ----
INCIDENT_TYPE_CODE = "incidenttypecode"
LOCATION_CODE = "locationcode"
MOTHER = "Mother"
FATHER = "Father"
GUARDIAN_NOT_LISTED = "Guardian not listed"
NOT_AVAILABLE = "N/A"

# ---- FIXED VALUES: link formats (text before and after the embedded values) ----
INCIDENT_LINK_PARTS = ("<a href=/admin/incidents/incidentlog.html?id=", " target=_blank>", "</a>")
STUDENT_LINK_PARTS = ("<a href=/admin/students/home.html?frn=001", " target=_blank>", "</a>")

# ---- FIXED VALUES: date masks of the displayed dates ----
INCIDENT_DATE_MASK = "yyyy-MM-dd"     # incident date, birth date
PLAN_DATE_MASK = "MM-dd-yyyy"         # action plan begin / end

# ---- FIXED VALUES: column labels of the exported report, by column meaning ----
COLUMN_LABELS = {
    "student_link": "Student Number",
    "state_id": "State ID",
    "dob": "DOB",
    "student_lastfirst": "Student Name",
    "mother_name": "Mother Name",
    "father_name": "Father Name",
    "street": "Street",
    "city": "City",
    "state": "State",
    "zip": "Zip",
    "address_full": "Full Address",
    "sped_code": "SPED",
    "english_learner_code": "EL",
    "incident_ts": "Incident Date",
    "incident_link": "Incident ID",
    "incident_title": "Incident Title",
    "person_role": "Incident Role",
    "action_short_desc": "Action Code",
    "action_resolved_desc": "Action Resolved",
    "incident_category": "Incident Category",
    "action_plan_begin_dt": "Action Plan Begin Date",
    "action_plan_end_dt": "Action Plan End Date",
    "duration_assigned": "Duration Assigned",
    "duration_actual": "Duration Actual",
    "created_by_name": "Created By",
    "last_modified_by_name": "Last Modified By",
    "school_abbreviation": "School Abbreviation",
}

# ---- FIXED VALUES: output columns, in order ----
BASE_COLUMNS = [
    "student_link", "state_id", "sped_code", "english_learner_code", "incident_ts", "incident_link",
    "incident_title", "person_role", "action_short_desc", "action_resolved_desc", "incident_category",
    "action_plan_begin_dt", "action_plan_end_dt", "duration_assigned", "duration_actual",
    "created_by_name", "last_modified_by_name", "school_abbreviation",
]
DETAIL_COLUMNS = [
    "student_link", "state_id", "dob", "student_lastfirst", "mother_name", "father_name",
    "street", "city", "state", "zip", "address_full",
] + BASE_COLUMNS[2:]
