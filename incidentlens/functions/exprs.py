"""Column expressions shared by the reports. All are built-in Spark functions (no UDFs),
so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cat(*parts: ColumnOrName | object) -> Column:
    """String concatenation where a NULL part counts as empty text.

    The source reports concatenate with ``||`` on a database that treats NULL as ''; Spark's
    ``concat`` would return NULL instead. Plain Python values are taken as literals. A fully
    empty result is NULL, as on that database.
    """
    cols = []
    for p in parts:
        c = p if isinstance(p, Column) else F.lit(p)
        cols.append(F.coalesce(c.cast("string"), F.lit("")))
    return F.nullif(F.concat(*cols), F.lit(""))


def recode(value: ColumnOrName, table: Sequence[tuple[Iterable[str], str]], default: str,
           lower: bool = True, null_label: str | None = None) -> Column:
    """Decode a code column through a fixed table: ``CASE WHEN v IN (...) THEN label ... ELSE default``.

    With ``lower`` the value is lower-cased before the lookup. ``null_label`` (if given) is the
    label of a NULL code; otherwise NULL falls through to ``default``.
    """
    v = _col(value)
    key = F.lower(v) if lower else v
    out = None
    if null_label is not None:
        out = F.when(v.isNull(), F.lit(null_label))
    for keys, label in table:
        keys = list(keys)
        cond = key == F.lit(keys[0]) if len(keys) == 1 else key.isin(keys)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def sped_code(raw: ColumnOrName) -> Column:
    return recode(raw, codes.SPED_CODES, codes.SPED_DEFAULT)


def english_learner_code(raw: ColumnOrName) -> Column:
    return recode(raw, codes.EL_CODES, codes.EL_DEFAULT)


def as_text(value: ColumnOrName) -> Column:
    """One-argument ``TO_CHAR``: plain text of a number or date, identity on text."""
    return _col(value).cast("string")


def or_na(value: ColumnOrName) -> Column:
    """``COALESCE(TO_CHAR(x), 'N/A')``."""
    return F.coalesce(as_text(value), F.lit(codes.NOT_AVAILABLE))


def date_text(value: ColumnOrName, mask: str) -> Column:
    """``TO_CHAR(date_or_ts, mask)`` with a Spark datetime pattern (``yyyy-MM-dd``, ``MM-dd-yyyy``)."""
    return F.date_format(_col(value), mask)


def incident_link(incident_id: ColumnOrName) -> Column:
    head, mid, tail = codes.INCIDENT_LINK_PARTS
    i = _col(incident_id)
    return cat(head, i, mid, i, tail)


def student_link(dcid: ColumnOrName, student_number: ColumnOrName) -> Column:
    head, mid, tail = codes.STUDENT_LINK_PARTS
    return cat(head, _col(dcid), mid, _col(student_number), tail)


def full_address(street: ColumnOrName, city: ColumnOrName, state: ColumnOrName, zip_: ColumnOrName) -> Column:
    """``street, city, state zip`` with missing parts as empty text."""
    return cat(_col(street), ", ", _col(city), ", ", _col(state), " ", _col(zip_))


def person_name(last: ColumnOrName, first: ColumnOrName) -> Column:
    """``LAST, FIRST`` with missing parts as empty text (a missing person gives ``', '``)."""
    return cat(_col(last), ", ", _col(first))


def nulls_last_key(*cols: ColumnOrName) -> Column:
    """A struct whose natural order is the lexicographic ASC NULLS LAST order of ``cols``.

    ``min`` over it picks the whole smallest tuple in one aggregate (each member is preceded
    by its null flag, since a struct compares NULL members first).
    """
    members = []
    for i, c in enumerate(cols):
        c = _col(c)
        members.append(c.isNull().alias(f"n{i}"))
        members.append(c.alias(f"v{i}"))
    return F.struct(*members)
