"""Scalar helpers: null-as-empty concatenation, decodes, masks, links (traps X1–X3, X7–X9)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from incidentlens.functions import codes, exprs


def one(spark, col, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


def test_cat_treats_null_as_empty(spark):
    assert one(spark, exprs.cat(F.col("x"), ", ", F.lit("b"))) == ", b"
    assert one(spark, exprs.person_name(F.col("x"), F.col("x"))) == ", "
    assert one(spark, exprs.full_address(F.col("x"), F.lit("C"), F.lit("MA"), F.col("x"))) == ", C, MA "


def test_cat_of_only_nulls_is_null(spark):
    assert one(spark, exprs.cat(F.col("x"), F.col("x"))) is None


@pytest.mark.parametrize("raw,label", [("yes", "Yes"), ("YES", "Yes"), ("No", "No"), ("ref", "Referral"),
                                       ("REF", "Referral"), ("other", "Unknown"), (None, "Unknown")])
def test_sped_decode(spark, raw, label):
    assert one(spark, exprs.sped_code("x"), row=(raw,)) == label


@pytest.mark.parametrize("raw,label", [("FRMR", "Former"), ("former", "Former"), ("no", "No"), ("No-P", "No-P"),
                                       ("Ref", "Referral"), ("yes", "Yes"), ("YES-P", "Yes-P"), ("x", "Unknown"),
                                       (None, "Unknown")])
def test_el_decode(spark, raw, label):
    assert one(spark, exprs.english_learner_code("x"), row=(raw,)) == label


@pytest.mark.parametrize("raw,label", [(None, "No SPED Data"), ("500", "Does not apply to student (500)"),
                                       ("01", "Low - Less than 2 hours of service per week (01)"),
                                       ("04", "High (04)"), ("99", "Unknown"), ("1", "Unknown")])
def test_level_of_need_decode_is_exact(spark, raw, label):
    col = exprs.recode("x", codes.LEVEL_OF_NEED_CODES, codes.RETIRED_DEFAULT, lower=False,
                       null_label=codes.NO_SPED_DATA)
    assert one(spark, col, row=(raw,)) == label


def test_disability_table_covers_01_to_13():
    keys = [k[0] for k, _ in codes.PRIMARY_DISABILITY_CODES]
    assert keys == ["500"] + [f"{i:02d}" for i in range(1, 14)]


def test_date_masks(spark):
    d = dt.date(2021, 3, 9)
    assert one(spark, exprs.date_text("x", codes.INCIDENT_DATE_MASK), "x date", (d,)) == "2021-03-09"
    assert one(spark, exprs.date_text("x", codes.PLAN_DATE_MASK), "x date", (d,)) == "03-09-2021"


def test_or_na_and_one_argument_to_char(spark):
    assert one(spark, exprs.or_na("x"), "x int", (None,)) == "N/A"
    assert one(spark, exprs.or_na("x"), "x int", (5,)) == "5"
    assert one(spark, exprs.or_na("x"), "x string", ("03-09-2021",)) == "03-09-2021"


def test_links(spark):
    row = spark.createDataFrame([(10, 1007, 5007)], "i long, d long, n long")
    got = row.select(exprs.incident_link("i").alias("a"), exprs.student_link("d", "n").alias("b")).first()
    assert got["a"] == "<a href=/admin/incidents/incidentlog.html?id=10 target=_blank>10</a>"
    assert got["b"] == "<a href=/admin/students/home.html?frn=0011007 target=_blank>5007</a>"


def test_nulls_last_key_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, None), (1, 3, 9)], "g int, a int, b int")
    best = df.groupBy("g").agg(F.min(exprs.nulls_last_key("a", "b")).alias("k")).first()["k"]
    assert (best["v0"], best["v1"]) == (3, 9)
