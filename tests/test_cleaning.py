import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimwright.functions.columns import amount, content_digest, spread_nulls, strict_date
from claimwright.operators import cleaning as c
from rows import frame


def test_blank_becomes_null_and_others_are_not_trimmed(spark):
    df = spark.createDataFrame([("x", ""), ("  ", " y")], "a string, b string")
    assert [tuple(r) for r in c.blank_to_null(df, ["a", "b"]).collect()] == [("x", None), (None, " y")]


def test_ensure_columns(spark):
    df = c.ensure_columns(spark.createDataFrame([("C1",)], "claim_id string"), ["claim_id", "adjustment_amount"])
    assert df.dtypes == [("claim_id", "string"), ("adjustment_amount", "string")]
    assert df.first()["adjustment_amount"] is None
    assert c.ensure_columns(df, ["flag"], default="n").first()["flag"] == "n"


@pytest.mark.parametrize("text, day", [
    ("2024-02-29", dt.date(2024, 2, 29)), ("2023-02-29", None), ("2024-1-5", None), (" 2024-01-05", None),
    ("2024-01-05 ", None), ("2024-01-05T", None), ("2024-01-05\n", None), ("0000-01-01", None), ("", None),
    ("not-a-date", None), (None, None),
])
def test_only_strict_dates_are_read_and_bad_ones_do_not_fail(spark, text, day):
    assert spark.createDataFrame([(text,)], "d string").select(strict_date("d")).first()[0] == day


@pytest.mark.parametrize("text, value", [("12.345", "12.35"), ("-5", "-5.00"), ("abc", None), ("", None), (" ", None), ("99999999999", None)])
def test_amounts(spark, text, value):
    got = spark.createDataFrame([(text,)], "a string").select(amount("a")).first()[0]
    assert got == (None if value is None else Decimal(value))


def test_members_are_typed(spark):
    row = c.clean_members(frame(spark, "members", {"state": " ca ", "gender": "f", "zip_code": " 1 "})).first()
    assert (row.state, row.gender, row.zip_code, row.enrollment_end_date) == ("CA", "F", "1", None)
    assert row.date_of_birth == dt.date(1984, 7, 19)


def test_claims_are_typed_and_status_keeps_its_case(spark):
    raw = frame(spark, "claims", {"diagnosis_code": "e11", "claim_status": "Paid ", "paid_amount": ""}).drop("adjustment_amount")
    row = c.clean_claims(raw).first()
    assert (row.diagnosis_code, row.claim_status, row.paid_amount, row.adjustment_amount) == ("E11", "Paid", None, None)
    assert row.billed_amount == Decimal("143.50")


def test_cleaning_is_one_projection(spark):
    plan = c.clean_claims(frame(spark, "claims", {}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_key_set_has_no_null_and_no_copy(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r.k for r in c.key_set(df, "k").collect()] == ["a"]


def test_digest_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(content_digest(["x", "y"])).distinct().count() == 1


def test_null_keys_spread_over_many_values(spark):
    df = spark.range(1000).select("id", F.lit(None).cast("string").alias("k"))
    keys = df.select(spread_nulls("k", *df.columns).alias("s"))
    assert keys.filter("s is null").count() == 0
    assert keys.distinct().count() > 500
