import pytest
from pyspark.sql import functions as F

from claimwright.operators import cleaning as c
from claimwright.operators import validation as v
from rows import frame, reasons


def dims(spark):
    return [spark.createDataFrame([(k,)], "k string") for k in ("M1", "P1", "E11")]


def claims(spark, *changes):
    return v.validate_claims(c.clean_claims(frame(spark, "claims", *changes)), *dims(spark))


def test_member_rules(spark):
    rows = v.validate_members(c.clean_members(frame(
        spark, "members", {"member_id": "ok"}, {"member_id": "st", "state": "ZZ"}, {"member_id": "dob", "date_of_birth": "2999-01-01"},
        {"member_id": "two", "state": "ZZ", "date_of_birth": "2999-01-01"}, {"member_id": "nul", "state": "", "date_of_birth": ""},
        {"member_id": "", "zip_code": ""})), "2025-01-01")
    assert reasons(rows, "member_id") == {
        "ok": [], "st": ["invalid_state_code"], "dob": ["impossible_date_of_birth_future"],
        "two": ["invalid_state_code", "impossible_date_of_birth_future"], "nul": [], None: ["missing_member_id"]}
    assert [r.member_id for r in rows.filter("has_missing_zip").collect()] == [None]


def test_birth_on_the_day_itself_is_possible(spark):
    df = c.clean_members(frame(spark, "members", {"date_of_birth": "2025-01-01"}))
    assert reasons(v.validate_members(df, "2025-01-01"), "member_id") == {"M1": []}
    assert reasons(v.validate_members(df, "2024-12-31"), "member_id") == {"M1": ["impossible_date_of_birth_future"]}


def test_provider_rules_and_shared_npi(spark):
    rows = v.validate_providers(c.clean_providers(frame(
        spark, "providers", {"provider_id": "a", "npi": "1"}, {"provider_id": "b", "npi": "1", "address_state": "XX"},
        {"provider_id": "c", "npi": "2"}, {"provider_id": "c", "npi": "2", "effective_date": "2021-01-01"},
        {"provider_id": "d", "npi": ""}, {"provider_id": "e", "npi": "", "effective_date": "x", "specialty": " "},
        {"provider_id": "", "npi": "3"})))
    flags = {r.provider_id: r.has_duplicate_npi for r in rows.collect()}
    # b is quarantined and still counts as a second owner of NPI 1; a NULL NPI is never shared.
    assert flags == {"a": True, "b": True, "c": False, "d": False, "e": False, None: False}
    assert reasons(rows, "provider_id")["b"] == ["invalid_address_state"]
    assert reasons(rows, "provider_id")["e"] == ["missing_effective_date"]
    assert reasons(rows, "provider_id")[None] == ["missing_provider_id"]
    assert rows.filter("has_missing_specialty").count() == 1


def test_diagnosis_rules(spark):
    rows = v.validate_diagnoses(c.clean_diagnoses(frame(
        spark, "diagnoses", {}, {"diagnosis_code": " "}, {"diagnosis_code": "x", "diagnosis_description": "", "category": ""})))
    assert reasons(rows, "diagnosis_code") == {
        "E11": [], None: ["missing_diagnosis_code"], "X": ["missing_diagnosis_description", "missing_category"]}


def test_claim_rules(spark):
    rows = claims(
        spark, {"claim_id": "ok"}, {"claim_id": ""}, {"claim_id": "date", "service_date": "nope"},
        {"claim_id": "order", "submission_date": "2023-12-31"}, {"claim_id": "neg", "paid_amount": "-5.00"},
        {"claim_id": "unpaid", "paid_amount": ""}, {"claim_id": "garbage", "paid_amount": "abc"},
        {"claim_id": "status", "claim_status": "Void"}, {"claim_id": "nostatus", "claim_status": "", "paid_amount": ""},
        {"claim_id": "mem", "member_id": "M9"}, {"claim_id": "nulls", "member_id": "", "provider_id": " ", "diagnosis_code": ""},
        {"claim_id": "billed", "billed_amount": "x"})
    assert reasons(rows, "claim_id") == {
        "ok": [], None: ["missing_claim_id"], "date": ["invalid_or_missing_date"], "order": ["submission_before_service_date"],
        "neg": ["negative_paid_amount"], "unpaid": ["missing_paid_amount_for_paid_claim"],
        "garbage": ["missing_paid_amount_for_paid_claim"], "status": ["invalid_claim_status"], "nostatus": [],
        "mem": ["invalid_member_id_reference"],
        "nulls": ["invalid_member_id_reference", "invalid_provider_id_reference", "invalid_diagnosis_code_reference"],
        "billed": []}


def test_late_boundary(spark):
    rows = {r.claim_id: (r.is_late_arriving, r.days_late) for r in claims(
        spark, {"claim_id": "45", "submission_date": "2024-02-15"}, {"claim_id": "46", "submission_date": "2024-02-16"},
        {"claim_id": "none", "submission_date": ""}).collect()}
    assert rows == {"45": (False, 45), "46": (True, 46), "none": (False, None)}


def test_split_keeps_every_row_once(spark):
    valid, bad = v.split(claims(spark, {"claim_id": "ok"}, {"claim_id": "two", "member_id": "x", "claim_status": "Void"}))
    assert [r.claim_id for r in valid.collect()] == ["ok"]
    row = bad.first()
    assert row.rejection_reason == "invalid_claim_status; invalid_member_id_reference"
    assert row.validation_timestamp is not None and v.REASONS not in bad.columns


def test_a_key_set_holding_filler_text_does_not_resolve_null(spark):
    fillers = spark.range(4096).select(F.concat(F.lit("\u0000"), F.col("id").cast("string")).alias("k"))
    df = spark.createDataFrame([(None,), ("x",)], "fk string")
    from claimwright.operators.lookup import resolve_key

    assert {r.fk: r.found for r in resolve_key(df, "fk", fillers, "found").collect()} == {None: False, "x": False}


@pytest.mark.parametrize("most", [50_000, 0])
def test_keys_resolve_alike_by_list_and_by_row(spark, monkeypatch, most):
    from claimwright.operators import lookup

    monkeypatch.setattr(lookup.unresolved_keys, "__defaults__", (most,))
    values = [None, "a", "b", "x", ""]
    df = spark.createDataFrame([(i % 7, p, q) for i, (p, q) in enumerate((p, q) for p in values for q in values)] * 3, "n int, p string, q string").withColumn("_asked", F.lit(1))
    sides = {"p": spark.createDataFrame([("a",), ("b",)], "k string"), "q": spark.createDataFrame([("x",), ("",)], "k string")}
    out = lookup.resolve_keys(df, sides)
    assert out.columns == [*df.columns, "_found_p", "_found_q"] and out.count() == df.count()
    assert all(r._found_p == (r.p in ("a", "b")) and r._found_q == (r.q in ("x", "")) for r in out.collect())
    all_there = lookup.resolve_keys(df.filter("p = 'a'"), {"p": sides["p"]})
    assert {r._found_p for r in all_there.collect()} == {True}


def test_identity_tells_nulls_and_places_apart(spark):
    from claimwright.operators.lookup import row_identity

    rows = [("a", None), (None, "a"), ("a", "a"), ("", "a"), ("a", ""), (None, None), ("", ""), ("aa", ""), ("", "aa"), ("aa", None)]
    df = spark.createDataFrame(rows, "p string, q string")
    assert df.select(*row_identity(["p", "q"])).distinct().count() == len(rows)
