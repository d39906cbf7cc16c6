import datetime as dt
import hashlib
import random

import pytest

from claimwright.operators import assertions as t
from claimwright.operators import asof, versions
from claimwright.plans import analytics, gold


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def history(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, v int")


def random_versions(seed, keys=5, size=120, span=40):
    rng = random.Random(seed)
    rows = {(f"k{rng.randrange(keys)}", day(rng.randrange(span)), i) for i in range(size)}
    # One key holds a third of all rows.
    return sorted(rows | {("hot", day(rng.randrange(span)), 1000 + i) for i in range(size // 2)})


def expected_validity(rows):
    out = {}
    for k in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == k)
        for here, after in zip(mine, [*mine[1:], None]):
            out[here] = after[1] if after else None
    return out


@pytest.mark.parametrize("seed", range(3))
def test_validity_equals_a_lead_over_each_key(spark, seed):
    rows = random_versions(seed)
    got = {(r.k, r.d, r.v): (r.valid_to, r.is_current) for r in versions.with_validity(history(spark, rows), "k", "d", ["v"]).collect()}
    want = expected_validity(rows)
    assert got == {key: (to, to is None) for key, to in want.items()}
    assert sum(current for _, current in got.values()) == len({r[0] for r in rows})


@pytest.mark.parametrize("seed", range(3))
def test_lookup_of_the_version_valid_on_a_day(spark, seed):
    rows = random_versions(seed)
    table = versions.with_validity(history(spark, rows), "k", "d", ["v"])
    rng = random.Random(seed)
    facts = [(i, rng.choice(["hot", "k0", "k1", "unknown", None]), rng.choice([None, *[day(n) for n in range(-40, 120)]])) for i in range(300)]
    got = {r.id: r.v for r in asof.valid_on(spark.createDataFrame(facts, "id int, k string, at date"), "k", "at", table, {"v": "v"}).collect()}
    want = expected_validity(rows)
    for i, k, at in facts:
        valid = [v for (key, start, v), end in want.items() if key == k and at and start <= at and (end is None or at < end)]
        assert [got[i]] == (valid or [None])
    assert len(got) == len(facts)


def test_months_of_long_versions_are_not_broadcast(spark):
    """A small table of versions covers many more months than it has rows."""
    table = versions.with_validity(history(spark, random_versions(0)), "k", "d", ["v"])
    facts = spark.createDataFrame([(1, "hot", day(9000)), (2, "k0", day(-9000))], "id int, k string, at date")
    found = asof.valid_on(facts, "k", "at", table, {"v": "v"})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2
    assert [r.v is None for r in found.orderBy("id").collect()] == [False, True]


def test_surrogate_key_is_null_without_a_date(spark):
    df = history(spark, [("a", day(0), 1), ("a", None, 2)])
    keys = [r[0] for r in df.orderBy("v").select(versions.surrogate_key("k", "d")).collect()]
    assert keys == [hashlib.md5(b"a|2020-01-01").hexdigest(), None]


def claim(**change):
    row = {"claim_id": "C1", "member_id": "M1", "provider_id": "P1", "diagnosis_code": "E11", "service_date": day(0),
           "service_year_month": "2020-01", "claim_status": "Paid", "denial_reason": None, "billed_amount": 100.0,
           "paid_amount": 80.0, "is_late_arriving": False, "days_late": 1} | change
    return row


CLAIM_TYPES = ("claim_id string, member_id string, provider_id string, diagnosis_code string, service_date date, service_year_month string, "
               "claim_status string, denial_reason string, billed_amount double, paid_amount double, is_late_arriving boolean, days_late int")


@pytest.fixture(scope="module")
def star(spark):
    members = spark.createDataFrame(
        [("M1", "HMO", "CA", None, "F", dt.date(1988, 12, 31), True, "S"), ("M2", "PPO", "NY", "1", "M", None, False, "S"),
         ("M3", "PPO", "NY", "1", "M", dt.date(1995, 6, 1), False, "S")],
        "member_id string, plan_type string, state string, zip_code string, gender string, date_of_birth date, has_missing_zip boolean, source_system string")
    providers = spark.createDataFrame(
        [("P1", "Old", None, "1", "IN", "CA", day(-100), "S"), ("P1", "New", "(unknown)", "1", "OUT", "CA", day(50), "S"),
         ("P2", "Two", None, "1", "IN", "CA", day(0), "S"), ("P3", "Three", " ", None, "IN", "CA", day(0), "S")],
        "provider_id string, provider_name string, specialty string, npi string, network_status string, address_state string, effective_date date, source_system string")
    rows = [claim(), claim(claim_id="C2", claim_status="DENIED", paid_amount=None, provider_id="P2", is_late_arriving=True, days_late=50),
            claim(claim_id="C3", member_id=None, provider_id="P9", claim_status=None, days_late=None),
            claim(claim_id="C4", member_id="M3", service_date=day(60), service_year_month="2020-03", is_late_arriving=True, days_late=61)]
    names = [x.split()[0] for x in CLAIM_TYPES.split(", ")]
    claims = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CLAIM_TYPES)
    tables = gold.build_gold({"members": members, "providers": providers, "claims": claims})
    return tables | {"claims": claims, "quarantine_claims": spark.createDataFrame([("a; b",), ("a",), ("a",)], "rejection_reason string")}


def test_fact_uses_the_current_version_and_keeps_unmatched_claims(star):
    rows = {r.claim_id: r for r in star["fact_claims"].collect()}
    assert (rows["C1"].network_status, rows["C1"].provider_specialty, rows["C1"].member_state) == ("OUT", "(unknown)", "CA")
    assert (rows["C3"].provider_sk, rows["C3"].member_state, rows["C3"].is_denied) == (None, None, 0)
    assert (rows["C2"].is_denied, rows["C2"].unpaid_amount, rows["C1"].unpaid_amount) == (1, None, 20.0)


def test_the_lookup_reads_the_facts_once(spark, tmp_path):
    facts = spark.createDataFrame([(1, "a", dt.date(2024, 3, 5)), (2, "a", None), (3, None, dt.date(2024, 1, 1))], "id int, k string, at date")
    facts.write.parquet(str(tmp_path / "facts"))
    table = spark.createDataFrame([("a", dt.date(1990, 1, 1), None, 7)], "k string, valid_from date, valid_to date, v int")
    read = spark.read.parquet(str(tmp_path / "facts"))
    found = asof.valid_on(read, "k", "at", table, {"v": "v"})
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.id: r.v for r in found.collect()} == {1: 7, 2: None, 3: None}
    none = asof.valid_on(read.filter("at is null"), "k", "at", table, {"v": "v"})
    assert [(r.id, r.v) for r in none.collect()] == [(2, None)]


def test_fact_as_of_uses_the_version_of_the_day(star):
    rows = {r.claim_id: r for r in gold.fact_claims_as_of(star["claims"], star["dim_member"], star["dim_provider"]).collect()}
    assert len(rows) == 4
    assert (rows["C1"].network_status, rows["C4"].network_status, rows["C3"].network_status) == ("IN", "OUT", None)


def test_null_and_literal_unknown_stay_two_rows(star):
    rows = sorted(tuple(r) for r in analytics.claims_by_specialty(star).collect())
    assert rows == [("(unknown)", 2), ("(unknown)", 2)]


def test_age_bands_count_calendar_years(star):
    assert {r.age_band: r.members for r in analytics.members_by_age_band(star, as_of="2025-01-01").collect()} == {
        "30-39": 2, "unknown": 1}


def test_late_claims(star):
    assert tuple(analytics.late_claims(star).first()) == (2, 4, 50.0, 55.5, 61)


def test_missing_specialty_counts_blanks(star):
    assert tuple(analytics.missing_specialty(star).first()) == (2, 3, 66.67)


def test_shared_npis_cover_all_versions(star):
    assert [tuple(r) for r in analytics.shared_npis(star).collect()] == [("1", 2)]


def test_ratios_over_no_rows_are_null(star):
    empty = star | {"fact_claims": star["fact_claims"].limit(0)}
    assert analytics.denial_pct(empty).first().denial_pct is None
    assert analytics.late_claims(empty).first().late_pct is None
    assert analytics.avg_paid(empty).first()[0] is None


def test_top_k_has_one_answer(star):
    rows = [tuple(r) for r in analytics.top_providers_by_volume(star).collect()]
    assert rows == [("P1", "New", 2), ("P2", "Two", 1), ("P9", None, 1)]


def test_processing_trend_and_sketches(star):
    assert {r.service_year_month: r.avg_days for r in analytics.processing_time_trend(star).collect()} == {"2020-01": 25.5, "2020-03": 61.0}
    assert analytics.approximate_counts(star).first().member_ids == 2


def test_gold_passes_its_tests_and_violations_are_found(spark, star):
    counts = t.violation_counts(t.gold_tests(star))
    bad = {(r.table_name, r.column_name, r.test): r.violations for r in counts.collect()}
    assert len(bad) == 11
    # C3 has no member: the only violation.
    assert {k: n for k, n in bad.items() if n} == {("fact_claims", "member_id", "not_null"): 1}
    df = spark.createDataFrame([("a", 0), ("a", 2), (None, 1), (None, 2)], "k string, n int")
    assert [tuple(r) for r in t.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in t.accepted_values(df, "n", [0, 1]).collect()] == [(2, 2)]
    assert [tuple(r) for r in t.relationships(df, "k", spark.createDataFrame([("b",)], "id string"), "id").collect()] == [("a", 2)]


def test_dim_date_is_gapless(star):
    days = gold.dim_date(star["claims"])
    assert days.count() == 61 and days.select("date").distinct().count() == 61
    assert days.filter("date = '2020-02-29'").first().iso_weekday == 6
