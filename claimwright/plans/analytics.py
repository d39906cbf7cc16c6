"""The analytical queries over the Gold tables.

Each takes the tables by name and returns a DataFrame. Groups are reduced before any join, and a
top-k closes its order with the key so that it has one answer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.functions.columns import money_avg, money_sum, percent
from claimwright.operators.validation import day
from claimwright.plans.gold import current

Tables = dict[str, DataFrame]
Query = Callable[..., DataFrame]

REGISTRY: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return register


def _rows(name: str = "claim_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def _denied() -> Column:
    return F.sum("is_denied").alias("denied_claims")


def _most(df: DataFrame, measure: str, *keys: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys])


def _by_month(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("service_year_month").asc_nulls_last())


# Claims ----------------------------------------------------------------------------------


@_query("q01_total_claims")
def total_claims(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(_rows("total_claims"))


@_query("q02_paid_claims")
def paid_claims(t: Tables) -> DataFrame:
    return t["fact_claims"].filter(F.lower("claim_status") == "paid").agg(_rows("paid_claims"))


@_query("q03_denied_claims")
def denied_claims(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(_denied())


@_query("q04_denial_pct")
def denial_pct(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(
        _denied(), _rows("total_claims"), percent(F.sum("is_denied"), F.count(F.lit(1))).alias("denial_pct")
    )


@_query("q05_claims_by_month")
def claims_by_month(t: Tables) -> DataFrame:
    return _by_month(t["fact_claims"].groupBy("service_year_month").agg(_rows(), _denied()))


@_query("q06_claims_by_state")
def claims_by_state(t: Tables) -> DataFrame:
    return _most(t["fact_claims"].groupBy("member_state").agg(_rows(), _denied()), "claim_count", "member_state")


@_query("q07_claims_by_diagnosis")
def claims_by_diagnosis(t: Tables) -> DataFrame:
    return _most(t["fact_claims"].groupBy("diagnosis_code").agg(_rows()), "claim_count", "diagnosis_code")


@_query("q08_claims_by_provider")
def claims_by_provider(t: Tables) -> DataFrame:
    return _most(t["fact_claims"].groupBy("provider_id").agg(_rows()), "claim_count", "provider_id")


def _unknown(column: str, alias: str) -> Column:
    return F.coalesce(column, F.lit("(unknown)")).alias(alias)


@_query("q09_claims_by_specialty")
def claims_by_specialty(t: Tables) -> DataFrame:
    """Grouped by the raw column: a NULL and a literal '(unknown)' stay two rows."""
    counted = t["fact_claims"].groupBy("provider_specialty").agg(_rows())
    named = counted.select(_unknown("provider_specialty", "provider_specialty"), "claim_count")
    return _most(named, "claim_count", "provider_specialty")


@_query("q10_top_providers_by_volume")
def top_providers_by_volume(t: Tables) -> DataFrame:
    """The ten are chosen before the names are looked up: a provider has one current version."""
    counted = t["fact_claims"].groupBy("provider_id").agg(_rows())
    top = _most(counted, "claim_count", "provider_id").limit(10)
    names = current(t["dim_provider"]).select("provider_id", "provider_name")
    named = top.join(names, "provider_id", "left").select("provider_id", "provider_name", "claim_count")
    return _most(named, "claim_count", "provider_id")


# Finance ---------------------------------------------------------------------------------


@_query("q11_total_billed")
def total_billed(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(money_sum("billed_amount").alias("total_billed_amount"))


@_query("q12_total_paid")
def total_paid(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(money_sum("paid_amount").alias("total_paid_amount"))


@_query("q13_billed_not_paid")
def billed_not_paid(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(money_sum("unpaid_amount").alias("total_adjustments_billed_not_paid"))


@_query("q14_avg_paid")
def avg_paid(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(money_avg("paid_amount").alias("avg_paid_amount"))


@_query("q15_avg_billed")
def avg_billed(t: Tables) -> DataFrame:
    return t["fact_claims"].agg(money_avg("billed_amount").alias("avg_billed_amount"))


@_query("q16_paid_by_month")
def paid_by_month(t: Tables) -> DataFrame:
    return _by_month(t["fact_claims"].groupBy("service_year_month").agg(money_sum("paid_amount").alias("total_paid")))


@_query("q17_billed_by_month")
def billed_by_month(t: Tables) -> DataFrame:
    return _by_month(
        t["fact_claims"].groupBy("service_year_month").agg(money_sum("billed_amount").alias("total_billed"))
    )


def _paid_per(t: Tables, key: str) -> DataFrame:
    return t["fact_claims"].groupBy(key).agg(_rows(), money_sum("paid_amount").alias("total_paid"))


@_query("q18_paid_by_diagnosis")
def paid_by_diagnosis(t: Tables) -> DataFrame:
    return _most(_paid_per(t, "diagnosis_code"), "total_paid", "diagnosis_code")


@_query("q19_paid_by_provider")
def paid_by_provider(t: Tables) -> DataFrame:
    return _most(_paid_per(t, "provider_id"), "total_paid", "provider_id")


@_query("q20_top_diagnoses_by_avg_paid")
def top_diagnoses_by_avg_paid(t: Tables, min_claims: int = 1) -> DataFrame:
    grouped = t["fact_claims"].groupBy("diagnosis_code").agg(_rows(), money_avg("paid_amount").alias("avg_paid"))
    return _most(grouped.filter(F.col("claim_count") >= min_claims), "avg_paid", "diagnosis_code").limit(10)


# Members ---------------------------------------------------------------------------------


@_query("q21_members_by_state")
def members_by_state(t: Tables) -> DataFrame:
    return _most(t["dim_member"].groupBy("state").agg(_rows("members")), "members", "state")


@_query("q22_claims_per_member")
def claims_per_member(t: Tables) -> DataFrame:
    return _most(t["fact_claims"].groupBy("member_id").agg(_rows()), "claim_count", "member_id")


@_query("q23_top_members_by_paid")
def top_members_by_paid(t: Tables) -> DataFrame:
    return _most(_paid_per(t, "member_id"), "total_paid", "member_id").limit(20)


@_query("q24_members_by_age_band")
def members_by_age_band(t: Tables, as_of: dt.date | str | None = None) -> DataFrame:
    """Ten-year bands of the difference in calendar years."""
    years = F.year(day(as_of)) - F.year("date_of_birth")
    low = (F.floor(years / 10) * 10).cast("int")
    band = F.concat_ws("-", low.cast("string"), (low + 9).cast("string"))
    labelled = t["dim_member"].select(
        F.when(F.col("date_of_birth").isNull(), "unknown").otherwise(band).alias("age_band")
    )
    return labelled.groupBy("age_band").agg(_rows("members")).orderBy("age_band")


@_query("q25_claims_per_distinct_member")
def claims_per_distinct_member(t: Tables) -> DataFrame:
    members = F.countDistinct("member_id")
    ratio = F.count(F.lit(1)).cast("double") / F.nullif(members, F.lit(0))
    return t["fact_claims"].agg(F.round(ratio, 2).alias("avg_claims_per_member"))


# Providers -------------------------------------------------------------------------------


@_query("q26_providers_by_specialty")
def providers_by_specialty(t: Tables) -> DataFrame:
    counted = current(t["dim_provider"]).groupBy("specialty").agg(_rows("provider_count"))
    return _most(counted.select(_unknown("specialty", "specialty"), "provider_count"), "provider_count", "specialty")


@_query("q27_providers_by_network")
def providers_by_network(t: Tables) -> DataFrame:
    counted = current(t["dim_provider"]).groupBy("network_status").agg(_rows("provider_count"))
    return _most(counted, "provider_count", "network_status")


@_query("q28_active_providers")
def active_providers(t: Tables) -> DataFrame:
    return current(t["dim_provider"]).agg(F.countDistinct("provider_id").alias("active_providers"))


@_query("q29_provider_history")
def provider_history(t: Tables) -> DataFrame:
    """All versions of the providers that have more than one."""
    several = t["dim_provider"].groupBy("provider_id").agg(_rows("n")).filter(F.col("n") > 1).select("provider_id")
    rows = t["dim_provider"].join(several, "provider_id", "left_semi")
    return rows.select(
        "provider_id", "provider_name", "network_status", "valid_from", "valid_to", "is_current"
    ).orderBy("provider_id", "valid_from", F.col("valid_to").asc_nulls_last())


@_query("q29b_versions_per_provider")
def versions_per_provider(t: Tables) -> DataFrame:
    return _most(t["dim_provider"].groupBy("provider_id").agg(_rows("version_count")), "version_count", "provider_id")


@_query("q30_volume_by_specialty")
def volume_by_specialty(t: Tables) -> DataFrame:
    grouped = _paid_per(t, "provider_specialty")
    return _most(
        grouped.select(_unknown("provider_specialty", "specialty"), "claim_count", "total_paid"),
        "claim_count", "specialty",
    )


# Data quality ----------------------------------------------------------------------------


@_query("q31_quarantine_reasons")
def quarantine_reasons(t: Tables) -> DataFrame:
    """Combinations of reasons, as joined in the quarantine table."""
    grouped = t["quarantine_claims"].groupBy("rejection_reason").agg(_rows("quarantined_records"))
    return _most(grouped, "quarantined_records", "rejection_reason")


@_query("q32_quarantine_volume")
def quarantine_volume(t: Tables) -> DataFrame:
    counts = [
        t[f"quarantine_{name}"].agg(_rows("quarantined_records")).select(F.lit(name).alias("dataset"), "quarantined_records")
        for name in ("members", "providers", "diagnoses", "claims")
    ]
    return _most(reduce(DataFrame.unionByName, counts), "quarantined_records", "dataset")


@_query("q33_late_claims")
def late_claims(t: Tables) -> DataFrame:
    late = F.col("is_late_arriving")
    days = F.sum(F.when(late, F.col("days_late"))).cast("double")
    return t["fact_claims"].agg(
        F.count_if(late).alias("late_claims"),
        _rows("total_claims"),
        percent(F.count_if(late), F.count(F.lit(1))).alias("late_pct"),
        F.round(days / F.nullif(F.count(F.when(late, F.col("days_late"))), F.lit(0)), 1).alias("avg_days_late"),
        F.max("days_late").alias("max_days_late"),
    )


@_query("q34_shared_npis")
def shared_npis(t: Tables) -> DataFrame:
    """Over all versions, not only the current ones."""
    grouped = (
        t["dim_provider"].filter(F.col("npi").isNotNull())
        .groupBy("npi").agg(F.countDistinct("provider_id").alias("distinct_providers"))
    )
    return _most(grouped.filter(F.col("distinct_providers") > 1), "distinct_providers", "npi")


@_query("q35_missing_specialty")
def missing_specialty(t: Tables) -> DataFrame:
    """A blank counts as missing here; the Silver flag counts NULL only."""
    missing = F.count_if(F.col("specialty").isNull() | (F.trim("specialty") == ""))
    return current(t["dim_provider"]).agg(
        missing.alias("missing_specialty"),
        _rows("current_providers"),
        percent(missing, F.count(F.lit(1))).alias("missing_specialty_pct"),
    )


def run_all(tables: Tables, as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """Every query in domain order."""
    return {
        name: fn(tables, as_of=as_of) if fn is members_by_age_band else fn(tables) for name, fn in REGISTRY.items()
    }


# Not part of run_all: described next to the queries above, answered here for the same tables.


def processing_time_trend(t: Tables) -> DataFrame:
    """Average days from service to submission, by month."""
    days = F.sum("days_late").cast("double") / F.nullif(F.count("days_late"), F.lit(0))
    return _by_month(t["fact_claims"].groupBy("service_year_month").agg(_rows(), F.round(days, 2).alias("avg_days")))


def approximate_counts(t: Tables, error: float = 0.02) -> DataFrame:
    """Distinct members, providers and diagnoses in one pass, without shuffling their values."""
    return t["fact_claims"].agg(
        _rows("claim_count"),
        *[F.approx_count_distinct(c, error).alias(f"{c}s") for c in ("member_id", "provider_id", "diagnosis_code")],
    )


COUNTED = ("member_id", "provider_id", "diagnosis_code")


def monthly_sketches(fact: DataFrame, precision: int = 12) -> DataFrame:
    """One row per month: its claims, and a mergeable sketch of each counted column, to be stored and added to.

    ``precision`` is the number of index bits: a standard error of 1.04 / sqrt(2 ** precision).
    """
    return fact.groupBy("service_year_month").agg(
        _rows("claim_count"), *[F.hll_sketch_agg(c, precision).alias(c) for c in COUNTED]
    )


def united_counts(sketches: DataFrame) -> DataFrame:
    """Distinct values over all months of stored sketches, without reading the fact again."""
    united = sketches.agg(F.sum("claim_count").alias("claim_count"), *[F.hll_union_agg(c).alias(c) for c in COUNTED])
    return united.select("claim_count", *[F.hll_sketch_estimate(c).alias(f"{c}s") for c in COUNTED])
