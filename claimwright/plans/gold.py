"""Silver to Gold: member and provider dimensions, the claim fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.contracts import CLAIMS, PROVIDERS
from claimwright.functions.columns import month_of
from claimwright.operators.asof import day_bounds, valid_on
from claimwright.operators.lookup import attach
from claimwright.operators.versions import surrogate_key, with_validity

MEMBER_COLUMNS = [
    "member_id", "plan_type", "state", "zip_code", "gender", "date_of_birth", "has_missing_zip", "source_system",
]


def dim_member(members: DataFrame) -> DataFrame:
    return members.select(*MEMBER_COLUMNS)


def dim_provider(providers: DataFrame) -> DataFrame:
    """One row per provider version, valid in ``[valid_from, valid_to)``."""
    tie_break = [c for c in PROVIDERS.business if c not in ("provider_id", "effective_date")]
    versions = with_validity(providers.select(*PROVIDERS.business), "provider_id", "effective_date", tie_break)
    return versions.select(
        surrogate_key("provider_id", "effective_date").alias("provider_sk"),
        "provider_id", "provider_name", "specialty", "npi", "network_status", "address_state", "effective_date",
        "valid_from", "valid_to", "is_current",
    )


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def denied_flag(status: str = "claim_status") -> Column:
    return F.when(F.lower(status) == "denied", 1).otherwise(0)


def with_measures(claims: DataFrame) -> DataFrame:
    """Amounts as double, what is left unpaid (NULL while unpaid is unknown), and the denial flag."""
    billed, paid = F.col("billed_amount").cast("double"), F.col("paid_amount").cast("double")
    return claims.withColumns(
        {"billed_amount": billed, "paid_amount": paid, "unpaid_amount": billed - paid, "is_denied": denied_flag()}
    )


FACT_COLUMNS = [
    "claim_id", "member_id", "provider_id", "provider_sk", "diagnosis_code", "service_date", "service_year_month",
    "claim_status", "denial_reason", "plan_type", "member_state", "provider_specialty", "network_status",
    "billed_amount", "paid_amount", "unpaid_amount", "is_denied", "is_late_arriving", "days_late",
]
FROM_MEMBER = {"plan_type": "plan_type", "state": "member_state"}
FROM_PROVIDER = {"provider_sk": "provider_sk", "specialty": "provider_specialty", "network_status": "network_status"}


def fact_claims(claims: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """One row per claim with attributes of its member and of the provider's current version."""
    narrow = claims.select(*[c for c in FACT_COLUMNS if c in claims.columns])
    wide = attach(narrow, "member_id", members, "member_id", FROM_MEMBER, CLAIMS.key)
    wide = attach(wide, "provider_id", current(providers), "provider_id", FROM_PROVIDER, CLAIMS.key)
    return with_measures(wide).select(*FACT_COLUMNS)


def build_gold(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    members, providers = dim_member(silver["members"]), dim_provider(silver["providers"])
    return {
        "dim_member": members,
        "dim_provider": providers,
        "fact_claims": fact_claims(silver["claims"], members, providers),
    }


def dim_diagnosis(diagnoses: DataFrame) -> DataFrame:
    return diagnoses.select("diagnosis_code", "diagnosis_description", "category")


def dim_date(claims: DataFrame, day: str = "service_date") -> DataFrame:
    """Every day between the first and the last of ``day``. The scan is reduced to two dates first."""
    span = claims.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month"), F.quarter("date").alias("quarter"),
        month_of("date").alias("year_month"), (F.weekday("date") + 1).alias("iso_weekday"),
    )


def fact_claims_as_of(claims: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """The fact with the provider version valid on the day of service instead of the current one."""
    narrow = claims.select(*[c for c in FACT_COLUMNS if c in claims.columns])
    wide = attach(narrow, "member_id", members, "member_id", FROM_MEMBER, CLAIMS.key)
    days = day_bounds(narrow, "service_date")
    wide = valid_on(wide, "provider_id", "service_date", providers, FROM_PROVIDER, CLAIMS.key, days)
    return with_measures(wide).select(*FACT_COLUMNS)
