"""Rules that send a row to quarantine, flags that only mark it, and the split.

SQL three-valued logic is kept on purpose: a rule whose condition is NULL is not broken.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.contracts import CLAIM_STATUSES, CLAIMS, LATE_AFTER_DAYS, STATE_CODES
from claimwright.functions.columns import failing
from claimwright.operators.lookup import attach, resolve_keys

REASONS = "_rejection_reasons"
SEPARATOR = "; "

Rules = list[tuple[str, Column]]


class Split(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame


def day(as_of: dt.date | str | None) -> Column:
    """The day the rules are judged on; today unless given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def member_rules(as_of: dt.date | str | None = None) -> Rules:
    return [
        ("missing_member_id", F.col("member_id").isNull()),
        ("invalid_state_code", ~F.col("state").isin(STATE_CODES)),
        ("impossible_date_of_birth_future", F.col("date_of_birth") > day(as_of)),
    ]


def provider_rules() -> Rules:
    return [
        ("missing_provider_id", F.col("provider_id").isNull()),
        ("invalid_address_state", ~F.col("address_state").isin(STATE_CODES)),
        ("missing_effective_date", F.col("effective_date").isNull()),
    ]


def diagnosis_rules() -> Rules:
    return [
        ("missing_diagnosis_code", F.col("diagnosis_code").isNull()),
        ("missing_diagnosis_description", F.col("diagnosis_description").isNull()),
        ("missing_category", F.col("category").isNull()),
    ]


def claim_field_rules() -> Rules:
    service, submitted = F.col("service_date"), F.col("submission_date")
    paid, status = F.col("paid_amount"), F.col("claim_status")
    return [
        ("missing_claim_id", F.col("claim_id").isNull()),
        ("invalid_or_missing_date", service.isNull() | submitted.isNull()),
        ("submission_before_service_date", submitted < service),
        ("negative_paid_amount", paid < 0),
        ("missing_paid_amount_for_paid_claim", (status == "Paid") & paid.isNull()),
        ("invalid_claim_status", ~status.isin(CLAIM_STATUSES)),
    ]


# Claim column -> reason when it does not resolve, in the order the reasons are listed.
CLAIM_REFERENCES = {
    "member_id": "invalid_member_id_reference",
    "provider_id": "invalid_provider_id_reference",
    "diagnosis_code": "invalid_diagnosis_code_reference",
}


def with_reasons(df: DataFrame, rules: Rules, column: str = REASONS) -> DataFrame:
    return df.withColumn(column, failing(rules))


def split(df: DataFrame, validated_at: Column | None = None, column: str = REASONS) -> Split:
    """Rows that break no rule, and the others with their reasons joined and a time stamp."""
    stamp = F.current_timestamp() if validated_at is None else validated_at
    valid = df.filter(F.size(column) == 0).drop(column)
    quarantine = (
        df.filter(F.size(column) > 0)
        .withColumn("rejection_reason", F.concat_ws(SEPARATOR, F.col(column)))
        .withColumn("validation_timestamp", stamp)
        .drop(column)
    )
    return Split(valid, quarantine)


def flag_shared_identifier(df: DataFrame, identifier: str, owner: str, flag: str) -> DataFrame:
    """True where ``identifier`` belongs to more than one ``owner``; a NULL identifier is False.

    min <> max finds a second owner with one pre-aggregated shuffle; a window would hold every
    row of a widely shared identifier in one task. Only shared identifiers reach the join.
    """
    shared = (
        df.filter(F.col(identifier).isNotNull())
        .groupBy(identifier)
        .agg(F.min(owner).alias("_first"), F.max(owner).alias("_last"))
        .filter(F.col("_first") != F.col("_last"))
        .select(identifier, F.lit(True).alias("_shared"))
    )
    marked = attach(df, identifier, shared, identifier, {"_shared": flag})
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def validate_members(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    return with_reasons(df, member_rules(as_of)).withColumn("has_missing_zip", F.col("zip_code").isNull())


def validate_providers(df: DataFrame) -> DataFrame:
    """Shared identifiers are judged before the split, so quarantined rows count as owners too."""
    checked = with_reasons(df, provider_rules()).withColumn("has_missing_specialty", F.col("specialty").isNull())
    return flag_shared_identifier(checked, "npi", "provider_id", "has_duplicate_npi")


def validate_diagnoses(df: DataFrame) -> DataFrame:
    return with_reasons(df, diagnosis_rules())


def mark_references(df: DataFrame, keys: dict[str, DataFrame], rows: DataFrame | None = None) -> DataFrame:
    """One boolean per foreign key: ``_found_<column>``. ``rows``: where ``df`` came from, copies included, if that is cheaper to read."""
    return resolve_keys(df, keys, "_found_", rows, CLAIMS.business if set(CLAIMS.business) <= set(df.columns) else None)


def with_lateness(df: DataFrame) -> DataFrame:
    """Lag in days between service and submission, and whether it exceeds the threshold."""
    lag = F.datediff("submission_date", "service_date")
    return df.withColumns(
        {"is_late_arriving": F.coalesce(lag > LATE_AFTER_DAYS, F.lit(False)), "days_late": lag}
    )


def validate_claims(
    df: DataFrame, member_ids: DataFrame, provider_ids: DataFrame, diagnosis_codes: DataFrame, rows: DataFrame | None = None
) -> DataFrame:
    """``rows``: the cleaned rows that ``df`` was made of by taking out copies, if given."""
    keys = dict(zip(CLAIM_REFERENCES, (member_ids, provider_ids, diagnosis_codes)))
    marked = mark_references(df, keys, rows)
    references = [(reason, ~F.col(f"_found_{column}")) for column, reason in CLAIM_REFERENCES.items()]
    checked = with_reasons(marked, claim_field_rules() + references)
    return with_lateness(checked.drop(*[f"_found_{c}" for c in keys]))
