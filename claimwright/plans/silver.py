"""Bronze to Silver: per-dataset builders and the job that writes them.

Per dataset: clean, collapse exact copies, validate, split, then one row per key among the valid
rows only, so that a newer invalid row never displaces an older valid one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from claimwright.contracts import CLAIMS, CONTRACTS, DIAGNOSES, MEMBERS, PROVIDERS
from claimwright.operators import metrics as m
from claimwright.operators import validation as v
from claimwright.operators.cleaning import conform, key_set, with_service_month
from claimwright.operators.dedup import COPIES, collapse_copies, latest_per_key

DIMENSIONS = ("members", "providers", "diagnoses")
ALL = (*DIMENSIONS, "claims")

# Turns the validated rows into something cheap to read several times. The job writes a table;
# a single query leaves the plan as it is.
Stage = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Built:
    """``validated`` is the one expensive result; the other three are derived from it."""

    name: str
    validated: DataFrame
    silver: DataFrame
    quarantine: DataFrame

    def metrics(self, silver: DataFrame | None = None) -> DataFrame:
        """One row. Pass the written Silver table to count it instead of building it again."""
        silver = self.silver if silver is None else silver
        return METRICS[self.name](self.validated, silver, rule_names(self.name))


METRICS = {
    "members": m.member_metrics,
    "providers": m.provider_metrics,
    "diagnoses": m.diagnosis_metrics,
    "claims": m.claim_metrics,
}


def rule_names(name: str) -> list[str]:
    """Reasons a row of this dataset can be rejected for, in the order they are listed."""
    rules = {
        "members": v.member_rules,
        "providers": v.provider_rules,
        "diagnoses": v.diagnosis_rules,
        "claims": v.claim_field_rules,
    }[name]()
    return [reason for reason, _ in rules] + (list(v.CLAIM_REFERENCES.values()) if name == "claims" else [])


def as_is(df: DataFrame) -> DataFrame:
    return df


def distinct_rows(bronze: DataFrame, name: str) -> DataFrame:
    """Cleaned rows without exact copies."""
    contract = CONTRACTS[name]
    return collapse_copies(conform(bronze, contract), contract.business)


def _finish(name: str, validated: DataFrame, validated_at: Column | None) -> Built:
    contract = CONTRACTS[name]
    parts = v.split(validated.drop(COPIES), validated_at)
    silver = parts.valid
    if contract.newest_by:
        silver = latest_per_key(silver, contract.key, contract.newest_by, contract.business)
    return Built(name, validated, silver, parts.quarantine)


def build_members(
    bronze: DataFrame, as_of: dt.date | str | None = None, stage: Stage = as_is, validated_at: Column | None = None
) -> Built:
    rows = distinct_rows(bronze, MEMBERS.name)
    return _finish(MEMBERS.name, stage(v.validate_members(rows, as_of)), validated_at)


def build_providers(bronze: DataFrame, stage: Stage = as_is, validated_at: Column | None = None) -> Built:
    """Every version is kept: the history is what the Gold dimension is made of."""
    rows = distinct_rows(bronze, PROVIDERS.name)
    return _finish(PROVIDERS.name, stage(v.validate_providers(rows)), validated_at)


def build_diagnoses(bronze: DataFrame, stage: Stage = as_is, validated_at: Column | None = None) -> Built:
    rows = distinct_rows(bronze, DIAGNOSES.name)
    return _finish(DIAGNOSES.name, stage(v.validate_diagnoses(rows)), validated_at)


def build_claims(
    bronze: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    diagnoses: DataFrame,
    stage: Stage = as_is,
    validated_at: Column | None = None,
) -> Built:
    """The dimensions are the Silver tables; only their distinct keys take part."""
    rows = conform(bronze, CLAIMS)
    checked = v.validate_claims(
        collapse_copies(rows, CLAIMS.business), key_set(members, "member_id"), key_set(providers, "provider_id"),
        key_set(diagnoses, "diagnosis_code"), rows,
    )
    built = _finish(CLAIMS.name, stage(checked), validated_at)
    return Built(CLAIMS.name, built.validated, with_service_month(built.silver), built.quarantine)


def build_all(bronze: dict[str, DataFrame], as_of: dt.date | str | None = None) -> dict[str, Built]:
    """All four builders as one lazy plan, for use without writing anything."""
    built = {
        "members": build_members(bronze["members"], as_of),
        "providers": build_providers(bronze["providers"]),
        "diagnoses": build_diagnoses(bronze["diagnoses"]),
    }
    built["claims"] = build_claims(bronze["claims"], *[built[d].silver for d in DIMENSIONS])
    return built
