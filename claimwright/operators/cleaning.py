"""Raw strings to typed columns. No row is dropped or corrected here."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from claimwright.contracts import CLAIMS, DIAGNOSES, MEMBERS, PROVIDERS, Contract
from claimwright.functions.columns import BY_KIND, blank_as_null, month_of


def _replace(df: DataFrame, new: dict) -> DataFrame:
    """One projection, whatever the number of columns."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def blank_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _replace(df, {c: blank_as_null(c) for c in columns})


def trim_upper(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _replace(df, {c: F.upper(F.trim(F.col(c))) for c in columns})


def ensure_columns(df: DataFrame, columns: Iterable[str], default: str | None = None) -> DataFrame:
    """Append the missing ones as a string constant (NULL by default)."""
    missing = [c for c in columns if c not in df.columns]
    return df.select("*", *[F.lit(default).cast("string").alias(c) for c in missing])


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Type every business column as its contract says; other columns pass through."""
    df = ensure_columns(df, sorted(contract.optional))
    return _replace(df, {name: BY_KIND[kind](name) for name, kind in contract.columns.items()})


def clean_members(df: DataFrame) -> DataFrame:
    return conform(df, MEMBERS)


def clean_providers(df: DataFrame) -> DataFrame:
    return conform(df, PROVIDERS)


def clean_diagnoses(df: DataFrame) -> DataFrame:
    return conform(df, DIAGNOSES)


def clean_claims(df: DataFrame) -> DataFrame:
    return conform(df, CLAIMS)


def with_service_month(df: DataFrame) -> DataFrame:
    return df.withColumn("service_year_month", month_of("service_date"))


def key_set(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys: a lookup side that can never fan out."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def batch_counts(df: DataFrame, batches: Iterable[str]) -> DataFrame:
    """Rows per ingestion batch, every batch in the same pass."""
    return df.agg(*[F.count_if(F.col("ingestion_batch_id") == b).alias(b.lower()) for b in batches])


