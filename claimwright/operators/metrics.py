"""Data-quality metrics as one-row DataFrames: long counts and one map of reason -> rows.

Each dataset needs two aggregates: one over the validated rows (before the split) and one over
the finished Silver rows. Both are partial aggregates, so one row per task is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.operators.dedup import COPIES
from claimwright.operators.validation import CLAIM_REFERENCES, REASONS

BREAKDOWN = "quarantine_reason_breakdown"
RI = "referential_integrity_failures"
BATCHES = ("BATCH_1", "BATCH_2")


def reason_breakdown(df: DataFrame, column: str = REASONS) -> DataFrame:
    """Rows per single rule; a row breaking two rules counts under both."""
    exploded = df.select(F.explode(column).alias("reason"))
    return exploded.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def _has(reason: str) -> Column:
    return F.count_if(F.array_contains(REASONS, reason))


def _counts_map(pairs: Sequence[tuple[str, Column]], keep_zero: bool = False) -> Column:
    full = F.create_map(*[x for name, n in pairs for x in (F.lit(name), n)])
    return full if keep_zero else F.map_filter(full, lambda _, n: n > 0)


def _stage_side(validated: DataFrame, rule_names: Sequence[str], extra: dict[str, Column]) -> DataFrame:
    ok = F.size(REASONS) == 0
    row = validated.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("input_count"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("exact_duplicate_rows_removed"),
        F.count_if(ok).alias("_valid"),
        F.count_if(~ok).alias("quarantined_count"),
        *[_has(name).alias(f"_rule_{name}") for name in rule_names],
        *[c.alias(name) for name, c in extra.items()],
    )
    return row.withColumn(BREAKDOWN, _counts_map([(n, F.col(f"_rule_{n}")) for n in rule_names]))


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames as one row, without a cross join: stack them and keep what is not NULL."""
    stacked = left.unionByName(right, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def _finish(row: DataFrame, names: Sequence[str]) -> DataFrame:
    return row.withColumn("business_key_duplicates_removed", F.col("_valid") - F.col("output_count")).select(*names)


def member_metrics(validated: DataFrame, silver: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    nulls = ("date_of_birth", "state", "zip_code")
    out = silver.agg(
        F.count(F.lit(1)).alias("output_count"),
        F.count_if("has_missing_zip").alias("missing_zip_flag_count"),
        _counts_map([(c, F.count_if(F.col(c).isNull())) for c in nulls], keep_zero=True).alias("null_counts"),
    )
    return _finish(
        _side_by_side(_stage_side(validated, rule_names, {}), out),
        [
            "input_count", "output_count", "exact_duplicate_rows_removed", "business_key_duplicates_removed",
            "quarantined_count", BREAKDOWN, "missing_zip_flag_count", "null_counts",
        ],
    )


def provider_metrics(validated: DataFrame, silver: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    history = (
        validated.groupBy("provider_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("providers_with_historical_versions_preserved"))
    )
    out = silver.agg(
        F.count(F.lit(1)).alias("output_count"),
        F.count_if("has_duplicate_npi").alias("duplicate_npi_flag_count"),
        F.count_if("has_missing_specialty").alias("missing_specialty_flag_count"),
    )
    rows = reduce(_side_by_side, [_stage_side(validated, rule_names, {}), history, out])
    return rows.select(
        "input_count", "output_count", "exact_duplicate_rows_removed",
        "providers_with_historical_versions_preserved", "quarantined_count", BREAKDOWN,
        "duplicate_npi_flag_count", "missing_specialty_flag_count",
    )


def diagnosis_metrics(validated: DataFrame, silver: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    out = silver.agg(F.count(F.lit(1)).alias("output_count"))
    return _finish(
        _side_by_side(_stage_side(validated, rule_names, {}), out),
        [
            "input_count", "output_count", "exact_duplicate_rows_removed", "business_key_duplicates_removed",
            "quarantined_count", BREAKDOWN,
        ],
    )


def claim_metrics(validated: DataFrame, silver: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    batch_rows = {
        f"{b.lower()}_input_rows": F.coalesce(F.sum(F.when(F.col("ingestion_batch_id") == b, F.col(COPIES))), F.lit(0))
        for b in BATCHES
    }
    out = silver.agg(
        F.count(F.lit(1)).alias("output_count"),
        F.count_if("is_late_arriving").alias("late_arriving_count"),
        F.count("adjustment_amount").alias("adjustment_amount_present_count"),
    )
    row = _side_by_side(_stage_side(validated, rule_names, batch_rows), out)
    of = lambda reason: F.coalesce(F.col(BREAKDOWN)[reason], F.lit(0))
    row = row.withColumns(
        {
            RI: _counts_map([(r, of(r)) for r in CLAIM_REFERENCES.values()], keep_zero=True),
            "negative_paid_amount_count": of("negative_paid_amount"),
            "missing_paid_amount_for_paid_claim_count": of("missing_paid_amount_for_paid_claim"),
        }
    )
    return _finish(
        row,
        [
            "input_count", "output_count", *batch_rows, "exact_duplicate_rows_removed",
            "business_key_duplicates_removed", "quarantined_count", BREAKDOWN, RI, "negative_paid_amount_count",
            "missing_paid_amount_for_paid_claim_count", "late_arriving_count", "adjustment_amount_present_count",
        ],
    )


def _row(name: Column, value: Column) -> Column:
    return F.struct(name.alias("metric"), value.cast("bigint").alias("value"))


def _entries(column: str) -> Column:
    """A map column as (metric, value) structs named ``<column>.<key>``."""
    return F.transform(F.map_entries(column), lambda e: _row(F.concat(F.lit(f"{column}."), e["key"]), e["value"]))


def as_rows(metrics: DataFrame) -> DataFrame:
    """The one-row metrics as (metric, value) rows."""
    parts = [
        _entries(name) if kind.startswith("map") else F.array(_row(F.lit(name), F.col(name)))
        for name, kind in metrics.dtypes
    ]
    return metrics.select(F.inline(F.concat(*parts)))
