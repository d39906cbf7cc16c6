"""Table tests. Each returns the violations, so an empty result means the test passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values found more than once, with their row count."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent, with their row count.

    The child is reduced to its distinct keys first, so a hot key joins as a single row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-NULL values outside ``values``, with their row count."""
    other = df.filter(~F.col(column).isin(list(values)))
    return other.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


class GoldTest(NamedTuple):
    table: str
    column: str
    test: str
    violations: DataFrame


def gold_tests(tables: dict[str, DataFrame]) -> list[GoldTest]:
    """The eleven tests of the star schema."""
    member, provider, fact = tables["dim_member"], tables["dim_provider"], tables["fact_claims"]
    nulls = [
        ("dim_member", member, ["member_id"]),
        ("dim_provider", provider, ["provider_sk", "provider_id", "is_current"]),
        ("fact_claims", fact, ["claim_id", "member_id"]),
    ]
    singles = [("dim_member", member, "member_id"), ("dim_provider", provider, "provider_sk"), ("fact_claims", fact, "claim_id")]
    tests = [GoldTest(t, c, "not_null", not_null(df, c)) for t, df, columns in nulls for c in columns]
    tests += [GoldTest(t, c, "unique", unique(df, c)) for t, df, c in singles]
    tests.append(GoldTest("fact_claims", "member_id", "relationships", relationships(fact, "member_id", member, "member_id")))
    tests.append(GoldTest("fact_claims", "is_denied", "accepted_values", accepted_values(fact, "is_denied", [0, 1])))
    return tests


def violation_counts(tests: Sequence[GoldTest]) -> DataFrame:
    """(table, column, test, violations), one row per test."""
    label: dict[str, Column] = {}
    parts = []
    for t in tests:
        label = {"table_name": F.lit(t.table), "column_name": F.lit(t.column), "test": F.lit(t.test)}
        count = t.violations.agg(F.count(F.lit(1)).alias("violations"))
        parts.append(count.select(*[v.alias(k) for k, v in label.items()], "violations"))
    return reduce(DataFrame.unionByName, parts)
