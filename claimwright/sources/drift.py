"""Does a file have the columns its source declares?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.sources.registry import Source

PASSED, DRIFTED, FAILED = "PASSED", "PASSED_WITH_DRIFT", "FAILED"


def _names(columns: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(columns, ", "), F.lit("]"))


def _literal(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def check_columns(headers: DataFrame, source: Source, columns: str = "columns") -> DataFrame:
    """Add ``status``, ``missing_required_columns``, ``unexpected_columns`` and ``message``.

    A missing required column always fails. An unexpected one follows the drift policy.
    """
    df = headers.withColumns(
        {
            "missing_required_columns": F.array_sort(F.array_except(_literal(source.required_columns), columns)),
            "unexpected_columns": F.array_sort(F.array_except(columns, _literal(source.expected_columns))),
        }
    )
    missing, unexpected = F.col("missing_required_columns"), F.col("unexpected_columns")
    is_missing, has_drift = F.size(missing) > 0, F.size(unexpected) > 0
    policy = source.schema_drift_policy
    drift_status = FAILED if policy == "fail" else DRIFTED
    status = F.when(is_missing, FAILED).when(has_drift, drift_status).otherwise(PASSED)
    message = (
        F.when(is_missing, F.concat(F.lit("Required columns are not there: "), _names(missing)))
        .when(has_drift, F.concat(F.lit("Columns nobody declared: "), _names(unexpected), F.lit(f"; the source says {policy}")))
        .otherwise("Columns are those declared.")
    )
    return df.withColumns({"status": status, "message": message})
