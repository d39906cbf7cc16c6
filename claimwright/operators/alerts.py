"""Alerts: which runs and metrics are out of bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimwright.sources.audit import FAILED, SUCCESS_WITH_DRIFT


def run_alerts(history: DataFrame) -> DataFrame:
    """Failed attempts and drifted ones, from the audit history."""
    bad = history.filter(F.col("status").isin(FAILED, SUCCESS_WITH_DRIFT))
    return bad.select(
        F.col("source_name").alias("subject"), F.lower("status").alias("alert"),
        F.coalesce("error_message", "source_file").alias("detail"),
    )


def metric_alerts(metrics: DataFrame, dataset: str, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """Metrics, as (metric, value) rows, outside their inclusive (low, high)."""
    low = F.create_map(*[x for k, (a, _) in bounds.items() for x in (F.lit(k), F.lit(a).cast("bigint"))])
    high = F.create_map(*[x for k, (_, b) in bounds.items() for x in (F.lit(k), F.lit(b).cast("bigint"))])
    known = metrics.filter(F.col("metric").isin(list(bounds)))
    out = known.filter(~F.col("value").between(low[F.col("metric")], high[F.col("metric")]))
    return out.select(F.lit(dataset).alias("subject"), F.col("metric").alias("alert"), F.col("value").cast("string").alias("detail"))
