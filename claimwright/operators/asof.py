"""Lookup of the version that was valid on a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from claimwright.functions.columns import spread_nulls


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def _by_month(versions: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Each version once per month that it covers between two days.

    The months of one key add up to its versions and the months of the calendar, as its versions do not overlap.
    """
    begins = F.greatest(F.to_date("_from"), F.lit(first))
    ends = F.least(F.coalesce(F.to_date("_to"), F.lit(last)), F.lit(last))
    months = F.sequence(_month(begins), ends, F.expr("interval 1 month"))
    return versions.filter(begins <= ends).withColumn("_month", F.explode(months))


def day_bounds(df: DataFrame, day: str) -> tuple[dt.date, dt.date] | None:
    """First and last day, by a small job over one column; None without any."""
    first, last = df.agg(F.to_date(F.min(day)), F.to_date(F.max(day))).first()
    return None if first is None else (first, last)


def valid_on(
    df: DataFrame, key: str, day: str, versions: DataFrame, take: dict[str, str], spread_by: Sequence[str] = (),
    within: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Left join with the version of ``key`` whose ``[valid_from, valid_to)`` holds ``day``.

    The join is on key and month: a row meets the versions that cover its month, never all versions of its key;
    a month of one key that holds most rows is split by the adaptive skew join. ``within`` are the first and the last
    day of ``df``, looked up if not named; the plan itself reads ``df`` once. A version of no days (replaced on the day
    it began) was never valid. Spark expects as many months as there are versions and would broadcast far more than it
    measured, so the join is a merge.
    """
    lasting = versions.filter(
        F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    ).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
        F.struct(*[F.col(c).alias(n) for c, n in take.items()]).alias("_taken"),
    )
    bounds = within or day_bounds(df, day)
    spans = _by_month(lasting, *bounds) if bounds else lasting.withColumn("_month", F.lit(None).cast("date")).limit(0)
    same = (spread_nulls(key, *(spread_by or df.columns)) == F.col("_key")) & (_month(F.col(day)) == F.col("_month"))
    held = (F.col(day) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(day) < F.col("_to")))
    joined = df.join(spans.hint("merge"), same & held, "left")
    taken = {n: F.when(F.col(key).isNotNull(), F.col("_taken")[n]) for n in take.values()}
    return joined.withColumns(taken).drop("_key", "_month", "_from", "_to", "_taken")
