"""Version history (SCD Type 2) of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def surrogate_key(key: str, effective: str) -> Column:
    """md5 of key, a pipe and the date. NULL in either part gives NULL (concat, not concat_ws)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.col(effective).cast("string")))


def with_validity(df: DataFrame, key: str, effective: str, tie_break: Sequence[str]) -> DataFrame:
    """Add ``valid_from``, ``valid_to`` (next version, NULL when open) and ``is_current``.

    Same as a lead() per key, but no task ever holds all versions of one key: versions are first
    reduced to one row per key and day, the window runs over those days (their number is bounded by
    the calendar), and the result is joined back. Versions of one day are ordered by ``tie_break``;
    all but the last of them end on the day they start. The days are nearly as many as the versions, however
    small their file, so they are merged and never broadcast.
    """
    content = F.struct(*tie_break)
    days = df.groupBy(key, effective).agg(F.max(content).alias("_last"))
    following = F.lead(effective).over(Window.partitionBy(key).orderBy(effective))
    days = days.select(
        F.col(key).alias("_key"), F.col(effective).alias("_day"), "_last", following.alias("_next")
    )
    same_version_day = (df[key] == days["_key"]) & (df[effective] == days["_day"])
    is_last = F.struct(*[df[c] for c in tie_break]) == F.col("_last")
    return (
        df.join(days.hint("merge"), same_version_day, "left")
        .withColumn("valid_from", df[effective])
        .withColumn("valid_to", F.when(is_last, F.col("_next")).otherwise(df[effective]))
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("_key", "_day", "_last", "_next")
    )


def same_day_versions(df: DataFrame, key: str, effective: str) -> DataFrame:
    """Key and day pairs that carry more than one version: they share a surrogate key."""
    counted = df.groupBy(key, effective).agg(F.count(F.lit(1)).alias("version_count"))
    return counted.filter(F.col("version_count") > 1)
