"""Duplicate handling. Every form reduces on the map side first, so a key or a group of copies
holding a large share of the rows reaches the shuffle as one row per task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimwright.contracts import PROVENANCE
from claimwright.functions.columns import content_digest

COPIES = "_copies"
#: Most landed files whose ranks are broadcast; a bound on the rows, checked before.
MOST_ORIGINS = 20_000


def ranked_origins(df: DataFrame, columns: Sequence[str], most: int = MOST_ORIGINS) -> DataFrame | None:
    """Every combination of ``columns`` with its rank (``_origin``), nulls first; none if there are more than ``most``.

    Provenance has one combination for each landed file. The look at it reads these columns alone.
    """
    found = df.select(*columns).distinct().limit(most + 1).collect()
    if len(found) > most:
        return None
    found.sort(key=lambda row: tuple((v is not None, v if v is not None else 0) for v in row))
    schema = StructType([StructField("_origin", LongType()), *(df.schema[c] for c in columns)])
    return df.sparkSession.createDataFrame([(i, *row) for i, row in enumerate(found)], schema)


def collapse_copies(
    df: DataFrame, business: Sequence[str], provenance: Sequence[str] = PROVENANCE, copies: str = COPIES
) -> DataFrame:
    """One row per identical business content, plus how many copies there were.

    The row kept is the one with the latest provenance. An aggregate rather than a window: partial
    aggregation leaves one row per distinct content in every task before anything is shuffled. Where the files are
    few enough to broadcast, their ranks take the place of their names in it: its buffer is two numbers, kept in a hash
    table, with no sort on either side of the shuffle. Beyond that the names themselves are compared.
    ``sum(_copies - 1)`` is the number of rows removed, so no counting action is needed.
    """
    rest = [c for c in df.columns if c not in business]
    ordered = [c for c in provenance if c in rest] + [c for c in rest if c not in provenance]
    counted = F.count(F.lit(1)).alias(copies)
    if not ordered:
        return df.groupBy(*business).agg(counted)
    origins = ranked_origins(df, ordered)
    if origins is not None:
        origins = F.broadcast(origins)
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ordered))
        placed = df.join(origins.toDF("_origin", *(f"_of_{c}" for c in ordered)), same)
        kept = placed.groupBy(*business).agg(F.max("_origin").alias("_origin"), counted)
        return kept.join(origins, "_origin").select(*df.columns, copies)
    latest = F.max(F.struct(*ordered)).alias("_latest")
    grouped = df.groupBy(*business).agg(latest, counted)
    return grouped.select(
        *[F.col(c) if c in business else F.col("_latest")[c].alias(c) for c in df.columns], copies
    )


def latest_per_key(
    df: DataFrame, key: Sequence[str], newest_by: Sequence[str], content: Sequence[str]
) -> DataFrame:
    """One row per key: newest first, then the greater content digest (its first 60 bits, which travel as a number).

    The columns themselves close the order, because two contents may share a digest input. The
    ``== 1`` on row_number lets Spark keep one row per key and task ahead of the shuffle.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_by]
    order += [F.col("_digest").desc()] + [F.col(c).desc_nulls_last() for c in content]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return (
        df.withColumn("_digest", F.conv(F.substring(content_digest(content), 1, 15), 16, 10).cast("bigint"))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_digest")
    )


def keys_with_history(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys found on more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
