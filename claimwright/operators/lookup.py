"""Left lookups against a side with unique keys.

No broadcast is forced: Spark broadcasts the lookup side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting a hot key with the
adaptive skew join. NULL keys are spread because they would all meet in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import StructField, StructType

from claimwright.functions.columns import spread_nulls
from claimwright.session import concurrently

#: Most unresolved values of a key column that are broadcast; a bound on the rows, checked before.
MOST_UNRESOLVED = 50_000


def resolve_key(df: DataFrame, column: str, keys: DataFrame, found: str) -> DataFrame:
    """Add boolean ``found``: does ``column`` occur in the one-column, distinct ``keys``?

    Every row is kept, which an anti join would not do. NULL is never found.
    """
    side = keys.toDF("_key")
    joined = df.join(side, spread_nulls(column, *df.columns) == F.col("_key"), "left")
    return joined.withColumn(found, F.col(column).isNotNull() & F.col("_key").isNotNull()).drop("_key")


def row_identity(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row's content, in two numbers. Spark's hash passes over NULL, so which are NULL is hashed as well."""
    absent = [F.col(c).isNull() for c in columns]
    there_and_back = ([*absent, *columns], [*reversed(columns), *absent])
    return [F.xxhash64(*cs).alias(name) for cs, name in zip(there_and_back, ("_row", "_check"))]


def unresolved(rows: DataFrame, keys: dict[str, DataFrame], identity: Sequence[str]) -> DataFrame:
    """``_row``, ``_check``, ``_missing`` of the rows whose key columns do not all resolve; bit i is that of the i-th column.

    Only the identity and the keys of a row take part in the lookups, and only rows with an unresolved key, which are few,
    come out. NULL counts as resolved here.
    """
    narrow = rows.select(*row_identity(identity), *keys)
    for column, side in keys.items():
        narrow = resolve_key(narrow, column, side, f"_found_{column}")
    bits = [F.when(F.col(c).isNotNull() & ~F.col(f"_found_{c}"), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(keys)]
    missing = narrow.select("_row", "_check", reduce(Column.bitwiseOR, bits).alias("_missing")).filter("_missing > 0")
    return missing.groupBy("_row", "_check").agg(F.max("_missing").alias("_missing"))


def unresolved_keys(rows: DataFrame, keys: dict[str, DataFrame], most: int = MOST_UNRESOLVED) -> dict[str, list[Row]] | None:
    """The distinct values of every key column that its side lacks; none if there are more than ``most`` of one.

    Each column is read alone and reduced to distinct values in every task, so the rows themselves do not move.
    """
    def look(column: str, side: DataFrame):
        asked = rows.select(F.col(column).alias("_asked")).filter("_asked is not null").distinct()
        return lambda: asked.join(side.toDF("_key"), F.col("_asked") == F.col("_key"), "left_anti").limit(most + 1).collect()

    found = dict(zip(keys, concurrently(*[look(c, side) for c, side in keys.items()])))
    return None if any(len(f) > most for f in found.values()) else found


def resolve_keys(df: DataFrame, keys: dict[str, DataFrame], found: str = "_found_", rows: DataFrame | None = None, identity: Sequence[str] | None = None) -> DataFrame:
    """Add a boolean ``found`` + column for every key column: does it occur in its one-column, distinct side?

    Keys that do not resolve are few as a rule: they are looked for first, and broadcast, so that the wide rows stay where
    they are. If they are many, the wide rows meet one table, that of the rows with such a key, instead of every
    side: one shuffle of them. ``rows``: rows with the same contents in ``identity`` and the keys (by default ``df`` itself),
    where those are cheaper to read than ``df``, as copies do no harm. NULL is never found.
    """
    lists = unresolved_keys(df if rows is None else rows, keys)
    if lists is not None:
        for column, values in lists.items():
            known = F.col(column).isNotNull()
            if values:
                lacking = df.sparkSession.createDataFrame([(v[0],) for v in values], StructType([StructField("_lacking", df.schema[column].dataType)]))
                df = df.join(F.broadcast(lacking), F.col(column) == F.col("_lacking"), "left")
                known = known & F.col("_lacking").isNull()
            df = df.withColumn(f"{found}{column}", known).drop("_lacking")
        return df
    identity = list(identity or df.columns)
    # Read again on the other side of a join, under names of its own.
    missing = unresolved(df if rows is None else rows, keys, identity).toDF("_row", "_check", "_missing")
    met = df.select("*", *(c.alias(f"{name}_of") for c, name in zip(row_identity(identity), ("_row", "_check"))))
    met = met.join(missing, (F.col("_row_of") == F.col("_row")) & (F.col("_check_of") == F.col("_check")), "left")
    flags = {f"{found}{c}": F.col(c).isNotNull() & (F.coalesce("_missing", F.lit(0)).bitwiseAND(F.lit(1 << i)) == 0) for i, c in enumerate(keys)}
    return met.withColumns(flags).drop("_row", "_check", "_row_of", "_check_of", "_missing")


def attach(
    df: DataFrame, column: str, side: DataFrame, key: str, take: dict[str, str], spread_by: Sequence[str] = ()
) -> DataFrame:
    """Left join that brings ``take`` (side column -> new name) from a side with unique ``key``.

    ``spread_by`` names columns that tell rows apart, so that the others can still be pruned.
    """
    picked = side.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_side_{c}") for c in take])
    joined = df.join(picked, spread_nulls(column, *(spread_by or df.columns)) == F.col("_key"), "left")
    held = F.col(column).isNotNull()
    taken = {new: F.when(held, F.col(f"_side_{c}")) for c, new in take.items()}
    return joined.withColumns(taken).drop("_key", *[f"_side_{c}" for c in take])
