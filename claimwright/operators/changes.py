"""Record-level increments and change feeds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwright.operators.dedup import latest_per_key
from claimwright.session import staging


def high_water(df: DataFrame, column: str):
    """Greatest value loaded so far; None when nothing was."""
    return df.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows past the mark. The mark is a constant, so the filter reaches the scan."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def _if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Increments:
    """Loads a source by a date or timestamp column, from a mark that is kept between runs.

    A run takes the rows from ``overlap`` before the mark on, leaves out those that the target holds, appends the
    others and then moves the mark. So a row of the mark's own value and one that is late by at most the overlap are
    not lost, and a run that broke off before the mark moved is made good by the next. Rows without a value in the
    column are taken by no run. Rows are the same if ``identity`` is, NULL being a value; of such rows one is loaded.

    The target is partitioned by the month of the column: a run reads the months of its overlap only. Marks are one
    small row per run and source, appended; the greatest counts.
    """

    marks: str
    source: str
    column: str
    identity: tuple[str, ...]
    overlap: dt.timedelta = dt.timedelta(0)

    def mark(self, spark: SparkSession) -> dt.datetime | None:
        """The value up to which the source was loaded; None before the first run."""
        marks = _if_there(spark, self.marks, "mark timestamp, source string")
        return marks and marks.filter(F.col("source") == self.source).agg(F.max("mark")).first()[0]

    def _digest(self) -> Column:
        return F.sha2(F.to_json(F.struct(*self.identity), {"ignoreNullFields": "false"}), 256)

    def load(self, rows: DataFrame, target: str) -> int:
        """Append what is new to ``target`` and return the number of rows."""
        spark, mark = rows.sparkSession, self.mark(rows.sparkSession)
        since = None if mark is None else mark - self.overlap
        value = F.col(self.column)
        # The bound has the column's own type, so that it reaches the scan.
        bound = F.lit(since).cast(rows.schema[self.column].dataType)
        asked = rows.filter(value.isNotNull() if since is None else value >= bound)
        asked = asked.dropDuplicates(list(self.identity))
        held = _if_there(spark, target, f"{rows.select(*self.identity).schema.toDDL()}, _month date")
        if held is not None:  # also before the first mark: a run may have broken off
            recent = held if since is None else held.filter(F.col("_month") >= F.to_date(F.trunc(F.lit(since), "month")))
            asked = asked.withColumn("_held", self._digest()).join(recent.select(self._digest().alias("_held")), "_held", "left_anti").drop("_held")
        with staging(spark) as stage:
            fresh = stage(asked, "increment")  # counted, written and asked for its greatest value
            count, greatest = fresh.agg(F.count(F.lit(1)), F.max(value.cast("timestamp"))).first()
            if count:
                monthly = fresh.withColumn("_month", F.to_date(F.trunc(value, "month"))).hint("rebalance", "_month")
                monthly.write.mode("append").partitionBy("_month").parquet(target)
                moved = spark.range(1).select(F.lit(greatest).alias("mark"), F.lit(self.source).alias("source"))
                moved.coalesce(1).write.mode("append").partitionBy("source").parquet(self.marks)
        return count


def apply_changes(
    current: DataFrame, changes: DataFrame, key: Sequence[str], newest_by: Sequence[str], operation: str = "operation"
) -> DataFrame:
    """``current`` after inserts, updates and deletes.

    Only the latest change of a key counts. Changed keys leave ``current`` by an anti join and come
    back unless deleted.
    """
    content = [c for c in changes.columns if c not in key and c not in newest_by]
    latest = latest_per_key(changes, key, newest_by, content)
    kept = current.join(latest.select(*key), list(key), "left_anti")
    return kept.unionByName(latest.filter(F.col(operation) != "delete").select(*current.columns))
