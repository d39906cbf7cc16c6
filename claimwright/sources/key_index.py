"""Where each key of a partitioned Silver table stands: a narrow index beside the table, for merges.

An entry is a 64-bit hash of the key and the partition the key was written to, filed under a slot of the hash. A merge
asks the index, not the table: it reads the slots of its own keys and gets the partitions that may hold an older version.

Entries are only ever added while an index lives. Two keys of one hash, an entry written twice and an entry of a key that
has moved on each name a partition too many, which a merge then rewrites without effect; none ever names one too few,
because entries are added before the table changes. After ``TIDY_AFTER`` additions the index is made anew from the table,
which takes such entries out and joins small files.

An index counts only with its state, one row written last. Whoever replaces the table takes the state away first, so an
index that a broken run left behind is not read: the next merge makes it anew by one scan of the key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwright.session import remove

#: Entries in a slot when an index is made (some 40 MB), and the most slots, each a folder: beyond, slots are larger.
SLOT_ENTRIES, MOST_SLOTS = 4_000_000, 4096
TIDY_AFTER = 64

HASH, PLACE, SLOT = "key_hash", "place", "slot"
_STATE = "entries string, slots int, additions int"


@dataclass(frozen=True)
class KeyIndex:
    """The index below ``root`` of a table that is partitioned by ``partition`` and has one row per ``key``."""

    root: str
    key: tuple[str, ...]
    partition: str
    slot_entries: int = SLOT_ENTRIES
    tidy_after: int = TIDY_AFTER

    def _state(self, spark: SparkSession):
        try:
            return spark.read.schema(_STATE).parquet(f"{self.root}/state").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _publish(self, spark: SparkSession, entries: str, slots: int, additions: int) -> None:
        state = spark.range(1).select(F.lit(entries).alias("entries"), F.lit(slots).alias("slots"), F.lit(additions).alias("additions"))
        state.write.mode("overwrite").parquet(f"{self.root}/state")

    def forget(self) -> None:
        """To be called before the table is replaced."""
        remove(f"{self.root}/state")
        remove(self.root)

    def _hash(self) -> Column:
        return F.xxhash64(*self.key)

    def _write(self, rows: DataFrame, entries: str, slots: int) -> None:
        hashed = rows.select(self._hash().alias(HASH), F.col(self.partition).cast("string").alias(PLACE))
        (
            hashed.withColumn(SLOT, F.pmod(HASH, F.lit(slots)).cast("int")).hint("rebalance", SLOT)
            .sortWithinPartitions(SLOT, PLACE).write.mode("append").partitionBy(SLOT).parquet(f"{self.root}/{entries}")
        )

    def build(self, table: DataFrame) -> None:
        """Make the index anew from the written table: one scan of its keys."""
        spark = table.sparkSession
        before = self._state(spark)
        rows = table.select(*self.key, self.partition)
        slots = min(MOST_SLOTS, max(1, -(-rows.count() // self.slot_entries)))
        entries = f"entries-{uuid.uuid4().hex}"
        self._write(rows, entries, slots)
        self._publish(spark, entries, slots, 0)
        if before is not None:
            remove(f"{self.root}/{before.entries}")

    def add(self, rows: DataFrame) -> None:
        """Enter ``rows``; to be called before the table gets them. A no-op for an index that does not stand."""
        spark = rows.sparkSession
        state = self._state(spark)
        if state is not None:
            self._write(rows, state.entries, state.slots)
            self._publish(spark, state.entries, state.slots, state.additions + 1)

    def entries(self, spark: SparkSession) -> DataFrame:
        schema = f"{HASH} bigint, {PLACE} string, {SLOT} int"
        return spark.read.schema(schema).parquet(f"{self.root}/{self._state(spark).entries}")

    def places(self, rows: DataFrame) -> DataFrame:
        """Partitions in which a version of the keys of ``rows`` may stand, one row each. Reads the slots of these keys
        alone; their numbers (at most ``MOST_SLOTS``) pass through the driver."""
        spark = rows.sparkSession
        slots = self._state(spark).slots
        asked = rows.select(self._hash().alias(HASH)).distinct()
        touched = [r[0] for r in asked.select(F.pmod(HASH, F.lit(slots)).cast("int")).distinct().collect()]
        found = self.entries(spark).filter(F.col(SLOT).isin(touched)).join(asked, HASH, "left_semi")
        return found.select(F.col(PLACE).alias(self.partition)).distinct()

    def ready(self, table: DataFrame) -> KeyIndex:
        """This index, made from the table if it does not stand, and made anew when it has grown by many additions."""
        state = self._state(table.sparkSession)
        if state is None or state.additions >= self.tidy_after:
            self.build(table)
        return self
