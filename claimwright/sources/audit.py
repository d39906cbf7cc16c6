"""Audit log of ingestion attempts: one row per state change, in versions that are never changed.

The log of a source is a chain of segments, each a folder of one write, named by a versioned table with the segment as its
partition. A write adds a segment; after ``COMPACT_AFTER`` of them the same write puts all older events into one, so the
number of files that a run reads is bounded by it, whatever the number of runs. Events are kept as they are: history, known
hashes and known files come from the same rows before and after.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.sources.versions import VersionedTable

IN_PROGRESS, SUCCESS, SUCCESS_WITH_DRIFT, FAILED = "IN_PROGRESS", "SUCCESS", "SUCCESS_WITH_DRIFT", "FAILED"
#: A good file of a snapshot that another file spoils: not landed, and no failure of its own.
HELD_BACK = "HELD_BACK"
SKIPPED = "SKIPPED_ALREADY_INGESTED"
SUCCESSES = [SUCCESS, SUCCESS_WITH_DRIFT]

SCHEMA = (
    "ingestion_id string, source_name string, source_file string, file_hash string, load_type string, "
    "event_time string, status string, record_count bigint, error_message string, target_path string, "
    "bytes bigint, modified_time string, listed_at string"
)
#: Segments of a source's log; the write that would exceed them joins them into one.
COMPACT_AFTER = 32
_SEGMENT = "segment"
#: Writes after which a history that was read earlier may no longer be evaluated.
KEPT = 8
HISTORY = [
    "ingestion_id", "source_name", "source_file", "file_hash", "ingestion_start_time", "ingestion_end_time",
    "record_count", "status", "error_message", "load_type", "target_path",
]


class AuditLog:
    def __init__(self, spark: SparkSession, path: str, compact_after: int = COMPACT_AFTER) -> None:
        self.spark, self.path, self.compact_after = spark, path, compact_after

    def table(self, source_name: str) -> VersionedTable:
        return VersionedTable(f"{self.path}/source_name={source_name}", kept=KEPT)

    def source_names(self) -> list[str]:
        """Sources with a log: a listing of one folder."""
        store, at = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
        return sorted(f.base_name.split("=", 1)[1] for f in found if f.base_name.startswith("source_name="))

    def events(self, source_name: str | None = None) -> DataFrame:
        """Every state change, of one source or all; empty before the first append."""
        nothing = self.spark.createDataFrame([], SCHEMA)
        parts = []
        for name in self.source_names() if source_name is None else [source_name]:
            table = self.table(name)
            if table.versions():
                parts.append(table.read(self.spark).withColumn("source_name", F.lit(name)).select(*nothing.columns))
        return reduce(DataFrame.unionAll, parts) if parts else nothing

    def append(self, events: DataFrame, source_name: str | None = None) -> None:
        """Add state changes; columns that are absent are NULL.

        A log per source: a run reads that of its own, and runs of several sources write at once. Where no source is
        named, the events are those of all that they hold, one after another.
        """
        if source_name is None:
            for name in [r[0] for r in events.select("source_name").distinct().collect()]:  # declared sources: few
                self.append(events.filter(F.col("source_name") == name), name)
            return
        names = [f.strip().split()[0] for f in SCHEMA.split(",")]
        kinds = dict(f.strip().split() for f in SCHEMA.split(","))
        full = [(F.col(n) if n in events.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names if n != "source_name"]
        rows, table = events.select(*full), self.table(source_name)
        number, segments = table.parts()
        if len(segments) >= self.compact_after:
            rows, replaced = table.read(self.spark).drop(_SEGMENT).unionByName(rows), list(segments)
        else:
            replaced = []
        segment = f"s{number + 1:08d}"
        table.replace_partitions(rows.withColumn(_SEGMENT, F.lit(segment)), _SEGMENT, [*replaced, segment])

    def started(self, files: DataFrame, source_name: str, load_type: str, at: str) -> DataFrame:
        """Attempts to begin. An id is a digest over this run's id, so a task run twice yields the same.

        Size and time of the files and when they were listed, where given, let a later run know them unopened.
        """
        identity = F.concat_ws("|", F.lit(uuid.uuid4().hex), F.lit(source_name), "source_file", "file_hash")
        return files.select(
            F.sha2(identity, 256).alias("ingestion_id"), F.lit(source_name).alias("source_name"), "source_file",
            "file_hash", F.lit(load_type).alias("load_type"), F.lit(at).alias("event_time"),
            F.lit(IN_PROGRESS).alias("status"), *[c for c in ("bytes", "modified_time", "listed_at") if c in files.columns],
        )

    def history(self, source_name: str | None = None) -> DataFrame:
        """One row per attempt in its latest state, oldest first."""
        events = self.events(source_name)
        done = F.col("status") != IN_PROGRESS
        latest = F.max(F.struct("event_time", done.alias("done"), "status", "record_count", "error_message", "target_path"))
        attempts = events.groupBy("ingestion_id", "source_name", "source_file", "file_hash", "load_type").agg(
            F.min("event_time").alias("ingestion_start_time"), latest.alias("s")
        )
        ended = F.when(F.col("s.done"), F.col("s.event_time")).alias("ingestion_end_time")
        state = attempts.select("*", ended, "s.status", "s.record_count", "s.error_message", "s.target_path")
        return state.select(*HISTORY).orderBy("ingestion_start_time", "ingestion_id")

    def ingested(self, source_name: str) -> DataFrame:
        """Content hashes of a source that were landed successfully."""
        ok = F.col("status").isin(SUCCESSES)
        return self.events(source_name).filter(ok).select("file_hash").distinct()

    def landed(self, source_name: str) -> DataFrame:
        """Files that were landed, as they were then: name, size, time and content hash.

        Only those whose time had passed when they were listed: what is written to a file after that shows another
        time. A time without a fraction may be that of a store with whole seconds.
        """
        at, listed = F.col("modified_time").cast("timestamp"), F.col("listed_at").cast("timestamp")
        step = F.when(F.unix_millis(at) % 1000 == 0, 1000).otherwise(1)
        ok = F.col("status").isin(SUCCESSES) & (F.unix_millis(at) + step <= F.unix_millis(listed))
        # A file that came back to an earlier time and size has the hash it was last landed with.
        last = F.max_by("file_hash", "event_time").alias("file_hash")
        return self.events(source_name).filter(ok).groupBy("source_file", "bytes", "modified_time").agg(last)

    def keep_outcome(self, outcome: DataFrame, source_name: str) -> DataFrame:
        """What a run did with each file, beside the log. It stays until the second run after it."""
        table = VersionedTable(f"{self.path}.outcomes/source_name={source_name}")
        table.replace(outcome.coalesce(1))
        return table.read(self.spark).orderBy("source_file")
