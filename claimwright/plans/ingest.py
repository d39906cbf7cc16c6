"""Landed files to Bronze: find, skip what is known, check, land, record, publish."""

from __future__ import annotations

import datetime as dt
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from claimwright.session import concurrently, small_tasks, staging
from claimwright.sources import audit, drift, files
from claimwright.sources.audit import AuditLog
from claimwright.sources.bronze import current_snapshot, publish, with_provenance, write_bronze
from claimwright.sources.registry import Source

STATUS = "source_name string, source_file string, status string, message string"
_UNCHANGED = ["source_file", "bytes", "modified_time"]


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def _files(spark: SparkSession, source: Source, log: AuditLog, force: bool, verify: bool, stage) -> DataFrame:
    """Every file with its hash and ``todo``; header and faults of those whose content was read.

    A file that the log knows by name, size and time is not opened, unless ``verify`` asks for it. A full load is a snapshot: it is landed again
    as a whole unless its contents are just those of the snapshot that is published.
    """
    time.sleep(0.002)  # files written before this call are older than the millisecond of the listing
    at = F.lit(_now()).alias("listed_at")
    listing = stage(files.discover(spark, source).select("*", at), "listing")
    if not listing.groupBy("source_file").count().filter("count > 1").isEmpty():
        raise ValueError(f"source {source.name}: file names must be unique, also across folders")
    known = log.landed(source.name).limit(0) if verify else log.landed(source.name)
    same = listing.join(known, _UNCHANGED).select(*listing.columns, "file_hash")
    fresh = listing if force else listing.join(known, _UNCHANGED, "left_anti")
    read = stage(files.profile(spark, fresh), "profile")
    if force:
        return read.withColumn("todo", F.lit(True))
    kept = stage(same, "unchanged")
    if source.load_type != "full":
        seen = log.ingested(source.name).withColumn("_seen", F.lit(True))
        new = read.join(seen, "file_hash", "left").withColumn("todo", F.col("_seen").isNull()).drop("_seen")
        return new.unionByName(kept.withColumn("todo", F.lit(False)), allowMissingColumns=True)
    published = current_snapshot(spark, source.bronze_path)
    here = read.select("file_hash").unionByName(kept.select("file_hash")).distinct()
    if published is not None:
        there = published.select("file_hash").distinct()
        if here.exceptAll(there).isEmpty() and there.exceptAll(here).isEmpty():
            return read.unionByName(kept, allowMissingColumns=True).withColumn("todo", F.lit(False))
    again = stage(files.profile(spark, kept.drop("file_hash")), "profile-again")
    return read.unionByName(again).withColumn("todo", F.lit(True))


def _checked(found: DataFrame, source: Source) -> DataFrame:
    """Add ``status`` and ``message``. Of equal contents the first name is landed, the others are skipped."""
    checked = drift.check_columns(found, source, columns="header").withColumnRenamed("status", "_contract")
    repeated = F.size("header") > F.size(F.array_distinct("header"))
    fault = F.when(F.col("error").isNotNull(), F.concat(F.lit("Cannot be read: "), F.col("error")))
    fault = F.coalesce(fault, F.when(F.col("_contract") == drift.FAILED, F.col("message")), F.when(repeated, F.lit("A column name is repeated in the header.")))
    first = F.min("source_file").over(Window.partitionBy("file_hash"))
    checked = checked.withColumns({"_fault": F.when(F.col("todo"), fault), "_first": first})
    copy = F.col("source_file") > F.col("_first")
    status = (
        F.when(~F.col("todo"), audit.SKIPPED).when(F.col("_fault").isNotNull(), audit.FAILED).when(copy, audit.SKIPPED)
        .when(F.col("_contract") == drift.PASSED, audit.SUCCESS).otherwise(audit.SUCCESS_WITH_DRIFT)
    )
    message = F.when(~F.col("todo"), "").when(F.col("_fault").isNotNull(), F.col("_fault")).when(copy, F.concat(F.lit("Same content as "), F.col("_first"))).otherwise(F.col("message"))
    kept = ["path", "source_file", "modified_time", "bytes", "listed_at", "file_hash", "header", "spanning"]
    return checked.select(*kept, status.alias("status"), message.alias("message"))


def _land(spark: SparkSession, source: Source, good: DataFrame, at: str) -> None:
    """Write the files, one job for each header: the jobs follow the variants of headers, not the files."""
    hashes = good.select("source_file", "file_hash")
    for variant in good.select("header", "spanning").distinct().collect():
        alike = good.filter((F.col("header") == F.lit(variant["header"])) & (F.col("spanning") == variant["spanning"]))
        paths = [r["path"] for r in alike.select("path").collect()]  # the scan's own list of files
        rows = files.read_csv(spark, paths, variant["header"], multiline=variant["spanning"], limit=files.FIELD_LIMIT)
        write_bronze(with_provenance(rows, hashes, at), source.bronze_path)


def _counts(spark: SparkSession, source: Source, at: str) -> DataFrame:
    """Rows per file landed that day, counted from partition columns alone."""
    landed = spark.read.schema("ingestion_date string, source_file string").parquet(source.bronze_path)
    today = landed.filter(F.col("ingestion_date") == at[:10])
    return today.groupBy("source_file").agg(F.count(F.lit(1)).alias("record_count"))


def ingest_source(
    spark: SparkSession,
    name: str,
    sources: dict[str, Source],
    log: AuditLog,
    force: bool = False,
    at: str | None = None,
    verify: bool = False,
) -> DataFrame:
    """Ingest every file of one source. Returns (source_name, source_file, status, message).

    A bad file does not stop the others. A full load is published only if none of its files failed: readers of
    the newest snapshot keep the last one that was complete. On the day of a published snapshot its outputs
    are left alone until all files are good; until then those that are have the status HELD_BACK, which is no failure.
    A fault that no file caused fails the run.

    ``verify`` hashes every file, also those that the log knows by name, size and time, and lands what differs; ``force``
    lands every file whatever it holds.
    """
    if name not in sources:
        raise ValueError(f"unknown source {name}; known: {sorted(sources)}")
    source, at = sources[name], at or _now()
    small_tasks(spark)
    with staging(spark) as stage:
        checked = stage(_checked(_files(spark, source, log, force, verify, stage), source), "checked")
        todo = checked.filter(F.col("status") != audit.SKIPPED)
        if todo.isEmpty():
            return _outcome(spark, name, checked, log)
        failed = not todo.filter(F.col("status") == audit.FAILED).isEmpty()
        if failed and source.load_type == "full":
            published = current_snapshot(spark, source.bronze_path)
            if published is not None and published.first()["ingestion_date"] == at[:10]:
                held = F.col("status").isin(audit.SUCCESSES)
                why = F.lit("Held back: another file of the snapshot failed.")
                checked = checked.withColumns({"message": F.when(held, why).otherwise(F.col("message")), "status": F.when(held, audit.HELD_BACK).otherwise(F.col("status"))})
                todo = checked.filter(F.col("status") != audit.SKIPPED)

        attempts = stage(log.started(todo, name, source.load_type, at), "attempts")
        log.append(attempts, name)
        good = todo.filter(F.col("status").isin(audit.SUCCESSES))
        landed = not good.isEmpty()
        try:
            if landed:
                _land(spark, source, good, at)
        except Exception as e:
            why = F.lit(f"Unexpected error: {str(e).splitlines()[0]}")
            log.append(attempts.withColumns({"status": F.lit(audit.FAILED), "error_message": why, "event_time": F.lit(_after(at))}), name)
            raise
        target = F.concat(F.lit(f"{source.bronze_path}/ingestion_date={at[:10]}/source_file="), F.col("source_file"))
        ok = F.col("status").isin(audit.SUCCESSES)
        ended = todo.select(
            "source_file", "status", F.when(~ok, F.col("message")).alias("error_message"), F.when(ok, target).alias("target_path"))
        if landed:
            ended = ended.join(_counts(spark, source, at), "source_file", "left")
            ended = ended.withColumn("record_count", F.when(ok, F.coalesce("record_count", F.lit(0))))
        log.append(attempts.drop("status", "event_time").join(ended, "source_file").withColumn("event_time", F.lit(_after(at))), name)
        if source.load_type == "full" and not failed:
            publish(good.select("source_file", "file_hash"), source.bronze_path, at)
        return _outcome(spark, name, checked, log)


def _outcome(spark: SparkSession, name: str, checked: DataFrame, log: AuditLog) -> DataFrame:
    """Kept beside the log: it outlives the run's staged tables."""
    return log.keep_outcome(checked.select(F.lit(name).alias("source_name"), "source_file", "status", "message"), name)


def _after(at: str) -> str:
    """End time: now, but never before the start (which a caller may set)."""
    return max(_now(), at)


def ingest_all(spark: SparkSession, sources: dict[str, Source], log: AuditLog, force: bool = False, at: str | None = None,
               verify: bool = False) -> DataFrame:
    """Every source, side by side; rows with status FAILED mean that the run failed."""
    jobs = [lambda n=n: ingest_source(spark, n, sources, log, force, at, verify) for n in sources]
    return reduce(DataFrame.unionByName, concurrently(*jobs))


def failures(outcome: DataFrame) -> DataFrame:
    return outcome.filter(F.col("status") == audit.FAILED)
