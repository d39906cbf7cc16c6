"""Claims as a stream: windowed volumes, and micro-batches merged into Silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from claimwright.contracts import CLAIMS
from claimwright.operators.cleaning import conform
from claimwright.operators.lookup import row_identity
from claimwright.plans.backfill import backfill_claims
from claimwright.plans.silver import DIMENSIONS, build_claims
from claimwright.session import staging, streams_sized_for
from claimwright.sources.sinks import Layout

EVENT_TIME = "submitted_at"


def read_claims(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw claims from a folder of Bronze files, as they arrive."""
    reader = spark.readStream.schema(CLAIMS.bronze_schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def timed(raw: DataFrame, delay: str) -> DataFrame:
    """Typed claims with the submission day as event time, late by at most ``delay``.

    Claims without a readable submission date have no event time and stay out; the batch job
    quarantines them.
    """
    typed = conform(raw, CLAIMS).withColumn(EVENT_TIME, F.col("submission_date").cast("timestamp"))
    return typed.filter(F.col(EVENT_TIME).isNotNull()).withWatermark(EVENT_TIME, delay)


def without_resends(claims: DataFrame) -> DataFrame:
    """One row per identical content, once no copy of it can arrive any more.

    Copies have one submission day, so the watermark that passes it closes their group: later ones are late. A group is
    known by 128 bits of its content, not by the content, and holds only the columns that are asked of it. It is an
    aggregate, so copies leave every input partition as one row, and each content is kept once.
    """
    identity = row_identity(CLAIMS.business)
    keys = [EVENT_TIME, "_row", "_check"]
    rest = [c for c in claims.columns if c != EVENT_TIME]
    grouped = claims.select("*", *identity).groupBy(*keys).agg(*[F.first(c).alias(c) for c in rest])
    return grouped.select(*claims.columns)


def volume_by_window(claims: DataFrame, width: str) -> DataFrame:
    """Claims, denials and billed amount per window of submission."""
    return claims.groupBy(F.window(EVENT_TIME, width)).agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.count_if(F.lower("claim_status") == "denied").alias("denied_claims"),
        F.sum("billed_amount").alias("billed_amount"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             "claim_count", "denied_claims", "billed_amount")


def sessions(claims: DataFrame, key: str, gap: str) -> DataFrame:
    """Runs of submissions of one ``key``, each at most ``gap`` after the one before.

    A late row within the watermark extends, or joins, the sessions that it falls between. Sessions are merged in every
    input partition before the shuffle if ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is set,
    as this library's sessions have it, so that a hot key arrives as its sessions and not as its rows.
    """
    return claims.groupBy(key, F.session_window(EVENT_TIME, gap)).agg(
        F.count(F.lit(1)).alias("claim_count"), F.sum("billed_amount").alias("billed_amount"),
    ).select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
             "claim_count", "billed_amount")


def write_windows(windows: DataFrame, path: str, checkpoint: str, size: int = 0) -> StreamingQuery:
    """Append each window or session once it can no longer change; processes what is there and stops.

    ``size``: bytes of what a first run reads, where known.
    """
    with streams_sized_for(windows.sparkSession, size):
        return (
            windows.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def merge_into_silver(
    raw: DataFrame, layout: Layout, dimensions: Callable[[], dict[str, DataFrame]], checkpoint: str
) -> StreamingQuery:
    """Validate every micro-batch against the dimensions and merge its valid claims into Silver.

    Quarantined rows are appended. A batch that is run again after a failure gives the same Silver
    rows, because the merge keeps one row per claim.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, dims = batch.sparkSession, dimensions()
        with staging(spark) as stage:
            # Checked once; both outputs read the staged rows.
            built = build_claims(batch, *[dims[d] for d in DIMENSIONS], stage=lambda df: stage(df, "checked"))
            backfill_claims(spark, layout, built.silver)
            marked = built.quarantine.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            (
                marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
                .parquet(f"{layout.quarantine('claims')}_stream")
            )

    return (
        raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
