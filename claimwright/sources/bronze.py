"""Bronze tables: raw strings plus provenance, laid out by ingestion date and source file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from claimwright.functions.columns import lineage_date
from claimwright.session import COMPRESSION

LAYOUT = ("ingestion_date", "source_file")


def with_provenance(rows: DataFrame, hashes: DataFrame, at: str) -> DataFrame:
    """Add ``ingestion_timestamp`` and ``file_hash``; ``source_file`` comes from the scan.

    ``hashes`` has one row per file, so Spark's size check makes this a broadcast join.
    """
    return rows.join(hashes.select("source_file", "file_hash"), "source_file").withColumn(
        "ingestion_timestamp", F.lit(at)
    )


def write_bronze(rows: DataFrame, path: str) -> None:
    """Replace the output of exactly the files present in ``rows`` for that day, nothing else."""
    (
        rows.withColumn("ingestion_date", lineage_date("ingestion_timestamp"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYOUT)
        .parquet(path, compression=COMPRESSION)
    )


def _missing(path: str, e: AnalysisException) -> Exception:
    if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
        return FileNotFoundError(f"no Bronze data under {path}; ingest first")
    return e


def latest_date(spark: SparkSession, path: str) -> str:
    """Newest ingestion_date, found from the listing without opening a file."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        newest = files.agg(F.max(F.col("ingestion_date").cast("string"))).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "UNRESOLVED_COLUMN.WITH_SUGGESTION":
            raise FileNotFoundError(f"no Bronze partition under {path}") from e
        raise _missing(path, e) from e
    if newest is None:
        raise FileNotFoundError(f"no Bronze partition under {path}")
    return newest


_SNAPSHOT = "snapshot_at string, ingestion_date string, source_file string, file_hash string"


def _snapshots(path: str) -> str:
    return f"{path}.snapshots"


def publish(landed: DataFrame, path: str, at: str) -> None:
    """Record the files (source_file, file_hash) of a complete snapshot; from then on it is the one that is read."""
    rows = landed.select(F.lit(at).alias("snapshot_at"), F.lit(at[:10]).alias("ingestion_date"), "source_file", "file_hash")
    rows.coalesce(1).write.mode("append").parquet(_snapshots(path))


def current_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """Files of the newest complete snapshot; None where none was ever recorded."""
    try:
        rows = spark.read.schema(_SNAPSHOT).parquet(_snapshots(path))
        newest = rows.agg(F.max("snapshot_at")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if newest is None else rows.filter(F.col("snapshot_at") == newest)


def read_full(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Newest complete snapshot only: date and file are partitions, so nothing else is opened.

    A table that was written without ever recording a snapshot is read by its newest date.
    """
    published = current_snapshot(spark, path)
    newest = latest_date(spark, path) if published is None else published.first()["ingestion_date"]
    typed = StructType(schema.fields).add("ingestion_date", StringType())
    rows = spark.read.schema(typed).parquet(path).filter(F.col("ingestion_date") == newest)
    if published is not None:
        rows = rows.join(published.select("source_file"), "source_file", "left_semi").select(*typed.names)
    return rows.drop("ingestion_date").withColumn("bronze_ingestion_date", lineage_date("ingestion_timestamp"))


def read_incremental(spark: SparkSession, path: str) -> DataFrame:
    """Every partition, columns united by name across files written at different times."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        raise _missing(path, e) from e
