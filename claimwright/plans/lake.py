"""The jobs that write the layers: Silver from Bronze, Gold from Silver, and all of it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from claimwright.contracts import CONTRACTS
from claimwright.plans import gold as g
from claimwright.plans import silver as s
from claimwright.plans.ingest import failures, ingest_all
from claimwright.session import COMPRESSION, IN_MEMORY, concurrently, input_bytes, remove, shared_dir, shuffles_sized_for, small_tasks, staging
from claimwright.sources import sinks
from claimwright.sources.audit import AuditLog
from claimwright.sources.bronze import read_full, read_incremental
from claimwright.sources.registry import Source
from claimwright.sources.sinks import Layout


def read_bronze(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    frames = {n: read_full(spark, layout.bronze(n), CONTRACTS[n].bronze_schema) for n in s.DIMENSIONS}
    return frames | {"claims": read_incremental(spark, layout.bronze("claims"))}


def stage_as(spark: SparkSession, name: str, root: str) -> s.Stage:
    """Validated rows as a table in the shared folder. Silver, quarantine and metrics all read it,
    so the cleaning, the copies shuffle and the lookups run once, and a lost executor costs no
    recomputation from Bronze."""

    small_tasks(spark)

    def stage(df: DataFrame) -> DataFrame:
        path = f"{root}/stage/{name}"
        df.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        return spark.read.parquet(path)

    return stage


def write_built(spark: SparkSession, built: s.Built, layout: Layout) -> DataFrame:
    """Write one dataset's three outputs, and for claims the index of their keys; returns the Silver table as read back.

    The survivors of claims are a staged table, so that the shuffle that finds them is gone before that of the months begins.
    """
    partition_by = ("service_year_month",) if built.name == "claims" else ()

    def silver_and_metrics() -> DataFrame:
        if partition_by:
            with staging(spark) as stage:
                silver = sinks.write_silver(stage(built.silver, "survivors"), layout, built.name, partition_by)
        else:
            silver = sinks.write_silver(built.silver, layout, built.name)
        jobs = [lambda: sinks.write_metrics(built.metrics(silver), layout, built.name)]
        if built.name == "claims":
            jobs.append(lambda: layout.claim_index().build(silver))
        concurrently(*jobs)
        return silver

    silver, _ = concurrently(silver_and_metrics, lambda: sinks.write_quarantine(built.quarantine, layout, built.name))
    return silver


def write_layers(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    layout: Layout,
    datasets: Iterable[str] = s.ALL,
    as_of: dt.date | str | None = None,
) -> dict[str, DataFrame]:
    """Silver tables of the requested datasets. The dimensions do not depend on one another.

    Claims need the dimensions: those not requested are built but written only to the shared folder.
    """
    wanted = set(datasets)
    unknown = wanted - set(s.ALL)
    if unknown:
        raise ValueError(f"unknown dataset(s): {sorted(unknown)}")
    scratch = shared_dir(spark, "silver", uuid.uuid4().hex)
    try:
        return _layers(spark, bronze, layout, wanted, as_of, scratch)
    finally:
        remove(scratch)  # what is returned reads the layers themselves


def _layers(
    spark: SparkSession, bronze: dict[str, DataFrame], layout: Layout, wanted: set[str], as_of: dt.date | str | None, scratch: str
) -> dict[str, DataFrame]:
    def dimension(name: str) -> DataFrame:
        stage = stage_as(spark, name, scratch)
        if name == "members":
            built = s.build_members(bronze[name], as_of, stage)
        else:
            built = {"providers": s.build_providers, "diagnoses": s.build_diagnoses}[name](bronze[name], stage)
        return write_built(spark, built, layout if name in wanted else Layout(scratch))

    needed = [d for d in s.DIMENSIONS if d in wanted or "claims" in wanted]
    silver = dict(zip(needed, concurrently(*[partial(dimension, d) for d in needed]))) if needed else {}
    if "claims" in wanted:
        dims = [silver[d] for d in s.DIMENSIONS]
        built = s.build_claims(bronze["claims"], *dims, stage=stage_as(spark, "claims", scratch))
        silver["claims"] = write_built(spark, built, layout)
    return {name: silver[name] for name in s.ALL if name in wanted}


def run_silver(
    spark: SparkSession, layout: Layout, datasets: Iterable[str] = s.ALL, as_of: dt.date | str | None = None
) -> dict[str, DataFrame]:
    """Silver from the Bronze tables, with shuffles sized for their volume."""
    with shuffles_sized_for(spark, IN_MEMORY * input_bytes(spark, f"{layout.root}/bronze")):
        return write_layers(spark, read_bronze(spark, layout), layout, datasets, as_of)


def run_gold(spark: SparkSession, layout: Layout, views: bool = True, only: str | None = None) -> dict[str, DataFrame]:
    """Gold from the Silver tables, or ``only`` one table of it. The fact reads the written dimensions, whose size is known."""
    dims = {"dim_member": ("members", g.dim_member), "dim_provider": ("providers", g.dim_provider)}
    with shuffles_sized_for(spark, IN_MEMORY * input_bytes(spark, f"{layout.root}/silver")):
        wanted = [n for n in dims if only in (None, n)]

        def written(name: str) -> DataFrame:
            dataset, build = dims[name]
            return sinks.materialise(spark, build(sinks.read_silver(spark, layout, dataset)), layout, name, views)

        tables = dict(zip(wanted, concurrently(*[partial(written, n) for n in wanted]))) if wanted else {}
        if only in (None, "fact_claims"):
            sides = [tables[n] if n in tables else spark.read.parquet(layout.gold(n)) for n in dims]
            fact = g.fact_claims(sinks.read_silver(spark, layout, "claims"), *sides)
            tables["fact_claims"] = sinks.materialise(spark, fact, layout, "fact_claims", views)
    return tables


def quarantine_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {f"quarantine_{n}": spark.read.parquet(layout.quarantine(n)) for n in s.ALL}


def run_lake(
    spark: SparkSession,
    sources: dict[str, Source],
    layout: Layout,
    log_path: str,
    as_of: dt.date | str | None = None,
    skip_gold: bool = False,
    at: str | None = None,
) -> dict[str, DataFrame]:
    """Landed files to Gold; stops at the first layer that fails. Returns the tables by name."""
    failed = failures(ingest_all(spark, sources, AuditLog(spark, log_path), at=at)).collect()
    if failed:
        raise RuntimeError("ingestion failed: " + "; ".join(f"{r.source_file}: {r.message}" for r in failed))
    tables = run_silver(spark, layout, as_of=as_of) | quarantine_tables(spark, layout)
    if not skip_gold:
        tables |= run_gold(spark, layout)
    return tables
