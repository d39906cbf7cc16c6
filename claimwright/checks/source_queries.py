"""Registered queries of the sources and sinks: each lands, reads or writes the whole test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.checks import scratch
from claimwright.checks.oracle import AS_OF
from claimwright.checks.registry import _METRIC_SQL, add
from claimwright.contracts import CLAIMS, CONTRACTS, MEMBERS, PROVENANCE
from claimwright.operators import metrics as m
from claimwright.plans import silver as s
from claimwright.plans.ingest import ingest_all, ingest_source
from claimwright.session import ship
from claimwright.sources import audit, drift, files, sinks
from claimwright.sources import bronze as b
from claimwright.sources.records import read_records
from claimwright.sources.registry import default_sources

# What the landed claim files hold, one row per file, as DuckDB sees it.
_business = ", ".join(CLAIMS.business)
_first_batch = [c for c in CLAIMS.business if c != "adjustment_amount"]


def _file_sql(columns: list[str], where: str) -> str:
    line = " || ',' || ".join(columns)
    return f"""select drop_id, concat('{','.join(columns)}', chr(10), string_agg(line, chr(10) order by {_business}), chr(10)) as content,
  count(*) as row_count, {len(columns) > len(_first_batch)} as has_drift
  from (select *, {line} as line from landed where {where}) group by drop_id"""


_FILES = f"""(with landed as (
  select *, replace(source_file, '.csv', '') || '-' || (cast(split_part(substr(claim_id, 2), '-', 1) as bigint) // {scratch.ORDERS_PER_FILE}) as drop_id
  from bronze_claims)
  {_file_sql(_first_batch, "drop_id like 'claims_batch_1%'")} union all {_file_sql(CLAIMS.business, "drop_id not like 'claims_batch_1%'")})"""
_status = "case when has_drift then 'SUCCESS_WITH_DRIFT' else 'SUCCESS' end"


def _source(spark: SparkSession, sf: str, root: str, name: str = "claims"):
    return scratch.sources(spark, sf, f"{root}/bronze")[name]


def _profile(spark: SparkSession, sf: str, label: str) -> DataFrame:
    return files.profile(spark, files.discover(spark, _source(spark, sf, scratch.fresh(spark, label))))


def _ingested(spark: SparkSession, sf: str, label: str, runs: tuple[bool, ...] = (False,)):
    """Ingest the claim files into a fresh Bronze, once per entry of ``runs`` (its value is ``force``)."""
    root = scratch.fresh(spark, label)
    declared, log = scratch.sources(spark, sf, f"{root}/bronze"), audit.AuditLog(spark, f"{root}/log")
    outcome = None
    for i, force in enumerate(runs):
        at = scratch.AT.replace("T00", f"T0{i}")
        outcome = ingest_source(spark, "claims", declared, log, force=force, at=at)
    return declared["claims"], log, outcome


_registry_sql = {
    "members": ("full", "fail", 11, 9),
    "providers": ("full", "fail", 8, 7),
    "diagnoses": ("full", "fail", 3, 3),
    "claims": ("incremental", "warn", 12, 10),
}


@add("s01_source_registry", " union all ".join(
    f"select '{n}' as name, '{load}' as load_type, '{policy}' as schema_drift_policy, {e} as expected, {r} as required, count(*) as row_count from bronze_{n}"
    for n, (load, policy, e, r) in _registry_sql.items()))
def _(spark, sf):
    """The declared sources beside the rows each of them delivers."""
    raw = scratch.raw(spark, sf)
    parts = []
    for n, src in default_sources().items():
        fields = {"name": n, "load_type": src.load_type, "schema_drift_policy": src.schema_drift_policy,
                  "expected": len(src.expected_columns), "required": len(src.required_columns)}
        counted = raw[n].agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(counted.select(*[F.lit(x).alias(k) for k, x in fields.items()], "row_count"))
    return reduce(DataFrame.unionByName, parts)


@add("s02_file_discovery", f"select octet_length(encode(content)) as bytes from {_FILES}")
def _(spark, sf):
    return files.discover(spark, _source(spark, sf, scratch.fresh(spark, "s02"))).select("bytes")


@add("s03_content_hash", f"select sha256(content) as file_hash, octet_length(encode(content)) as bytes from {_FILES}")
def _(spark, sf):
    return _profile(spark, sf, "s03").select("file_hash", "bytes")


@add("s03_line_hash_of_large_files", f"select split_part(content, chr(10), 1) as header, false as multiline from {_FILES}")
def _(spark, sf):
    """What the pass that hashes a file learns beside the hash."""
    return _profile(spark, sf, "s03").select(F.array_join("header", ",").alias("header"), F.col("spanning").alias("multiline"))


@add("s04_csv_scan", "select cast(doc_id as varchar) as doc_id, lang, text from documents")
def _(spark, sf):
    """Whole texts through CSV and back: they hold commas, quotes and line breaks."""
    path = scratch.fresh(spark, "s04")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    docs.write.options(header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.read_csv(spark, [path], ["doc_id", "lang", "text"], multiline=True).drop("source_file")


@add("s04_csv_scan_in_splits", "select cast(doc_id as varchar) as doc_id, lang, text from documents")
def _(spark, sf):
    """The same, with the records put together from lines that are read in splits."""
    path = scratch.fresh(spark, "s04")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    docs.write.options(header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    ship(spark)
    return read_records(spark, [path], ["doc_id", "lang", "text"]).drop("source_file")


@add("s05_technical_columns", f"select '{scratch.AT}' as ingestion_timestamp, sha256(content) as file_hash, row_count from {_FILES}")
def _(spark, sf):
    source, _, _ = _ingested(spark, sf, "s05")
    rows = b.read_incremental(spark, source.bronze_path)
    return rows.groupBy("ingestion_timestamp", "file_hash").agg(F.count(F.lit(1)).alias("row_count"))


@add("s06_bronze_sink", f"select {', '.join(_first_batch)}, nullif(adjustment_amount, '') as adjustment_amount, '2024-07-01' as ingestion_date from bronze_claims")
def _(spark, sf):
    """Landed twice on one day with force: the second run replaces the first one's files."""
    source, _, _ = _ingested(spark, sf, "s06", runs=(False, True))
    rows = b.read_incremental(spark, source.bronze_path)
    added = F.nullif("adjustment_amount", F.lit("")).alias("adjustment_amount")
    return rows.select(*_first_batch, added, "ingestion_date")


@add("s07_idempotent_skip", f"select 'SKIPPED_ALREADY_INGESTED' as status, count(*) as file_count from {_FILES}")
def _(spark, sf):
    _, _, outcome = _ingested(spark, sf, "s07", runs=(False, False))
    return outcome.groupBy("status").agg(F.count(F.lit(1)).alias("file_count"))


@add("s08_forced_reprocess", f"select {_status} as status, count(*) as file_count from {_FILES} group by 1")
def _(spark, sf):
    _, _, outcome = _ingested(spark, sf, "s08", runs=(False, True))
    return outcome.groupBy("status").agg(F.count(F.lit(1)).alias("file_count"))


@add("s09_audit_log", f"""select 'claims' as source_name, status, file_hash, row_count from (
  select 'IN_PROGRESS' as status, sha256(content) as file_hash, cast(null as bigint) as row_count from {_FILES}
  union all select {_status}, sha256(content), row_count from {_FILES})""")
def _(spark, sf):
    _, log, _ = _ingested(spark, sf, "s09")
    return log.events().select("source_name", "status", "file_hash", F.col("record_count").alias("row_count"))


@add("s10_audit_history", f"""select ingestion_start_time, 'incremental' as load_type, {_status} as status, sha256(content) as file_hash,
  row_count as record_count, true as ended from {_FILES}
  cross join (select unnest(['2024-07-01T00:00:00+00:00', '2024-07-01T01:00:00+00:00']) as ingestion_start_time)""")
def _(spark, sf):
    _, log, _ = _ingested(spark, sf, "s10", runs=(False, True))
    return log.history("claims").select(
        "ingestion_start_time", "load_type", "status", "file_hash", "record_count",
        F.col("ingestion_end_time").isNotNull().alias("ended"),
    )


@add("s11_schema_contract", f"""select case when has_drift then 'PASSED_WITH_DRIFT' else 'PASSED' end as status, '' as missing,
  case when has_drift then 'adjustment_amount' else '' end as unexpected, count(*) as file_count from {_FILES} group by all""")
def _(spark, sf):
    source = _source(spark, sf, scratch.fresh(spark, "s11"))
    headers = _profile(spark, sf, "s11").select(F.col("header").alias("columns"))
    checked = drift.check_columns(headers, source)
    return checked.groupBy(
        "status", F.array_join("missing_required_columns", ",").alias("missing"),
        F.array_join("unexpected_columns", ",").alias("unexpected"),
    ).agg(F.count(F.lit(1)).alias("file_count"))


@add("s12_ingest_source", f"select 'claims' as source_name, {_status} as status, row_count as record_count from {_FILES}")
def _(spark, sf):
    _, log, outcome = _ingested(spark, sf, "s12")
    counts = log.history("claims").select("source_file", "record_count")
    return outcome.join(counts, "source_file").select("source_name", "status", "record_count")


@add("s13_ingest_all", f"""select 'claims' as source_name, {_status} as status, count(*) as file_count from {_FILES} group by all
  union all select * from (values ('members', 'SUCCESS', 2), ('providers', 'SUCCESS', 1), ('diagnoses', 'SUCCESS', 1))""")
def _(spark, sf):
    root = scratch.fresh(spark, "s13")
    outcome = ingest_all(spark, scratch.sources(spark, sf, f"{root}/bronze"), audit.AuditLog(spark, f"{root}/log"), at=scratch.AT)
    return outcome.groupBy("source_name", "status").agg(F.count(F.lit(1)).alias("file_count"))


def _two_snapshots(spark: SparkSession, sf: str) -> str:
    """Members landed on two days, the second time with other provenance."""
    path = scratch.fresh(spark, "snapshots")
    members = scratch.raw(spark, sf)["members"]
    for at in ("2024-03-01T00:00:00+00:00", "2024-04-01T00:00:00+00:00"):
        b.write_bronze(members.withColumn("ingestion_timestamp", F.lit(at)), path)
    return path


_members = ", ".join(MEMBERS.business)


@add("s14_full_load_read", f"select {_members}, '2024-04-01T00:00:00+00:00' as ingestion_timestamp from bronze_members")
def _(spark, sf):
    rows = b.read_full(spark, _two_snapshots(spark, sf), MEMBERS.bronze_schema)
    return rows.select(*MEMBERS.business, "ingestion_timestamp")


@add("s15_lineage_date", "select '2024-04-01' as bronze_ingestion_date, count(*) as row_count from bronze_members")
def _(spark, sf):
    rows = b.read_full(spark, _two_snapshots(spark, sf), MEMBERS.bronze_schema)
    return rows.groupBy("bronze_ingestion_date").agg(F.count(F.lit(1)).alias("row_count"))


@add("s16_incremental_read", "select claim_id, nullif(adjustment_amount, '') as adjustment_amount, cast(cast(ingestion_timestamp as timestamp) as date)::varchar as ingestion_date from bronze_claims")
def _(spark, sf):
    """Batches on different days, the first without the added column."""
    path = scratch.fresh(spark, "s16")
    claims = _claims(spark, sf)
    first = F.col("source_file") == "claims_batch_1.csv"
    b.write_bronze(claims.filter(first).drop("adjustment_amount"), path)
    b.write_bronze(claims.filter(~first), path)
    rows = b.read_incremental(spark, path)
    return rows.select("claim_id", F.nullif("adjustment_amount", F.lit("")).alias("adjustment_amount"), "ingestion_date")


def _claims(spark: SparkSession, sf: str) -> DataFrame:
    return scratch.raw(spark, sf)["claims"]


@add("s17_explicit_schemas", f"select {_members}, ingestion_timestamp, source_file, file_hash from bronze_members")
def _(spark, sf):
    path = scratch.fresh(spark, "s17")
    scratch.raw(spark, sf)["members"].write.parquet(path)
    rows = spark.read.schema(MEMBERS.bronze_schema).parquet(path)
    return rows.select(*[F.col(x).cast("string").alias(x) for x in (*MEMBERS.business, *PROVENANCE)])


@add("s18_silver_sink", "select claim_id, service_year_month from silver_claims")
def _(spark, sf):
    layout = sinks.Layout(scratch.fresh(spark, "s18"))
    claims = scratch.silver(spark, sf)["claims"]
    return sinks.write_silver(claims, layout, "claims", ["service_year_month"]).select("claim_id", "service_year_month")


@add("s19_quarantine_sink", "select claim_id, member_id, provider_id, rejection_reason from quarantine_claims")
def _(spark, sf):
    layout = sinks.Layout(scratch.fresh(spark, "s19"))
    claims = scratch.tables(spark, sf)["quarantine_claims"]
    rows = spark.read.parquet(sinks.write_quarantine(claims, layout, "claims"))
    return rows.select("claim_id", "member_id", "provider_id", "rejection_reason")


@add("s20_metrics_sink", f"select metric, value from ({_METRIC_SQL['members']}) where not contains(metric, '.')")
def _(spark, sf):
    layout = sinks.Layout(scratch.fresh(spark, "s20"))
    built = s.build_members(scratch.raw(spark, sf)["members"], AS_OF)
    latest = spark.read.json(sinks.write_metrics(built.metrics(), layout, "members"))
    return m.as_rows(latest.select(*[n for n, kind in latest.dtypes if kind == "bigint"]))


@add("s21_union_by_name", """select claim_id, rejection_reason, service_year_month from (
  select claim_id, cast(null as varchar) as rejection_reason, service_year_month from silver_claims
  union all select claim_id, rejection_reason, null from quarantine_claims)""")
def _(spark, sf):
    layout = scratch.part(spark, sf, "claims")
    rows = sinks.united(sinks.read_silver(spark, layout, "claims"), sinks.read_united(spark, layout.quarantine("claims")))
    return rows.select("claim_id", "rejection_reason", "service_year_month")


@add("s22_gold_tables", "select service_year_month, count(*) as claim_count, count(distinct provider_sk) as versions from fact_claims group by 1")
def _(spark, sf):
    """Written as a table, then asked in SQL through its view."""
    layout = sinks.Layout(scratch.fresh(spark, "s22"))
    sinks.materialise(spark, scratch.tables(spark, sf)["fact_claims"], layout, "fact_claims")
    return spark.sql("select service_year_month, count(*) as claim_count, count(distinct provider_sk) as versions from fact_claims group by 1")


_checked = [(f"{layer}/{n}", f"{layer}_{n}") for layer in ("silver", "quarantine") for n in CONTRACTS]
_checked += [(f"gold/{n}", n) for n in sinks.GOLD]


@add("s23_output_check", " union all ".join(f"select '{label}' as artifact, true as present, count(*) as row_count from {n}" for label, n in _checked)
     + "".join(f" union all select 'metrics/{n}', true, 1 union all select 'bronze/{n}', false, null" for n in CONTRACTS))
def _(spark, sf):
    """The session's lake was built straight from tables, so its Bronze is reported as absent."""
    return sinks.check_outputs(spark, scratch.lake(spark, sf), strict=False)
