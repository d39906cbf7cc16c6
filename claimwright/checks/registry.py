"""Registered queries: one per operator, over the whole test tables, with its oracle where SQL can
say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.checks import scratch
from claimwright.checks.oracle import (
    AS_OF, CLAIM_RULES, CLAIMS_LANDED, DIAGNOSIS_RULES, MEMBER_RULES, PROVIDER_RULES, portable as columns_of,
    typed, with_tables,
)
from claimwright.contracts import CLAIMS, CONTRACTS, DIAGNOSES, MEMBERS, PROVIDERS
from claimwright.functions.columns import amount, failing, strict_date, trimmed
from claimwright.operators import assertions as t
from claimwright.operators import cleaning as c
from claimwright.operators import dedup as d
from claimwright.operators import metrics as m
from claimwright.operators import validation as v
from claimwright.operators import versions
from claimwright.plans import analytics, gold, lake
from claimwright.plans import silver as s
from claimwright.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, sql: str | None, *, overrides: dict[str, str] | None = None):
    """Register a query under ``name``. Its result is made portable before it is compared."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: scratch.portable(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql, overrides)
        return fn

    return register


def _claims(spark, sf):
    return scratch.raw(spark, sf)["claims"]


def _clean(spark, sf, name):
    return c.conform(scratch.raw(spark, sf)[name], CONTRACTS[name])


def _distinct(spark, sf, name):
    return s.distinct_rows(scratch.raw(spark, sf)[name], name)


def _keys(spark, sf):
    silver = scratch.silver(spark, sf)
    return [c.key_set(silver[n], k) for n, k in zip(s.DIMENSIONS, v.CLAIM_REFERENCES)]


def _built(spark, sf, name, staged: bool = False) -> s.Built:
    raw = scratch.raw(spark, sf)[name]
    stage = lake.stage_as(spark, name, scratch.fresh(spark, "built")) if staged else s.as_is
    if name == "claims":
        return s.build_claims(raw, *[scratch.silver(spark, sf)[n] for n in s.DIMENSIONS], stage=stage)
    if name == "members":
        return s.build_members(raw, AS_OF, stage)
    return {"providers": s.build_providers, "diagnoses": s.build_diagnoses}[name](raw, stage)


# Cleaning ---------------------------------------------------------------------------------

_blank = ", ".join(f"case when trim({x}) <> '' then {x} end as {x}" for x in CLAIMS.business)


@add("c01_blank_to_null", f"select {_blank} from bronze_claims")
def _(spark, sf):
    return c.blank_to_null(_claims(spark, sf), CLAIMS.business).select(*CLAIMS.business)


@add("c02_trim_upper", "select member_id, upper(trim(state)) as state, upper(trim(gender)) as gender, upper(trim(plan_type)) as plan_type from bronze_members")
def _(spark, sf):
    codes = ["state", "gender", "plan_type"]
    return c.trim_upper(scratch.raw(spark, sf)["members"], codes).select("member_id", *codes)


@add("c03_ensure_columns", "select claim_id, cast(null as varchar) as adjustment_amount from bronze_claims")
def _(spark, sf):
    first_batch = _claims(spark, sf).drop("adjustment_amount")
    return c.ensure_columns(first_batch, ["adjustment_amount"]).select("claim_id", "adjustment_amount")


@add("c04_trim_only", "select claim_id, nullif(trim(claim_status), '') as claim_status from bronze_claims")
def _(spark, sf):
    return _claims(spark, sf).select("claim_id", trimmed("claim_status").alias("claim_status"))


@add("c05_parse_date", "select claim_id, cast(service_date as varchar) as service_date, cast(submission_date as varchar) as submission_date from clean_claims")
def _(spark, sf):
    dates = ["service_date", "submission_date"]
    return _claims(spark, sf).select("claim_id", *[strict_date(x).alias(x) for x in dates])


@add("c06_cast_money", "select claim_id, cast(billed_amount as double) as billed_amount, cast(paid_amount as double) as paid_amount, cast(adjustment_amount as double) as adjustment_amount from clean_claims")
def _(spark, sf):
    money = ["billed_amount", "paid_amount", "adjustment_amount"]
    return _claims(spark, sf).select("claim_id", *[amount(x).alias(x) for x in money])


for _id, _contract in zip(("c07", "c08", "c09", "c10"), (MEMBERS, PROVIDERS, DIAGNOSES, CLAIMS)):

    @add(f"{_id}_clean_{_contract.name}", f"select {typed(_contract.name)} from clean_{_contract.name}")
    def _(spark, sf, contract=_contract):
        return _clean(spark, sf, contract.name).select(*contract.business)


@add("c11_month_bucket", "select strftime(service_date, '%Y-%m') as service_year_month, count(*) as claim_count from clean_claims group by 1")
def _(spark, sf):
    months = c.with_service_month(_clean(spark, sf, "claims"))
    return months.groupBy("service_year_month").agg(F.count(F.lit(1)).alias("claim_count"))


@add("c12_key_projection", "select distinct member_id from clean_claims where member_id is not null")
def _(spark, sf):
    return c.key_set(_clean(spark, sf, "claims"), "member_id")


@add("c13_batch_counts", "select count(*) filter (ingestion_batch_id = 'BATCH_1') as batch_1, count(*) filter (ingestion_batch_id = 'BATCH_2') as batch_2 from clean_claims")
def _(spark, sf):
    return c.batch_counts(_clean(spark, sf, "claims"), m.BATCHES)


# Validation -------------------------------------------------------------------------------

_reason = "coalesce(rejection_reason, '') as _rejection_reasons"


@add("v01_reasons", f"select claim_id, ingestion_timestamp, {_reason} from validated_claims")
def _(spark, sf):
    rows = v.validate_claims(_distinct(spark, sf, "claims"), *_keys(spark, sf), _clean(spark, sf, "claims"))
    return rows.select("claim_id", "ingestion_timestamp", v.REASONS)


@add(
    "v02_split",
    f"""select {typed('claims')}, 'valid' as part, cast(null as varchar) as rejection_reason from valid_claims
    union all select {typed('claims')}, 'quarantine', rejection_reason from quarantine_claims""",
)
def _(spark, sf):
    valid, quarantine = v.split(v.validate_claims(_distinct(spark, sf, "claims"), *_keys(spark, sf), _clean(spark, sf, "claims")))
    parts = [
        valid.select(*CLAIMS.business, F.lit("valid").alias("part"), F.lit(None).cast("string").alias("rejection_reason")),
        quarantine.select(*CLAIMS.business, F.lit("quarantine").alias("part"), "rejection_reason"),
    ]
    return reduce(DataFrame.unionByName, parts)


@add("v03_members_rules", f"select {typed('members', 'has_missing_zip')}, {_reason} from validated_members")
def _(spark, sf):
    rows = v.validate_members(_distinct(spark, sf, "members"), AS_OF)
    return rows.select(*MEMBERS.business, "has_missing_zip", v.REASONS)


@add("v04_providers_rules", f"select {typed('providers', 'has_missing_specialty')}, {_reason} from validated_providers")
def _(spark, sf):
    rows = v.validate_providers(_distinct(spark, sf, "providers"))
    return rows.select(*PROVIDERS.business, "has_missing_specialty", v.REASONS)


@add("v05_shared_identifier", "select provider_id, npi, cast(effective_date as varchar) as effective_date, has_duplicate_npi from validated_providers")
def _(spark, sf):
    rows = v.flag_shared_identifier(_distinct(spark, sf, "providers"), "npi", "provider_id", "has_duplicate_npi")
    return rows.select("provider_id", "npi", "effective_date", "has_duplicate_npi")


@add("v06_diagnoses_rules", f"select {typed('diagnoses')}, {_reason} from validated_diagnoses")
def _(spark, sf):
    return v.validate_diagnoses(_distinct(spark, sf, "diagnoses")).select(*DIAGNOSES.business, v.REASONS)


@add("v07_referential_integrity", "select claim_id, ingestion_timestamp, found_member_id, found_provider_id, found_diagnosis_code from resolved_claims")
def _(spark, sf):
    rows = v.mark_references(_distinct(spark, sf, "claims"), dict(zip(v.CLAIM_REFERENCES, _keys(spark, sf))), _clean(spark, sf, "claims"))
    return rows.select("claim_id", "ingestion_timestamp", *[f"_found_{x}" for x in v.CLAIM_REFERENCES]).toDF(
        "claim_id", "ingestion_timestamp", "found_member_id", "found_provider_id", "found_diagnosis_code"
    )


_field_rules = ", ".join(f"case when {cond} then '{name}' end" for name, cond in CLAIM_RULES if not name.endswith("reference"))


@add("v08_claims_field_rules", f"select claim_id, ingestion_timestamp, concat_ws('; ', {_field_rules}) as reasons from distinct_claims")
def _(spark, sf):
    return _distinct(spark, sf, "claims").select(
        "claim_id", "ingestion_timestamp", failing(v.claim_field_rules()).alias("reasons")
    )


_lag = "cast(service_date as varchar) as service_date, cast(submission_date as varchar) as submission_date"


@add("v09_late_arriving", f"select claim_id, {_lag}, is_late_arriving from validated_claims")
def _(spark, sf):
    rows = v.with_lateness(_distinct(spark, sf, "claims"))
    return rows.select("claim_id", "service_date", "submission_date", "is_late_arriving")


@add("v10_days_late", f"select claim_id, {_lag}, days_late from validated_claims")
def _(spark, sf):
    rows = v.with_lateness(_distinct(spark, sf, "claims"))
    return rows.select("claim_id", "service_date", "submission_date", "days_late")


# Deduplication ----------------------------------------------------------------------------


@add("d01_exact_duplicates", f"select {typed('claims', 'ingestion_timestamp', 'source_file')}, copies from distinct_claims")
def _(spark, sf):
    rows = _distinct(spark, sf, "claims").withColumnRenamed(d.COPIES, "copies")
    return rows.select(*CLAIMS.business, "ingestion_timestamp", "source_file", "copies")


@add("d02_survivor_per_key", f"select {typed('claims', 'ingestion_timestamp')} from latest_claims")
def _(spark, sf):
    valid = v.split(v.validate_claims(_distinct(spark, sf, "claims"), *_keys(spark, sf), _clean(spark, sf, "claims"))).valid
    rows = d.latest_per_key(valid, CLAIMS.key, CLAIMS.newest_by, CLAIMS.business)
    return rows.select(*CLAIMS.business, "ingestion_timestamp")


@add("d03_keys_with_history", "select provider_id, count(*) as row_count from distinct_providers group by 1 having count(*) > 1")
def _(spark, sf):
    return d.keys_with_history(_distinct(spark, sf, "providers"), ["provider_id"])


# Builders and metrics ---------------------------------------------------------------------

_EXTRA = {
    "members": ["has_missing_zip"],
    "providers": ["has_missing_specialty", "has_duplicate_npi"],
    "diagnoses": [],
    "claims": ["is_late_arriving", "days_late", "service_year_month"],
}

for _i, _n in enumerate(("members", "providers", "diagnoses", "claims"), start=1):

    @add(f"b0{_i}_build_{_n}", f"select {typed(_n, *_EXTRA[_n], 'ingestion_timestamp')} from silver_{_n}")
    def _(spark, sf, name=_n):
        return _built(spark, sf, name).silver.select(*CONTRACTS[name].business, *_EXTRA[name], "ingestion_timestamp")


@add("b05_silver_run", "select service_year_month, count(*) as claim_count, cast(0 as bigint) as dimension_files from silver_claims group by 1")
def _(spark, sf):
    """Only claims are asked for, so the dimensions are built but not written."""
    layout = sinks.Layout(scratch.fresh(spark, "b05"))
    lake.write_layers(spark, scratch.raw(spark, sf), layout, datasets=["claims"], as_of=AS_OF)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{layout.root}/silver").select("path")
    written = listed.filter(~F.col("path").contains("/silver/claims/")).count()
    claims = sinks.read_silver(spark, layout, "claims")
    counted = claims.groupBy("service_year_month").agg(F.count(F.lit(1)).alias("claim_count"))
    return counted.withColumn("dimension_files", F.lit(written).cast("bigint"))


_artifact_rows = [(f"{layer}/{n}", f"{layer}_{n}") for layer in ("bronze", "silver", "quarantine") for n in CONTRACTS]
_artifact_rows += [(f"gold/{n}", n) for n in sinks.GOLD]
_artifacts = " union all ".join(f"select '{label}' as artifact, true as present, count(*) as row_count from {n}" for label, n in _artifact_rows)
_artifacts += "".join(f" union all select 'metrics/{n}', true, 1" for n in CONTRACTS)


def _end_to_end(spark, sf) -> sinks.Layout:
    layout = sinks.Layout(scratch.fresh(spark, "lake-run"))
    declared = scratch.sources(spark, sf, f"{layout.root}/bronze")
    lake.run_lake(spark, declared, layout, f"{layout.root}/log", as_of=AS_OF, at=scratch.AT)
    return layout


@add("b06_end_to_end", _artifacts, overrides=CLAIMS_LANDED)
def _(spark, sf):
    return sinks.check_outputs(spark, _end_to_end(spark, sf))


def _each_rule(name: str, rules) -> str:
    return " union all ".join(
        f"select '{rule}' as reason, count(*) filter (contains('; ' || rejection_reason || '; ', '; {rule}; ')) as n from quarantine_{name}"
        for rule, _ in rules
    )


@add("m01_reason_breakdown", f"select reason, n as rows from ({_each_rule('claims', CLAIM_RULES)}) where n > 0")
def _(spark, sf):
    return m.reason_breakdown(v.validate_claims(_distinct(spark, sf, "claims"), *_keys(spark, sf), _clean(spark, sf, "claims")))


@add("m02_null_counts", "select count(*) filter (date_of_birth is null) as date_of_birth, count(*) filter (state is null) as state, count(*) filter (zip_code is null) as zip_code from silver_members")
def _(spark, sf):
    return m.null_counts(scratch.silver(spark, sf)["members"], ["date_of_birth", "state", "zip_code"])


def _metric_sql(name: str, rules, more: dict[str, str], key_dups: bool = True) -> str:
    counts = {
        "input_count": f"(select count(*) from bronze_{name})",
        "output_count": f"(select count(*) from silver_{name})",
        "exact_duplicate_rows_removed": f"(select count(*) from bronze_{name}) - (select count(*) from distinct_{name})",
        "quarantined_count": f"(select count(*) from quarantine_{name})",
    }
    if key_dups:
        counts["business_key_duplicates_removed"] = f"(select count(*) from valid_{name}) - (select count(*) from silver_{name})"
    parts = [f"select '{k}' as metric, cast({x} as bigint) as value" for k, x in (counts | more).items()]
    parts.append(f"select '{m.BREAKDOWN}.' || reason, n from ({_each_rule(name, rules)}) where n > 0")
    return " union all ".join(parts)


def _where(name: str, cond: str) -> str:
    return f"(select count(*) from {name} where {cond})"


_METRIC_SQL = {
    "members": _metric_sql("members", MEMBER_RULES, {
        "missing_zip_flag_count": _where("silver_members", "has_missing_zip"),
        **{f"null_counts.{x}": _where("silver_members", f"{x} is null") for x in ("date_of_birth", "state", "zip_code")},
    }),
    "providers": _metric_sql("providers", PROVIDER_RULES, {
        "providers_with_historical_versions_preserved":
            "(select count(*) from (select provider_id from distinct_providers group by 1 having count(*) > 1))",
        "duplicate_npi_flag_count": _where("silver_providers", "has_duplicate_npi"),
        "missing_specialty_flag_count": _where("silver_providers", "has_missing_specialty"),
    }, key_dups=False),
    "diagnoses": _metric_sql("diagnoses", DIAGNOSIS_RULES, {}),
    "claims": _metric_sql("claims", CLAIM_RULES, {
        "batch_1_input_rows": _where("clean_claims", "ingestion_batch_id = 'BATCH_1'"),
        "batch_2_input_rows": _where("clean_claims", "ingestion_batch_id = 'BATCH_2'"),
        **{f"{m.RI}.{r}": _where("quarantine_claims", f"contains(rejection_reason, '{r}')") for r in v.CLAIM_REFERENCES.values()},
        "negative_paid_amount_count": _where("quarantine_claims", "contains(rejection_reason, 'negative_paid_amount')"),
        "missing_paid_amount_for_paid_claim_count": _where("quarantine_claims", "contains(rejection_reason, 'missing_paid_amount_for_paid_claim')"),
        "late_arriving_count": _where("silver_claims", "is_late_arriving"),
        "adjustment_amount_present_count": _where("silver_claims", "adjustment_amount is not null"),
    }),
}

for _i, _n in enumerate(("members", "providers", "diagnoses", "claims"), start=3):

    @add(f"m0{_i}_{_n}_metrics", _METRIC_SQL[_n])
    def _(spark, sf, name=_n):
        return m.as_rows(_built(spark, sf, name, staged=True).metrics())


# Gold and table tests ---------------------------------------------------------------------

_DIM_MEMBER = columns_of({x: "date" if x == "date_of_birth" else "" for x in gold.MEMBER_COLUMNS})
_PROVIDER = [
    "provider_sk", "provider_id", "provider_name", "specialty", "npi", "network_status", "address_state",
    "effective_date", "valid_from", "valid_to", "is_current",
]
_DIM_PROVIDER = columns_of({x: "date" if x in ("effective_date", "valid_from", "valid_to") else "" for x in _PROVIDER})
_FACT = columns_of({x: "date" if x == "service_date" else "" for x in gold.FACT_COLUMNS})


@add("g01_dim_member", f"select {_DIM_MEMBER} from dim_member")
def _(spark, sf):
    return gold.dim_member(scratch.silver(spark, sf)["members"])


@add("g02_scd2_versions", f"select {_DIM_PROVIDER} from dim_provider")
def _(spark, sf):
    return gold.dim_provider(scratch.silver(spark, sf)["providers"])


@add(
    "g02_scd2_same_day_ties",
    """select o_custkey, o_orderkey, cast(o_orderdate as date)::varchar as valid_from, cast(n as date)::varchar as valid_to,
  n is null as is_current
  from (select *, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders)""",
)
def _(spark, sf):
    """Orders as versions of their customer: many share a day."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    dated = orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    rows = versions.with_validity(dated, "o_custkey", "day", ["o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "valid_from", "valid_to", "is_current")


@add("g02_same_day_report", "select o_custkey, cast(cast(o_orderdate as date) as varchar) as day, count(*) as version_count from orders group by 1, 2 having count(*) > 1")
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return versions.same_day_versions(orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day")), "o_custkey", "day")


@add("g03_surrogate_key", "select provider_id, cast(effective_date as varchar) as effective_date, md5(provider_id || '|' || cast(effective_date as varchar)) as provider_sk from clean_providers")
def _(spark, sf):
    rows = _clean(spark, sf, "providers")
    return rows.select("provider_id", "effective_date", versions.surrogate_key("provider_id", "effective_date").alias("provider_sk"))


@add("g04_current_versions", f"select {_DIM_PROVIDER} from dim_provider where is_current")
def _(spark, sf):
    return gold.current(scratch.tables(spark, sf)["dim_provider"])


@add("g05_fact_claims", f"select {_FACT} from fact_claims")
def _(spark, sf):
    tables = scratch.tables(spark, sf)
    return gold.fact_claims(scratch.silver(spark, sf)["claims"], tables["dim_member"], tables["dim_provider"])


@add("g06_measures", "select claim_id, billed_amount, paid_amount, unpaid_amount, is_denied from fact_claims")
def _(spark, sf):
    rows = gold.with_measures(scratch.silver(spark, sf)["claims"])
    return rows.select("claim_id", "billed_amount", "paid_amount", "unpaid_amount", "is_denied")


def _test_sql(kind: str, count: Callable[[str, str], str], on: list[tuple[str, str]]) -> str:
    return " union all ".join(
        f"select '{tbl}' as table_name, '{col}' as column_name, '{kind}' as test, ({count(tbl, col)}) as violations" for tbl, col in on
    )


_TESTS = {
    "t01_not_null": ("not_null", _test_sql("not_null", lambda tb, x: f"select count(*) from {tb} where {x} is null", [
        ("dim_member", "member_id"), ("dim_provider", "provider_sk"), ("dim_provider", "provider_id"),
        ("dim_provider", "is_current"), ("fact_claims", "claim_id"), ("fact_claims", "member_id")])),
    "t02_unique": ("unique", _test_sql("unique",
        lambda tb, x: f"select count(*) from (select {x} from {tb} where {x} is not null group by 1 having count(*) > 1)",
        [("dim_member", "member_id"), ("dim_provider", "provider_sk"), ("fact_claims", "claim_id")])),
    "t03_relationships": ("relationships", _test_sql("relationships",
        lambda tb, x: f"select count(distinct {x}) from {tb} where {x} not in (select member_id from dim_member)",
        [("fact_claims", "member_id")])),
    "t04_accepted_values": ("accepted_values", _test_sql("accepted_values",
        lambda tb, x: f"select count(distinct {x}) from {tb} where {x} not in (0, 1)", [("fact_claims", "is_denied")])),
}

for _name, (_kind, _sql) in _TESTS.items():

    @add(_name, _sql)
    def _(spark, sf, kind=_kind):
        return t.violation_counts([x for x in t.gold_tests(scratch.tables(spark, sf)) if x.test == kind])


# The same tests where they do find something: raw claims before any cleaning.
@add("t01_not_null_violations", "select claim_id, denial_reason from clean_claims where denial_reason is null")
def _(spark, sf):
    return t.not_null(_clean(spark, sf, "claims"), "denial_reason").select("claim_id", "denial_reason")


@add("t02_unique_violations", "select claim_id, count(*) as row_count from bronze_claims group by 1 having count(*) > 1")
def _(spark, sf):
    return t.unique(_claims(spark, sf), "claim_id")


@add("t03_orphans", "select member_id, count(*) as row_count from clean_claims where member_id is not null and member_id not in (select member_id from silver_members) group by 1")
def _(spark, sf):
    return t.relationships(_clean(spark, sf, "claims"), "member_id", scratch.silver(spark, sf)["members"], "member_id")


@add("t04_unexpected_values", "select claim_status, count(*) as row_count from clean_claims where claim_status not in ('Paid', 'Denied', 'Pending') group by 1")
def _(spark, sf):
    return t.accepted_values(_clean(spark, sf, "claims"), "claim_status", ["Paid", "Denied", "Pending"])


# Analytics --------------------------------------------------------------------------------


def _sum(x: str) -> str:
    return f"round(cast(sum(cast({x} as decimal(18,2))) as double), 2)"


def _avg(x: str) -> str:
    return f"round(cast(sum(cast({x} as decimal(18,2))) as double) / count({x}), 2)"


def _pct(part: str, whole: str) -> str:
    return f"round(100.0 * cast({part} as double) / nullif({whole}, 0), 2)"


_by = lambda key, *more: f"select {key}, count(*) as claim_count{''.join(', ' + x for x in more)} from fact_claims group by {key}"
_denied = "cast(sum(is_denied) as bigint) as denied_claims"
_paid = f"{_sum('paid_amount')} as total_paid"
_missing = "count(*) filter (specialty is null or trim(specialty) = '')"

ANALYTICS_SQL = {
    "q01_total_claims": "select count(*) as total_claims from fact_claims",
    "q02_paid_claims": "select count(*) as paid_claims from fact_claims where lower(claim_status) = 'paid'",
    "q03_denied_claims": f"select {_denied} from fact_claims",
    "q04_denial_pct": f"select {_denied}, count(*) as total_claims, {_pct('sum(is_denied)', 'count(*)')} as denial_pct from fact_claims",
    "q05_claims_by_month": _by("service_year_month", _denied),
    "q06_claims_by_state": _by("member_state", _denied),
    "q07_claims_by_diagnosis": _by("diagnosis_code"),
    "q08_claims_by_provider": _by("provider_id"),
    "q09_claims_by_specialty": f"select coalesce(provider_specialty, '(unknown)') as provider_specialty, claim_count from ({_by('provider_specialty')})",
    "q10_top_providers_by_volume": """select f.provider_id, dp.provider_name, count(*) as claim_count from fact_claims f
  left join dim_provider dp on f.provider_id = dp.provider_id and dp.is_current group by 1, 2
  order by claim_count desc, f.provider_id limit 10""",
    "q11_total_billed": f"select {_sum('billed_amount')} as total_billed_amount from fact_claims",
    "q12_total_paid": f"select {_sum('paid_amount')} as total_paid_amount from fact_claims",
    "q13_billed_not_paid": f"select {_sum('unpaid_amount')} as total_adjustments_billed_not_paid from fact_claims",
    "q14_avg_paid": f"select {_avg('paid_amount')} as avg_paid_amount from fact_claims",
    "q15_avg_billed": f"select {_avg('billed_amount')} as avg_billed_amount from fact_claims",
    "q16_paid_by_month": f"select service_year_month, {_paid} from fact_claims group by 1",
    "q17_billed_by_month": f"select service_year_month, {_sum('billed_amount')} as total_billed from fact_claims group by 1",
    "q18_paid_by_diagnosis": _by("diagnosis_code", _paid),
    "q19_paid_by_provider": _by("provider_id", _paid),
    "q20_top_diagnoses_by_avg_paid": _by("diagnosis_code", f"{_avg('paid_amount')} as avg_paid")
    + " having count(*) >= 1 order by avg_paid desc nulls last, diagnosis_code limit 10",
    "q21_members_by_state": "select state, count(*) as members from dim_member group by 1",
    "q22_claims_per_member": _by("member_id"),
    "q23_top_members_by_paid": _by("member_id", _paid) + " order by total_paid desc nulls last, member_id limit 20",
    "q24_members_by_age_band": f"""select case when date_of_birth is null then 'unknown' else lo || '-' || (lo + 9) end as age_band,
  count(*) as members
  from (select *, (date_diff('year', date_of_birth, date '{AS_OF}') // 10) * 10 as lo from dim_member) group by 1""",
    "q25_claims_per_distinct_member": "select round(cast(count(*) as double) / count(distinct member_id), 2) as avg_claims_per_member from fact_claims",
    "q26_providers_by_specialty": """select coalesce(specialty, '(unknown)') as specialty, provider_count from
  (select specialty, count(*) as provider_count from dim_provider where is_current group by 1)""",
    "q27_providers_by_network": "select network_status, count(*) as provider_count from dim_provider where is_current group by 1",
    "q28_active_providers": "select count(distinct provider_id) as active_providers from dim_provider where is_current",
    "q29_provider_history": """select provider_id, provider_name, network_status, cast(valid_from as varchar) as valid_from,
  cast(valid_to as varchar) as valid_to, is_current from dim_provider
  where provider_id in (select provider_id from dim_provider group by 1 having count(*) > 1)""",
    "q29b_versions_per_provider": "select provider_id, count(*) as version_count from dim_provider group by 1",
    "q30_volume_by_specialty": f"select coalesce(provider_specialty, '(unknown)') as specialty, claim_count, total_paid from ({_by('provider_specialty', _paid)})",
    "q31_quarantine_reasons": "select rejection_reason, count(*) as quarantined_records from quarantine_claims group by 1",
    "q32_quarantine_volume": " union all ".join(
        f"select '{n}' as dataset, count(*) as quarantined_records from quarantine_{n}" for n in CONTRACTS),
    "q33_late_claims": f"""select count(*) filter (is_late_arriving) as late_claims, count(*) as total_claims,
  {_pct('count(*) filter (is_late_arriving)', 'count(*)')} as late_pct,
  round(cast(sum(days_late) filter (is_late_arriving) as double) / count(days_late) filter (is_late_arriving), 1) as avg_days_late,
  max(days_late) as max_days_late from fact_claims""",
    "q34_shared_npis": """select npi, count(distinct provider_id) as distinct_providers from dim_provider where npi is not null
  group by 1 having count(distinct provider_id) > 1""",
    "q35_missing_specialty": f"""select {_missing} as missing_specialty, count(*) as current_providers,
  {_pct(_missing, 'count(*)')} as missing_specialty_pct from dim_provider where is_current""",
}


def _analytic(name: str, spark: SparkSession, sf: str) -> DataFrame:
    fn, tables = analytics.REGISTRY[name], scratch.tables(spark, sf)
    return fn(tables, as_of=AS_OF) if fn is analytics.members_by_age_band else fn(tables)


for _name, _sql in ANALYTICS_SQL.items():
    add(_name, _sql)(partial(_analytic, _name))


@add("q00_run_all", " union all ".join(f"select '{n}' as query, count(*) as row_count from ({q})" for n, q in ANALYTICS_SQL.items()))
def _(spark, sf):
    results = analytics.run_all(scratch.tables(spark, sf), AS_OF)
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("query"), "row_count") for n, df in results.items()]
    return reduce(DataFrame.unionByName, counts)
