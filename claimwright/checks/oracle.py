"""The same tables as DuckDB SQL, written independently of the Spark operators: windows where Spark
aggregates, count(distinct) where Spark compares min and max, lead() where Spark joins days."""

from __future__ import annotations

import re

from claimwright.checks import bronze
from claimwright.contracts import CLAIM_STATUSES, CONTRACTS, LATE_AFTER_DAYS, STATE_CODES, Kind
from claimwright.plans.gold import FACT_COLUMNS

AS_OF = "2025-01-01"


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _clean(name: str) -> str:
    blank = "nullif(trim({c}), '')"
    text = {
        Kind.RAW: "case when trim({c}) <> '' then {c} end",
        Kind.TEXT: blank,
        Kind.CODE: f"upper({blank})",
        Kind.DATE: "case when regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then try_cast({c} as date) end",
        Kind.AMOUNT: "try_cast(nullif(trim({c}), '') as decimal(12,2))",
    }
    columns = [f"{text[k].format(c=c)} as {c}" for c, k in CONTRACTS[name].columns.items()]
    return f"select {', '.join(columns)}, ingestion_timestamp, source_file, file_hash from bronze_{name}"


def _distinct(name: str) -> str:
    b = ", ".join(CONTRACTS[name].business)
    return f"""select * exclude (rn) from (
  select *, count(*) over (partition by {b}) as copies,
    row_number() over (partition by {b} order by ingestion_timestamp desc, source_file desc, file_hash desc) as rn
  from clean_{name}) where rn = 1"""


def _reasons(rules: list[tuple[str, str]]) -> str:
    whens = ", ".join(f"case when {cond} then '{name}' end" for name, cond in rules)
    return f"nullif(concat_ws('; ', {whens}), '') as rejection_reason"


def _latest(name: str) -> str:
    c = CONTRACTS[name]
    digest = "sha256(concat_ws('|', " + ", ".join(f"coalesce(cast({x} as varchar), '')" for x in c.business) + "))"
    order = ", ".join(f"{x} desc nulls last" for x in c.newest_by)
    return f"""select * exclude (rn) from (
  select *, row_number() over (partition by {', '.join(c.key)} order by {order}, {digest} desc) as rn
  from valid_{name}) where rn = 1"""


MEMBER_RULES = [
    ("missing_member_id", "member_id is null"),
    ("invalid_state_code", f"state not in ({listed(STATE_CODES)})"),
    ("impossible_date_of_birth_future", f"date_of_birth > date '{AS_OF}'"),
]
PROVIDER_RULES = [
    ("missing_provider_id", "provider_id is null"),
    ("invalid_address_state", f"address_state not in ({listed(STATE_CODES)})"),
    ("missing_effective_date", "effective_date is null"),
]
DIAGNOSIS_RULES = [
    ("missing_diagnosis_code", "diagnosis_code is null"),
    ("missing_diagnosis_description", "diagnosis_description is null"),
    ("missing_category", "category is null"),
]
CLAIM_RULES = [
    ("missing_claim_id", "claim_id is null"),
    ("invalid_or_missing_date", "service_date is null or submission_date is null"),
    ("submission_before_service_date", "submission_date < service_date"),
    ("negative_paid_amount", "paid_amount < 0"),
    ("missing_paid_amount_for_paid_claim", "claim_status = 'Paid' and paid_amount is null"),
    ("invalid_claim_status", f"claim_status not in ({listed(CLAIM_STATUSES)})"),
    ("invalid_member_id_reference", "not found_member_id"),
    ("invalid_provider_id_reference", "not found_provider_id"),
    ("invalid_diagnosis_code_reference", "not found_diagnosis_code"),
]

_TIE = ", ".join(
    f"{c} nulls first"
    for c in ("provider_name", "specialty", "npi", "network_status", "address_state", "source_system")
)

CTES: dict[str, str] = {}
for _n in CONTRACTS:
    CTES[f"bronze_{_n}"] = bronze.duckdb_text(_n)
    CTES[f"clean_{_n}"] = _clean(_n)
    CTES[f"distinct_{_n}"] = _distinct(_n)
    CTES[f"valid_{_n}"] = f"select * exclude (rejection_reason, copies) from validated_{_n} where rejection_reason is null"
    CTES[f"quarantine_{_n}"] = f"select * exclude (copies) from validated_{_n} where rejection_reason is not null"
CTES |= {
    "validated_members": f"select *, zip_code is null as has_missing_zip, {_reasons(MEMBER_RULES)} from distinct_members",
    "shared_npi": "select npi from distinct_providers group by npi having count(distinct provider_id) > 1",
    "validated_providers": f"""select p.*, specialty is null as has_missing_specialty,
  coalesce(npi in (select npi from shared_npi where npi is not null), false) as has_duplicate_npi,
  {_reasons(PROVIDER_RULES)} from distinct_providers p""",
    "validated_diagnoses": f"select *, {_reasons(DIAGNOSIS_RULES)} from distinct_diagnoses",
    "resolved_claims": """select c.*,
  exists (select 1 from silver_members m where m.member_id = c.member_id) as found_member_id,
  exists (select 1 from silver_providers p where p.provider_id = c.provider_id) as found_provider_id,
  exists (select 1 from silver_diagnoses d where d.diagnosis_code = c.diagnosis_code) as found_diagnosis_code
  from distinct_claims c""",
    "validated_claims": f"""select * exclude (found_member_id, found_provider_id, found_diagnosis_code),
  coalesce(date_diff('day', service_date, submission_date) > {LATE_AFTER_DAYS}, false) as is_late_arriving,
  cast(date_diff('day', service_date, submission_date) as integer) as days_late,
  {_reasons(CLAIM_RULES)} from resolved_claims""",
    "silver_members": _latest("members"),
    "silver_providers": "select * from valid_providers",
    "silver_diagnoses": _latest("diagnoses"),
    "latest_claims": _latest("claims"),
    "silver_claims": "select *, strftime(service_date, '%Y-%m') as service_year_month from latest_claims",
    "dim_member": """select member_id, plan_type, state, zip_code, gender, date_of_birth, has_missing_zip, source_system
  from silver_members""",
    "provider_versions": f"""select *, row_number() over (partition by provider_id order by effective_date, {_TIE}) as place
  from silver_providers""",
    "dim_provider": """select this.* exclude (place, has_missing_specialty, has_duplicate_npi, ingestion_timestamp, source_file, file_hash), this.effective_date as valid_from,
  following.effective_date as valid_to, following.effective_date is null as is_current,
  md5(this.provider_id || '|' || this.effective_date::varchar) as provider_sk
  from provider_versions this left join provider_versions following
  on following.provider_id = this.provider_id and following.place = this.place + 1""",
    "fact_claims": f"""with money as (
    select * replace (billed_amount::double as billed_amount, paid_amount::double as paid_amount),
      coalesce(lower(claim_status) = 'denied', false)::integer as is_denied from silver_claims),
  members_now as (select member_id, plan_type, state as member_state from dim_member),
  providers_now as (select provider_id, provider_sk, specialty as provider_specialty, network_status from dim_provider where is_current)
  select {', '.join(FACT_COLUMNS)} from (select *, billed_amount - paid_amount as unpaid_amount from money)
  left join members_now using (member_id) left join providers_now using (provider_id)""",
}


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in CTES if name in words]


# Bronze claims after being landed in one run: every row carries that run's time.
CLAIMS_LANDED = {
    "bronze_claims": f"""select * replace ('2024-07-01T00:00:00+00:00' as ingestion_timestamp)
  from ({bronze.duckdb_text('claims')})"""
}


def with_tables(select: str, overrides: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with the tables it names, and the ones those need, in order."""
    texts = CTES | (overrides or {})
    done: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in _needs(text):
            if name not in done:
                visit(texts[name])
                done[name] = None

    visit(select)
    if not done:
        return select
    return "with " + ",\n".join(f"{n} as materialized ({texts[n]})" for n in done) + f"\n{select}"


def portable(columns: dict[str, str]) -> str:
    """Select list in types every engine returns alike: dates as text, money as double."""
    cast = {"date": "cast({c} as varchar) as {c}", "money": "cast({c} as double) as {c}", "": "{c}"}
    return ", ".join(cast[kind].format(c=c) for c, kind in columns.items())


_KIND = {Kind.DATE: "date", Kind.AMOUNT: "money"}


def typed(name: str, *more: str) -> str:
    """Portable select list of a dataset's business columns, then ``more``."""
    columns = {c: _KIND.get(k, "") for c, k in CONTRACTS[name].columns.items()}
    return portable(columns | {c: "" for c in more})
