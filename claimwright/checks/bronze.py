"""Bronze tables derived from the test tables, as SQL text that Spark and DuckDB both accept.

Each covers its whole input table. Blanks, malformed values, unknown keys, copies, later
corrections and shared identifiers are injected by arithmetic on the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from claimwright.contracts import STATE_CODES

TABLES = ["customer", "supplier", "part", "orders", "lineitem"]

def _state(nation: str) -> str:
    """Every nation gets a state of its own: each second one of the public list."""
    return f"lower(split_part('{' '.join(STATE_CODES)}', ' ', cast({nation} * 2 + 1 as int)))"


# orders grows with lineitem, so the hint (a comment to DuckDB) asks for the join it needs at scale.
_CLAIM_ROWS = """
select /*+ MERGE(o) */
  'C'||l_orderkey||'-'||l_linenumber as claim_id,
  case when l_suppkey%97=0 then 'M999999999' else 'M'||o_custkey end as member_id,
  'P'||l_suppkey as provider_id,
  case when l_partkey%50=0 then 'no such code' else ' '||lower(p_brand) end as diagnosis_code,
  cast(cast(o_orderdate as date) as string) as service_date,
  case when l_partkey%211=0 then '' when l_partkey%307=0 then 'not-a-date'
       else cast(cast(o_orderdate as date)+(cast(l_quantity as int)-3) as string) end as submission_date,
  cast(cast(l_extendedprice as decimal(12,2)) as string) as billed_amount,
  case when l_returnflag='N' then '' when l_returnflag='R' then '0'
       when l_partkey%33=0 then ' ' when l_partkey%100=1 then '-5.00'
       else cast(cast(cast(l_extendedprice as decimal(12,2))*cast(1-l_discount as decimal(4,2)) as decimal(12,2)) as string)
  end as paid_amount,
  case when l_partkey%301=0 then 'Void' when l_returnflag='A' then 'Paid '
       when l_returnflag='R' then 'Denied' else 'Pending' end as claim_status,
  case when l_returnflag='R' then 'paid before' else '' end as denial_reason,
  case when l_suppkey%10=0 then 'BATCH_2' else 'BATCH_1' end as ingestion_batch_id,
  'billing' as source_system,
  case when l_suppkey%10=0 and l_tax>0.06 then cast(cast(l_tax*1000 as decimal(12,2)) as string) else '' end
    as adjustment_amount,
  case when l_suppkey%10=0 then '2024-05-01T00:00:00+00:00' else '2024-01-01T00:00:00+00:00' end
    as ingestion_timestamp,
  case when l_suppkey%10=0 then 'claims_batch_2.csv' else 'claims_batch_1.csv' end as source_file,
  l_orderkey
from {lineitem} join {orders} o on l_orderkey=o_orderkey join {part} on l_partkey=p_partkey
"""

_CLAIM_COLUMNS = """claim_id, member_id, provider_id, diagnosis_code, service_date, submission_date, billed_amount,
  paid_amount, claim_status, denial_reason, ingestion_batch_id, source_system, adjustment_amount"""

_MEMBER_ROWS = f"""
select c_custkey,
  'M'||c_custkey as member_id, c_name as first_name, 'Fam'||c_nationkey as last_name,
  case when c_custkey%200=7 then '2999-01-01' when c_custkey%150=9 then ''
       else cast(date '1935-01-01'+cast(c_custkey*37%29000 as int) as string) end as date_of_birth,
  case when c_custkey%3=0 then ' f' when c_custkey%3=1 then 'M' else 'u ' end as gender,
  date '2019-01-01'+cast(c_custkey%2300 as int) as es,
  case when c_custkey%7=0 then '' else cast(date '2019-01-01'+cast(c_custkey%2300 as int)+365 as string) end
    as enrollment_end_date,
  lower(substr(c_mktsegment,1,3)) as plan_type,
  case when c_custkey%50=3 then 'ZZ' else ' '||{_state('c_nationkey')} end as state,
  case when c_custkey%33=0 then '' else cast(10000+c_custkey as string) end as zip_code
from {{customer}}
"""

_PROVIDER_ROWS = f"""
select s_suppkey, 'P'||s_suppkey as provider_id, s_name as provider_name,
  case when s_suppkey%49=5 then '' when s_suppkey%4=0 then 'Hearts' when s_suppkey%4=1 then ' Nerves'
       when s_suppkey%4=2 then 'Imaging' else 'Minds' end as specialty,
  case when s_suppkey%25=1 then cast(1000000000+s_suppkey-1 as string) else cast(1000000000+s_suppkey as string) end
    as npi,
  case when s_suppkey%60=8 then 'XX' else {_state('s_nationkey')} end
    as address_state,
  case when s_suppkey%40=13 then '' else cast(date '2018-01-01'+cast(s_suppkey%1800 as int) as string) end
    as effective_date
from {{supplier}}
"""


def _provenance(timestamp: str, file: str) -> str:
    """Constant provenance of one landed file; the digest of its name stands for its hash."""
    return f"'{timestamp}' as ingestion_timestamp, '{file}' as source_file, md5('{file}') as file_hash"


def _member(timestamp: str, start: str, end: str, where: str, file: str) -> str:
    return f"""select member_id, first_name, last_name, date_of_birth, gender,
  cast({start} as string) as enrollment_start_date, {end} as enrollment_end_date, plan_type, state, zip_code,
  'registry' as source_system, {_provenance(timestamp, file)}
  from ({_MEMBER_ROWS}) m where {where}"""


def _provider(status: str, effective: str, where: str) -> str:
    return f"""select provider_id, provider_name, specialty, npi, '{status}' as network_status, address_state,
  {effective} as effective_date, 'directory' as source_system,
  {_provenance('2024-01-01T00:00:00+00:00', 'providers.csv')}
  from ({_PROVIDER_ROWS}) p where {where}"""


_LATER = "cast(date '2023-02-01'+cast(s_suppkey%1000 as int) as string)"

SQL = {
    "claims": f"""
select {_CLAIM_COLUMNS}, ingestion_timestamp, source_file, md5(source_file) as file_hash from ({_CLAIM_ROWS}) a
union all
select {_CLAIM_COLUMNS}, {_provenance('2024-06-01T00:00:00+00:00', 'claims_resend.csv')}
from ({_CLAIM_ROWS}) b where l_orderkey%67=0""",
    "members": "\nunion all\n".join(
        [
            _member("2024-01-01T00:00:00+00:00", "es", "enrollment_end_date", "true", "members.csv"),
            _member("2024-02-01T00:00:00+00:00", "es", "enrollment_end_date", "c_custkey%100=0", "members_resend.csv"),
            _member("2024-01-01T00:00:00+00:00", "es+400", "''", "c_custkey%90=1", "members.csv"),
        ]
    ),
    "providers": "\nunion all\n".join(
        [
            _provider("In-Network", "effective_date", "true"),
            _provider("In-Network", "effective_date", "s_suppkey%20=0"),
            _provider("Out-of-Network", _LATER, "s_suppkey%10=0"),
        ]
    ),
    "diagnoses": f"""
select p_brand as diagnosis_code, min(p_name) as diagnosis_description,
  case when p_brand='Brand#25' then '' else min(p_type) end as category,
  {_provenance('2024-01-01T00:00:00+00:00', 'diagnoses.csv')}
from {{part}} group by p_brand""",
}


class Lazy(Mapping):
    """Tables by name, each opened when it is first asked for."""

    def __init__(self, names: Iterable[str], open_table: Callable[[str], DataFrame]) -> None:
        self._names, self._open, self._opened = list(names), open_table, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def bronze(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The four Bronze tables, lazily. Tables are passed to each query, not registered as views."""

    def open_table(name: str) -> DataFrame:
        used = [t for t in TABLES if f"{{{t}}}" in SQL[name]]
        return spark.sql(SQL[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})

    return Lazy(SQL, open_table)


def duckdb_text(name: str) -> str:
    return SQL[name].format(**{t: t for t in TABLES})
