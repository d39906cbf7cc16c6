"""Registered queries of what the documentation describes beyond the core."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from claimwright.checks import scratch
from claimwright.checks.registry import _built, _clean, add
from claimwright.checks.source_queries import _FILES, _ingested
from claimwright.operators import alerts, changes
from claimwright.operators import metrics as m
from claimwright.plans import analytics, backfill, gold, lake
from claimwright.plans import silver as s
from claimwright.session import input_bytes, remove
from claimwright.sources import sinks
from claimwright.streaming import claims as streaming

_window = "time_bucket(interval 7 days, cast(submission_date as timestamp), timestamp '1970-01-01 00:00:00')"


@add("x01_stream_windows", f"""select cast(cast(w as date) as varchar) as window_start, count(*) as claim_count,
  count(*) filter (lower(claim_status) = 'denied') as denied_claims, cast(sum(billed_amount) as double) as billed_amount
  from (select *, {_window} as w from distinct_claims where submission_date is not null)
  where w + interval 7 days <= (select max(submission_date) from distinct_claims) - interval 45 days group by 1""")
def _(spark, sf):
    root = scratch.fresh(spark, "x01")
    scratch.raw(spark, sf)["claims"].write.parquet(f"{root}/in")
    rows = streaming.without_resends(streaming.timed(streaming.read_claims(spark, f"{root}/in"), "45 days"))
    streaming.write_windows(streaming.volume_by_window(rows, "7 days"), f"{root}/out", f"{root}/checkpoint", input_bytes(spark, f"{root}/in")).awaitTermination()
    done = spark.read.parquet(f"{root}/out")
    return done.select(F.to_date("window_start").alias("window_start"), "claim_count", "denied_claims", "billed_amount")


@add("x01_session_windows", """select * from (with e as (select member_id, submission_date as d, billed_amount, source_file = 'claims_batch_1.csv' as early
    from clean_claims where submission_date is not null),
  mark as (select max(d) filter (early) - interval 45 days as first_mark, max(d) - interval 45 days as last_mark from e),
  a as (select *, sum(opens) over (partition by member_id order by d rows unbounded preceding) as nr from (
    select *, case when d - lag(d) over (partition by member_id order by d) <= 10 then 0 else 1 end as opens from e where early)),
  a_ends as (select *, max(d) over (partition by member_id, nr) + interval 10 days as ends from a),
  b as (select *, sum(opens) over (partition by member_id order by d rows unbounded preceding) as nr from (
    select *, case when d - lag(d) over (partition by member_id order by d) <= 10 then 0 else 1 end as opens from (
      select member_id, d, billed_amount from a_ends, mark where ends > first_mark
      union all select member_id, d, billed_amount from e, mark where not early and d + interval 10 days > first_mark))),
  done as (select member_id, min(d) as s, max(d) as l, count(*) as n, sum(billed_amount) as billed from a_ends, mark where ends <= first_mark group by member_id, nr
    union all select member_id, min(d), max(d), count(*), sum(billed_amount) from b group by member_id, nr having max(d) + interval 10 days <= (select last_mark from mark))
  select member_id, cast(s as varchar) as session_start, cast(l + 10 as varchar) as session_end, n as claim_count, cast(billed as double) as billed_amount from done)""")
def _(spark, sf):
    """Two runs of one stream: the later files hold rows out of order, and some behind the watermark of the first run."""
    root = scratch.fresh(spark, "x01s")
    raw, early = scratch.raw(spark, sf)["claims"], F.col("source_file") == "claims_batch_1.csv"
    for number, part in enumerate((raw.filter(early), raw.filter(~early))):
        part.write.parquet(f"{root}/in/{number}")
        rows = streaming.timed(streaming.read_claims(spark, f"{root}/in/*"), "45 days")
        streaming.write_windows(streaming.sessions(rows, "member_id", "10 days"), f"{root}/out", f"{root}/checkpoint", input_bytes(spark, f"{root}/in")).awaitTermination()
    done = spark.read.parquet(f"{root}/out")
    return done.select("member_id", F.to_date("session_start").alias("session_start"), F.to_date("session_end").alias("session_end"),
                       "claim_count", "billed_amount")


_MERGED = "select claim_id, service_year_month, ingestion_timestamp, cast(paid_amount as double) as paid_amount from silver_claims"


def _first_silver(spark, sf, layout):
    """Silver from the first files only; returns the raw claims of the later ones and the dimensions."""
    raw, first = scratch.raw(spark, sf)["claims"], F.col("source_file") == "claims_batch_1.csv"
    dims = {d: scratch.silver(spark, sf)[d] for d in s.DIMENSIONS}
    checked = scratch.fresh(spark, "first")
    stage = lake.stage_as(spark, "claims", checked)
    lake.write_built(spark, s.build_claims(raw.filter(first), *dims.values(), stage=stage), layout)
    remove(checked)
    return raw.filter(~first), dims


def _merged(spark, layout):
    return sinks.read_silver(spark, layout, "claims").select("claim_id", "service_year_month", "ingestion_timestamp", "paid_amount")


@add("x01_stream_merge", _MERGED)
def _(spark, sf):
    """Silver from the first files, the later ones arriving as a stream."""
    layout = sinks.Layout(scratch.fresh(spark, "x01m"))
    later, dims = _first_silver(spark, sf, layout)
    later.write.parquet(f"{layout.root}/in")
    stream = streaming.read_claims(spark, f"{layout.root}/in")
    streaming.merge_into_silver(stream, layout, lambda: dims, f"{layout.root}/checkpoint").awaitTermination()
    return _merged(spark, layout)


@add("x02_high_water_increment", "select claim_id, ingestion_timestamp from clean_claims where ingestion_timestamp > (select max(ingestion_timestamp) from clean_claims where ingestion_batch_id = 'BATCH_1' and source_file = 'claims_batch_1.csv')")
def _(spark, sf):
    rows = _clean(spark, sf, "claims")
    mark = changes.high_water(rows.filter(F.col("source_file") == "claims_batch_1.csv"), "ingestion_timestamp")
    return changes.newer_than(rows, "ingestion_timestamp", mark).select("claim_id", "ingestion_timestamp")


@add("x02_stored_mark", """select * from (with e as (select claim_id, submission_date, ingestion_timestamp, source_file = 'claims_batch_1.csv' as early
    from clean_claims where submission_date is not null)
  select distinct claim_id, cast(submission_date as varchar) as submission_date, ingestion_timestamp from e
  where early or submission_date >= (select max(submission_date) from e where early) - interval 30 days)""")
def _(spark, sf):
    """The first files, then all of them: the second run starts 30 days before the stored mark and skips what is held."""
    root, rows = scratch.fresh(spark, "x02"), _clean(spark, sf, "claims").select("claim_id", "submission_date", "ingestion_timestamp", "source_file")
    content = ("claim_id", "submission_date", "ingestion_timestamp")
    load = changes.Increments(f"{root}/marks", "claims", "submission_date", content, dt.timedelta(days=30))
    load.load(rows.filter(F.col("source_file") == "claims_batch_1.csv").select(*content), f"{root}/claims")
    load.load(rows.select(*content), f"{root}/claims")
    return spark.read.parquet(f"{root}/claims").select(*content)


@add("x03_apply_changes", """with feed as (
  select c_custkey as id, c_name as name, 1 as seq, 'insert' as op from customer where c_custkey % 3 = 0
  union all select c_custkey, c_name || ' changed', 2, 'update' from customer where c_custkey % 5 = 0
  union all select c_custkey, c_name, 3, 'delete' from customer where c_custkey % 7 = 0),
  latest as (select * from feed qualify row_number() over (partition by id order by seq desc) = 1)
  select c_custkey as id, c_name as name from customer where c_custkey % 2 = 0 and c_custkey not in (select id from latest)
  union all select id, name from latest where op <> 'delete'""")
def _(spark, sf):
    base = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))

    def feed(every, name, seq, op):
        return base.filter(F.col("id") % every == 0).select("id", name, F.lit(seq).alias("seq"), F.lit(op).alias("operation"))

    changed = F.concat("name", F.lit(" changed")).alias("name")
    stream = feed(3, "name", 1, "insert").unionByName(feed(5, changed, 2, "update")).unionByName(feed(7, "name", 3, "delete"))
    return changes.apply_changes(base.filter(F.col("id") % 2 == 0), stream, ["id"], ["seq"])


@add("x04_dim_diagnosis", "select diagnosis_code, diagnosis_description, category from silver_diagnoses")
def _(spark, sf):
    return gold.dim_diagnosis(scratch.silver(spark, sf)["diagnoses"])


@add("x04_dim_date", """select cast(cast(d as date) as varchar) as date, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
  cast(quarter(d) as integer) as quarter, strftime(d, '%Y-%m') as year_month, cast(isodow(d) as integer) as iso_weekday
  from (select unnest(generate_series(cast(min(service_date) as timestamp), cast(max(service_date) as timestamp), interval 1 day)) as d from silver_claims)""")
def _(spark, sf):
    return gold.dim_date(scratch.silver(spark, sf)["claims"])




@add("x05_fact_as_of", f"""select f.* exclude (provider_sk, provider_specialty, network_status, service_date),
  cast(f.service_date as varchar) as service_date, v.provider_sk, v.specialty as provider_specialty, v.network_status
  from fact_claims f left join dim_provider v on f.provider_id = v.provider_id and f.service_date >= v.valid_from
  and (v.valid_to is null or f.service_date < v.valid_to)""")
def _(spark, sf):
    t, claims = scratch.tables(spark, sf), scratch.silver(spark, sf)["claims"]
    return gold.fact_claims_as_of(claims, t["dim_member"], t["dim_provider"])


@add("x05_order_versions_as_of", """with v as (select o_custkey, o_orderkey, cast(o_orderdate as date) as valid_from,
    cast(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as date) as valid_to from orders),
  e as (select event_id, user_id, cast(ts as date) - 9000 + cast(event_id % 9000 as int) as day from events)
  select event_id, user_id, cast(day as varchar) as day, o_orderkey from e left join v
  on user_id = o_custkey and day >= valid_from and (valid_to is null or day < valid_to)""")
def _(spark, sf):
    """Each event finds the order that was its user's latest on a day spread over many years."""
    from claimwright.operators.asof import valid_on
    from claimwright.operators.versions import with_validity

    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    versions = with_validity(orders, "o_custkey", "day", ["o_orderkey"]).select(
        F.col("o_custkey").cast("string").alias("user_key"), "o_orderkey", "valid_from", "valid_to")
    events = spark.read.parquet(f"{sf}/events.parquet")
    day = F.date_add(F.date_sub(F.to_date("ts"), 9000), (F.col("event_id") % 9000).cast("int"))
    dated = events.select("event_id", "user_id", F.col("user_id").cast("string").alias("user_key"), day.alias("day"))
    return valid_on(dated, "user_key", "day", versions, {"o_orderkey": "o_orderkey"}).drop("user_key")


@add("x06_processing_trend", "select service_year_month, count(*) as claim_count, round(cast(sum(days_late) as double) / count(days_late), 2) as avg_days from fact_claims group by 1")
def _(spark, sf):
    return analytics.processing_time_trend(scratch.tables(spark, sf))


@add("x07_approximate_counts", "select count(*) as claim_count, true as members_close, true as providers_close, true as diagnoses_close from fact_claims")
def _(spark, sf):
    """The sketch beside the exact count: within three standard errors."""
    t = scratch.tables(spark, sf)
    exact = {c: t["fact_claims"].select(c).distinct().count() for c in ("member_id", "provider_id", "diagnosis_code")}
    near = lambda c: F.abs(F.col(f"{c}s") - exact[c]) <= 0.06 * exact[c]
    return analytics.approximate_counts(t).select(
        "claim_count", near("member_id").alias("members_close"), near("provider_id").alias("providers_close"),
        near("diagnosis_code").alias("diagnoses_close"))


@add("x07_united_sketches", """select count(*) as claim_count, count(distinct member_id) as member_ids, count(distinct provider_id) as provider_ids,
  count(distinct diagnosis_code) as diagnosis_codes, true as members_near, true as providers_near, true as diagnoses_near from fact_claims""")
def _(spark, sf):
    """Sketches stored per month and united, beside exact counts of the same plan: within four standard errors."""
    fact, path = scratch.tables(spark, sf)["fact_claims"], f"{scratch.fresh(spark, 'x07')}/sketches"
    analytics.monthly_sketches(fact).write.parquet(path)
    united = analytics.united_counts(spark.read.parquet(path))
    exact = fact.agg(F.count(F.lit(1)).alias("claim_count"), *[F.count_distinct(c).alias(f"{c}_exact") for c in analytics.COUNTED])

    def near(c):
        return F.abs(F.col(f"{c}s") - F.col(f"{c}_exact")) <= 0.065 * F.col(f"{c}_exact")

    return united.join(exact, "claim_count").select(  # one row each, of equal counts
        "claim_count", *[F.col(f"{c}_exact").alias(f"{c}s") for c in analytics.COUNTED], near("member_id").alias("members_near"),
        near("provider_id").alias("providers_near"), near("diagnosis_code").alias("diagnoses_near"))


@add("x08_backfill", _MERGED)
def _(spark, sf):
    """Silver from the first files only, then the later ones merged in."""
    layout = sinks.Layout(scratch.fresh(spark, "x08"))
    later, dims = _first_silver(spark, sf, layout)
    backfill.backfill_claims(spark, layout, s.build_claims(later, *dims.values()).silver)
    return _merged(spark, layout)


@add("x09_alerts", """select 'claims' as subject, 'quarantined_count' as alert, cast(count(*) as varchar) as detail from quarantine_claims having count(*) > 0
  union all select 'claims', 'output_count', cast(count(*) as varchar) from silver_claims having count(*) > 10""")
def _(spark, sf):
    rows = m.as_rows(_built(spark, sf, "claims", staged=True).metrics())
    return alerts.metric_alerts(rows, "claims", {"quarantined_count": (0, 0), "output_count": (0, 10), "input_count": (1, 2**62)})


@add("x09_run_alerts", f"select 'claims' as subject, 'success_with_drift' as alert, count(*) as n from {_FILES} where has_drift having count(*) > 0")
def _(spark, sf):
    """Alerts per source: every file that carries the added column raises one."""
    _, log, _ = _ingested(spark, sf, "x09")
    raised = alerts.run_alerts(log.history())
    return raised.groupBy("subject", "alert").agg(F.count(F.lit(1)).alias("n"))


