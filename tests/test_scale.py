"""Plans and skew: what has to hold when the data is a million times larger."""

import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimwright.contracts import CLAIMS
from claimwright.operators import dedup as d, lookup
from claimwright.operators import validation as v
from claimwright.plans import analytics, lake, silver as s
from claimwright.session import TASK_BYTES, shared_dir, shuffles_sized_for, small_tasks
from claimwright.sources import bronze, sinks
from rows import frame


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def claims(spark):
    return frame(spark, "claims", {}, {"claim_id": "C2"})


@pytest.fixture
def small_broadcast(spark):
    """No side is small enough to broadcast, as at full scale."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def keys(spark):
    return [spark.createDataFrame([(k,)], "k string") for k in ("M1", "P1", "E11")]


def test_rows_are_reduced_before_each_shuffle(spark):
    copies = plan(d.collapse_copies(claims(spark), CLAIMS.business))
    assert len(re.findall("partial_max|partial_count", copies)) >= 2
    latest = plan(d.latest_per_key(claims(spark), ["claim_id"], ["ingestion_timestamp"], CLAIMS.business))
    below = latest[latest.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_nothing_is_broadcast_when_sides_are_large(spark, small_broadcast, monkeypatch):
    """Beyond their bounds neither the files' ranks nor the unresolved keys are broadcast."""
    monkeypatch.setattr(d.ranked_origins, "__defaults__", (0,))
    monkeypatch.setattr(lookup.unresolved_keys, "__defaults__", (-1,))
    rows = v.validate_claims(s.distinct_rows(claims(spark), "claims"), *keys(spark))
    text = plan(rows)
    assert "Broadcast" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert text.count("SortMergeJoin") == 4
    assert rows.count() == 2


def wide_shuffles(text):
    """Shuffles by key of rows that carry the amounts, as the narrow rows of a lookup do not."""
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_copies_are_hashed_not_sorted(spark):
    """With the files' ranks the aggregate's buffer is two numbers."""
    raw = {n: frame(spark, n, {}) for n in s.ALL}
    built = s.build_all(raw, "2025-01-01")
    for name in ("members", "diagnoses"):
        assert "SortAggregate" not in plan(built[name].silver) and "partial_max(_origin" in plan(built[name].silver)
    assert "SortAggregate" not in plan(s.distinct_rows(raw["claims"], "claims"))


def test_wide_claims_move_twice(spark, small_broadcast):
    """Once to take out copies, once for the survivor of each key; the three key checks move distinct keys only."""
    raw = {n: frame(spark, n, {}) for n in s.ALL}
    dims = [s.build_members(raw["members"], "2025-01-01").silver, s.build_providers(raw["providers"]).silver, s.build_diagnoses(raw["diagnoses"]).silver]
    built = s.build_claims(raw["claims"], *dims)
    assert len(wide_shuffles(plan(built.silver))) == 2
    assert "SortMergeJoin" not in plan(built.silver) and built.silver.count() == 1


def test_no_python_in_any_silver_or_gold_plan(spark):
    raw = {n: frame(spark, n, {}) for n in s.ALL}
    built = s.build_all(raw, "2025-01-01")
    for b in built.values():
        assert not re.search("Python|Pandas|Arrow", plan(b.silver).replace("ExistingRDD", ""))


def test_queries_read_only_their_columns(spark, tmp_path):
    layout = sinks.Layout(str(tmp_path))
    raw = {n: frame(spark, n, {}) for n in s.ALL}
    lake.write_layers(spark, raw, layout, as_of="2025-01-01")
    tables = lake.run_gold(spark, layout, views=False)
    text = plan(analytics.paid_by_month(tables))
    assert re.search(r"ReadSchema: struct<service_year_month:string,paid_amount:double>", text)
    paid = plan(analytics.paid_claims(tables))
    assert "ReadSchema: struct<claim_status:string>" in paid
    one_month = sinks.read_silver(spark, layout, "claims").filter("service_year_month = '2024-01'")
    assert re.search(r"PartitionFilters: \[[^\]]*service_year_month", plan(one_month))


def test_newest_snapshot_prunes_older_days(spark, tmp_path):
    for at in ("2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00"):
        bronze.write_bronze(frame(spark, "members", {"ingestion_timestamp": at}), str(tmp_path))
    df = bronze.read_full(spark, str(tmp_path), s.MEMBERS.bronze_schema)
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date[^\]]*2024-01-02", plan(df))
    assert [r.bronze_ingestion_date for r in df.collect()] == ["2024-01-02"]


def test_shuffles_follow_the_input_size(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with shuffles_sized_for(spark, 100 * 2**40) as n:
        assert n == 819_200 and spark.conf.get(key) == "819200"
    with shuffles_sized_for(spark, 10) as n:
        assert n == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(key, None) == before


def test_tasks_read_little(spark):
    before = {key: spark.conf.get(key) for key in TASK_BYTES}
    first, second = TASK_BYTES
    try:
        spark.conf.set(first, "128MB")
        spark.conf.set(second, "16k")
        lake.stage_as(spark, "claims", "unused")
        assert (spark.conf.get(first), spark.conf.get(second)) == (str(TASK_BYTES[first]), "16k")
        spark.conf.set(second, "67108864b")
        small_tasks(spark)
        assert spark.conf.get(second) == str(TASK_BYTES[second])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_tasks_share_of_a_shuffle_does_not_grow(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k, None) for k in (key, *TASK_BYTES)}
    try:
        small_tasks(spark, 2**20)
        assert spark.conf.get(key, None) == before[key]
        small_tasks(spark, 6 * 2**30)
        assert int(spark.conf.get(key)) == 768  # 8 MB of Parquet each
        small_tasks(spark, 2**30)
        with shuffles_sized_for(spark, 10) as n:
            assert n == 768  # never fewer than the session has
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_a_part_of_the_lake_is_made_without_the_others(spark, monkeypatch):
    from claimwright.checks import scratch

    monkeypatch.setattr(scratch, "_fingerprint", lambda *_: ("parts",))
    opened = []

    def raw(spark, sf):
        return scratch.Lazy(s.ALL, lambda n: opened.append(n) or frame(spark, n, {}))

    monkeypatch.setattr(scratch, "raw", raw)
    assert scratch.silver(spark, "own")["providers"].count() == 1 and scratch.tables(spark, "own")["dim_provider"].count() == 1
    assert opened == ["providers"]
    assert scratch.tables(spark, "own")["fact_claims"].first().plan_type == "POS"
    assert sorted(opened) == sorted(s.ALL)
    rows = {r.artifact: r.row_count for r in sinks.check_outputs(spark, scratch.lake(spark, "own"), strict=False).collect()}
    assert rows["gold/dim_member"] == 1 and rows["quarantine/claims"] == 0 and sorted(opened) == sorted(s.ALL)


def test_the_united_claims_need_no_gold(spark, monkeypatch):
    from claimwright.checks import registry, scratch, source_queries  # noqa: F401

    made = []
    monkeypatch.setattr(scratch, "_fingerprint", lambda *_: ("united",))
    monkeypatch.setattr(scratch, "raw", lambda spark, sf: scratch.Lazy(s.ALL, lambda n: frame(spark, n, {})))
    monkeypatch.setattr(scratch, "run_gold", lambda *a, **kw: made.append(kw))
    assert [r.claim_id for r in registry.QUERIES["s21_union_by_name"](spark, "own").collect()] == ["C1"] and not made


def test_shuffles_go_when_their_query_ends(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))

    small_tasks(spark)
    before = held()
    for i in range(3):
        spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().write.parquet(str(tmp_path / str(i)))
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert held() <= before
    again = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert again.collect() == again.collect()  # made again where they are gone


def test_scratch_lies_in_the_folder_the_cluster_names(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


HOT = 20_000


def skewed(spark):
    """A third of the rows are copies of one claim, a third share one claim id and member, and many
    keys are NULL."""
    n = F.col("id")
    third = n % 3
    base = frame(spark, "claims", {}).drop("claim_id", "member_id", "billed_amount", "ingestion_timestamp")
    rows = spark.range(HOT, numPartitions=8).select(
        n, F.when(third == 0, "COPY").when(third == 1, "HOT").otherwise(F.concat(F.lit("C"), n.cast("string"))).alias("claim_id"),
        F.when(n % 6 == 5, "").otherwise(F.lit("M1")).alias("member_id"),
        F.when(third == 0, "1.00").otherwise(n.cast("string")).alias("billed_amount"),
        F.when(third == 1, F.concat(F.lit("2024-01-01T"), F.lpad(n.cast("string"), 6, "0"))).otherwise("2024-01-01T000000").alias("ingestion_timestamp"))
    literals = [F.lit(x).alias(c) for c, x in base.first().asDict().items()]
    return rows.select(*[c for c in rows.columns if c != "id"], *literals)


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_keys_copies_and_nulls(spark, broadcast):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, before if broadcast else "-1")
    try:
        dims = {n: spark.createDataFrame([(k,)], f"{c} string") for n, c, k in
                (("members", "member_id", "M1"), ("providers", "provider_id", "P1"), ("diagnoses", "diagnosis_code", "E11"))}
        raw = skewed(spark)
        built = s.build_claims(raw, *dims.values())
        row = built.metrics().first()
        copies = len([i for i in range(HOT) if i % 3 == 0])
        hot = len([i for i in range(HOT) if i % 3 == 1])
        # Copies differ in member_id where it is blank: n % 6 == 5 never holds for n % 3 == 0.
        bad = len([i for i in range(HOT) if i % 6 == 5])
        assert row.input_count == HOT and row.exact_duplicate_rows_removed == copies - 1
        assert row.quarantined_count == bad and row.quarantine_reason_breakdown == {"invalid_member_id_reference": bad}
        assert row.business_key_duplicates_removed == hot - 1
        survivor = built.silver.filter("claim_id = 'HOT'").collect()
        assert [int(r.billed_amount) for r in survivor] == [max(i for i in range(HOT) if i % 3 == 1)]
        assert row.output_count == HOT - (copies - 1) - bad - (hot - 1)
    finally:
        spark.conf.set(threshold, before)


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    """Rows that cross the shuffle, counted on the map side."""
    raw = skewed(spark)
    shuffled = Counter()
    for name, df in {"copies": d.collapse_copies(raw.filter("claim_id = 'COPY'"), CLAIMS.business),
                     "latest": d.latest_per_key(raw.filter("claim_id = 'HOT'"), ["claim_id"], ["ingestion_timestamp"], CLAIMS.business)}.items():
        assert df.count() >= 1
        executed = df._jdf.queryExecution()
        df.collect()
        final = executed.executedPlan().toString()
        assert "Exchange" in final
        node = executed.executedPlan().finalPhysicalPlan()
        shuffled[name] = _shuffle_records(node)
    assert 0 < shuffled["copies"] <= 8 and 0 < shuffled["latest"] <= 8


def _shuffle_records(node):
    """Sum of shuffleRecordsWritten over the exchanges of an executed plan."""
    total = 0
    metrics = node.metrics()
    if metrics.contains("shuffleRecordsWritten"):
        total += metrics.apply("shuffleRecordsWritten").value()
    children = node.children()
    for i in range(children.size()):
        total += _shuffle_records(children.apply(i))
    if "QueryStage" in node.getClass().getSimpleName():
        total += _shuffle_records(node.plan())
    return total


def test_a_lazy_fact_reads_only_what_a_query_needs(spark, tmp_path):
    layout = sinks.Layout(str(tmp_path))
    lake.write_layers(spark, {n: frame(spark, n, {}) for n in s.ALL}, layout, as_of="2025-01-01")
    silver = {n: sinks.read_silver(spark, layout, n) for n in s.ALL}
    from claimwright.plans.gold import build_gold

    text = plan(analytics.claims_by_state(build_gold(silver)))
    assert "ReadSchema: struct<claim_id:string,member_id:string,provider_id:string,claim_status:string>" in text
