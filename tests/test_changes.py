import datetime as dt
import random
from pathlib import Path

import pytest

from claimwright.contracts import CLAIMS
from claimwright.operators import alerts, changes
from claimwright.plans import backfill, lake
from claimwright.plans import silver as s
from claimwright.session import shared_dir
from claimwright.sources.sinks import Layout, read_silver
from claimwright.streaming import claims as streaming
from rows import T2, frame


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 3)), (3, None)], "id int, d date")
    assert changes.high_water(df.limit(0), "d") is None
    assert [r.id for r in changes.newer_than(df, "d", dt.date(2024, 1, 1)).collect()] == [2]
    assert changes.newer_than(df, "d", None).count() == 3


@pytest.mark.parametrize("seed", range(3))
def test_change_feed_equals_replaying_it(spark, seed):
    rng = random.Random(seed)
    table = {i: f"v{i}" for i in range(30)}
    feed = [(rng.choice([7, rng.randrange(50)]), f"c{n}", n, rng.choice(["insert", "update", "delete"])) for n in range(80)]
    want = dict(table)
    for key, value, _, op in feed:
        want.pop(key, None)
        if op != "delete":
            want[key] = value
    got = changes.apply_changes(
        spark.createDataFrame(list(table.items()), "id int, v string"),
        spark.createDataFrame(feed, "id int, v string, seq int, operation string"), ["id"], ["seq"])
    assert {r.id: r.v for r in got.collect()} == want and got.count() == len(want)


def feed(spark, *rows):
    return spark.createDataFrame([(k, dt.date(2024, 1, day) if day else None, v) for k, day, v in rows], "k string, d date, v string")


def test_increments_from_a_stored_mark(spark, tmp_path):
    target, load = str(tmp_path / "t"), changes.Increments(str(tmp_path / "marks"), "s", "d", ("k", "d", "v"), dt.timedelta(days=3))
    first = [("a", 10, "x"), ("a", 10, "x"), ("b", 8, None), ("c", None, "never")]
    assert load.mark(spark) is None and load.load(feed(spark, *first), target) == 2
    assert load.mark(spark) == dt.datetime(2024, 1, 10)
    # Equal to the mark, late within the overlap, late beyond it, a null that is held, and a corrected value.
    second = [*first, ("d", 10, "x"), ("e", 7, "x"), ("f", 6, "lost"), ("b", 8, "now"), ("g", 12, "x")]
    assert load.load(feed(spark, *second), target) == 4 and load.mark(spark) == dt.datetime(2024, 1, 12)
    got = sorted((r.k, r.d.day, r.v or "") for r in spark.read.parquet(target).collect())
    assert got == [("a", 10, "x"), ("b", 8, ""), ("b", 8, "now"), ("d", 10, "x"), ("e", 7, "x"), ("g", 12, "x")]
    assert load.load(feed(spark, *second), target) == 0 and load.load(feed(spark), target) == 0
    # A run that broke off before its mark stood, and another source.
    lost = changes.Increments(str(tmp_path / "other"), "s", "d", load.identity, load.overlap)
    assert lost.load(feed(spark, *second[:-1]), target) == 1  # only f, which no mark holds off now
    assert changes.Increments(load.marks, "s2", "d", load.identity).mark(spark) is None


DIMS = {"members": ("member_id", "M1"), "providers": ("provider_id", "P1"), "diagnoses": ("diagnosis_code", "E11")}


def dims(spark):
    return {n: spark.createDataFrame([(v,)], f"{c} string") for n, (c, v) in DIMS.items()}


def valid(spark, *rows):
    return s.build_claims(frame(spark, "claims", *rows), *dims(spark).values())


def state(spark, layout):
    rows = read_silver(spark, layout, "claims").collect()
    return sorted((r.claim_id, r.service_year_month, str(r.paid_amount)) for r in rows)


def files_of(layout, month):
    """Data files of a month in the version that readers see."""
    table = layout.silver_table("claims")
    folder = table.parts()[1].get(month)
    return sorted(p.name for p in Path(f"{table.root}/{folder}").glob("*.parquet"))


def test_backfill_rewrites_only_the_touched_months(spark, tmp_path):
    layout = Layout(str(tmp_path))
    feb, mar = {"service_date": "2024-02-01", "submission_date": "2024-02-02"}, {"service_date": "2024-03-01", "submission_date": "2024-03-02"}
    lake.write_built(spark, valid(spark, {"claim_id": "a"}, {"claim_id": "b"}, {"claim_id": "c", **feb}, {"claim_id": "d", **mar}), layout)
    march = files_of(layout, "2024-03")
    # b moves from January to February; a newer file corrects c; an older row for a changes nothing.
    late = valid(spark, {"claim_id": "b", **feb, "ingestion_timestamp": T2}, {"claim_id": "c", **feb, "paid_amount": "1.00", "ingestion_timestamp": T2},
                 {"claim_id": "a", "paid_amount": "2.00", "ingestion_timestamp": "2023-01-01T00:00:00+00:00"})
    assert backfill.backfill_claims(spark, layout, late.silver) == ["2024-01", "2024-02"]
    assert state(spark, layout) == [("a", "2024-01", "96.25"), ("b", "2024-02", "96.25"), ("c", "2024-02", "1.00"), ("d", "2024-03", "96.25")]
    assert files_of(layout, "2024-03") == march
    # January loses its last claim.
    backfill.backfill_claims(spark, layout, valid(spark, {"claim_id": "a", **feb, "ingestion_timestamp": T2}).silver)
    assert [r[:2] for r in state(spark, layout)] == [("a", "2024-02"), ("b", "2024-02"), ("c", "2024-02"), ("d", "2024-03")]
    assert files_of(layout, "2024-03") == march and files_of(layout, "2024-01") == []


def test_no_staged_table_is_left(spark, tmp_path):
    def staged():
        return sorted(p for label in ("staging", "silver") for p in Path(shared_dir(spark, label).removeprefix("file:")).rglob("*.parquet"))

    before, layout = staged(), Layout(str(tmp_path))
    raw = {n: frame(spark, n, {}) for n in ("members", "providers", "diagnoses", "claims")}
    tables = lake.write_layers(spark, raw, layout, as_of="2025-01-01")
    backfill.backfill_claims(spark, layout, valid(spark, {"claim_id": "late"}).silver)
    assert staged() == before and tables["members"].count() == 1


def test_stream_merges_batches_into_silver(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    lake.write_built(spark, valid(spark, {"claim_id": "a"}), layout)
    for i, rows in enumerate([[{"claim_id": "b"}, {"claim_id": "bad", "member_id": "x"}], [{"claim_id": "a", "paid_amount": "5.00", "ingestion_timestamp": T2}]]):
        frame(spark, "claims", *rows).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    raw = streaming.read_claims(spark, str(tmp_path / "in" / "*"), max_files=1)
    streaming.merge_into_silver(raw, layout, lambda: dims(spark), str(tmp_path / "checkpoint")).awaitTermination()
    assert [(c, paid) for c, _, paid in state(spark, layout)] == [("a", "5.00"), ("b", "96.25")]
    assert [r.claim_id for r in spark.read.parquet(layout.quarantine("claims") + "_stream").collect()] == ["bad"]


def test_stream_drops_resends_and_late_rows(spark, tmp_path):
    """Arrival out of order on purpose: a copy in the second file, a row behind the watermark in the third."""
    day = lambda n: {"claim_id": f"C{n}", "submission_date": f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"}
    for i, rows in enumerate([[day(0), day(1), day(100)], [day(100)], [day(2), day(200)]]):
        frame(spark, "claims", *rows).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    rows = streaming.timed(streaming.read_claims(spark, str(tmp_path / "in" / "*"), max_files=1), "10 days")
    windows = streaming.volume_by_window(streaming.without_resends(rows), "7 days")
    streaming.write_windows(windows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    counts = [r.claim_count for r in spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()]
    assert counts == [2, 1]


def test_resends_are_kept_once_by_their_identity(spark, tmp_path):
    """The state of the stream: one row for each content, without the columns that the windows do not ask for."""
    rows = [{"claim_id": f"C{i % 5}", "denial_reason": "" if i % 2 else None, "source_file": f"{i}.csv"} for i in range(40)]
    frame(spark, "claims", *rows, {"claim_id": "last", "submission_date": "2024-09-01"}).write.parquet(str(tmp_path / "in"))
    raw = streaming.timed(streaming.read_claims(spark, str(tmp_path / "in")), "10 days")
    query = streaming.write_windows(streaming.volume_by_window(streaming.without_resends(raw), "7 days"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    operators = [o for p in query.recentProgress for o in p.stateOperators]
    assert {o.operatorName for o in operators} == {"stateStoreSave"} and max(o.numRowsTotal for o in operators) == 6
    text = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "source_file" not in "".join(line for line in text.splitlines() if "StateStore" in line)
    assert [r.claim_count for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [5]


def test_alerts(spark):
    rows = spark.createDataFrame([("output_count", 0), ("quarantined_count", 5), ("input_count", 9)], "metric string, value bigint")
    out = alerts.metric_alerts(rows, "claims", {"output_count": (1, 100), "quarantined_count": (0, 5)})
    assert [tuple(r) for r in out.collect()] == [("claims", "output_count", "0")]
    runs = spark.createDataFrame(
        [("s", "a.csv", "FAILED", "boom"), ("s", "b.csv", "SUCCESS", None), ("s", "c.csv", "SUCCESS_WITH_DRIFT", None)],
        "source_name string, source_file string, status string, error_message string")
    assert sorted(tuple(r) for r in alerts.run_alerts(runs).collect()) == [("s", "failed", "boom"), ("s", "success_with_drift", "c.csv")]


def test_business_columns_match_the_contract():
    assert len(CLAIMS.business) == 13 and CLAIMS.optional == {"adjustment_amount"}


def test_late_rows_join_sessions_and_rows_behind_the_watermark_do_not(spark, tmp_path):
    """Days of 2024 after the first: 0 and 20 are two sessions until 10 arrives late; 2 comes too late."""
    def arrive(number, *days):
        rows = [{"claim_id": f"{number}-{n}", "submission_date": str(dt.date(2024, 1, 1) + dt.timedelta(days=n))} for n in days]
        frame(spark, "claims", *rows).coalesce(1).write.parquet(str(tmp_path / "in" / str(number)))
        rows = streaming.timed(streaming.read_claims(spark, str(tmp_path / "in" / "*")), "30 days")
        out = streaming.sessions(rows, "member_id", "10 days")
        streaming.write_windows(out, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        done = spark.read.parquet(str(tmp_path / "out")).orderBy("session_start").collect()
        return [(r.session_start.date().isoformat(), r.session_end.date().isoformat(), r.claim_count) for r in done]

    assert arrive(1, 20, 0, 25) == []
    assert arrive(2, 10, 100) == [("2024-01-01", "2024-02-05", 4)]
    assert arrive(3, 2, 200) == [("2024-01-01", "2024-02-05", 4), ("2024-04-10", "2024-04-20", 1)]


def test_a_stream_keeps_its_state_beyond_the_heap_in_any_session(spark, tmp_path):
    from claimwright.session import STATE_BYTES, STREAMS

    before = {key: spark.conf.get(key, None) for key in STREAMS}
    frame(spark, "claims", {}, {"claim_id": "C2", "submission_date": "2024-03-01"}).write.parquet(str(tmp_path / "in"))
    rows = streaming.timed(streaming.read_claims(spark, str(tmp_path / "in")), "10 days")
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions")) + 2
    try:
        for key in STREAMS:  # as in a session that get_spark did not make
            spark.conf.unset(key)
        bare = {key: spark.conf.get(key, None) for key in STREAMS}
        out = streaming.sessions(rows, "member_id", "10 days")
        streaming.write_windows(out, str(tmp_path / "out"), str(tmp_path / "checkpoint"), wanted * STATE_BYTES).awaitTermination()
        assert {key: spark.conf.get(key, None) for key in STREAMS} == bare
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    state = tmp_path / "checkpoint" / "state" / "0"
    assert list(state.rglob("*.zip")) and {p.name for p in state.iterdir() if p.name.isdigit()} == {str(i) for i in range(wanted)}
    assert [r.claim_count for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]
