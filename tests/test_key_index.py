import random
from dataclasses import replace

import pytest

from claimwright.plans import backfill, lake
from claimwright.sources.key_index import HASH, KeyIndex
from claimwright.sources.sinks import Layout, read_silver, write_silver
from rows import T2
from test_changes import state, valid

JAN, FEB, MAR = [{"service_date": f"2024-0{m}-01", "submission_date": f"2024-0{m}-02"} for m in (1, 2, 3)]


def months(index, spark, *ids):
    asked = spark.createDataFrame([(i,) for i in ids], "claim_id string")
    return sorted(r[0] for r in index.places(asked).collect())


def spoil(tmp_path, month):
    """Overwrite the pages of a month's files; sizes and footers stay, so only reading a column fails."""
    for p in tmp_path.glob(f"silver/claims/version=*/service_year_month={month}/*.parquet"):
        data = p.read_bytes()
        footer = int.from_bytes(data[-8:-4], "little") + 8
        p.write_bytes(data[:4] + b"\xff" * (len(data) - footer - 4) + data[-footer:])
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)


def test_an_increment_reads_no_key_of_other_months(spark, tmp_path):
    layout = Layout(str(tmp_path))
    lake.write_built(spark, valid(spark, {"claim_id": "a", **JAN}, {"claim_id": "b", **FEB}, {"claim_id": "d", **MAR}), layout)
    spoil(tmp_path, "2024-03")
    with pytest.raises(Exception):
        read_silver(spark, layout, "claims").select("claim_id").collect()
    late = valid(spark, {"claim_id": "a", **FEB, "ingestion_timestamp": T2}, {"claim_id": "new", **FEB})
    assert backfill.backfill_claims(spark, layout, late.silver) == ["2024-01", "2024-02"]
    left = read_silver(spark, layout, "claims").filter("service_year_month < '2024-03'")
    assert sorted((r.claim_id, r.service_year_month) for r in left.collect()) == [("a", "2024-02"), ("b", "2024-02"), ("new", "2024-02")]


def test_only_the_slots_of_the_asked_keys_are_read(spark, tmp_path):
    table = spark.range(400).selectExpr("concat('K', id) as k", "concat('2024-', 10 + id % 3) as m")
    index = KeyIndex(str(tmp_path / "i"), ("k",), "m", slot_entries=10)
    index.build(table)
    asked = table.filter("k in ('K7', 'K8')").select("k")
    found = index.places(asked)
    assert sorted(r.m for r in found.collect()) == ["2024-11", "2024-12"]
    scans = [n for n in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in n and HASH in n]
    assert scans and all("PartitionFilters: [isnotnull(slot" in n or "PartitionFilters: [slot" in n for n in scans)
    assert len(list((tmp_path / "i").glob("entries-*/slot=*"))) == 40
    assert index.places(asked.limit(0)).count() == 0
    assert sorted(r.m for r in index.places(table).collect()) == ["2024-10", "2024-11", "2024-12"]


def test_an_index_that_does_not_stand_is_made_anew(spark, tmp_path):
    layout, index = Layout(str(tmp_path)), Layout(str(tmp_path)).claim_index()
    first = valid(spark, {"claim_id": "a", **JAN}, {"claim_id": "b", **FEB})
    lake.write_built(spark, first, layout)
    assert months(index, spark, "a", "b", "none") == ["2024-01", "2024-02"]
    # Silver is replaced outside the job that makes the index: the old one must not be asked.
    write_silver(valid(spark, {"claim_id": "a", **MAR}).silver, layout, "claims", ["service_year_month"])
    assert not (tmp_path / "silver_index").exists() or not list((tmp_path / "silver_index").rglob("*.parquet"))
    assert backfill.backfill_claims(spark, layout, valid(spark, {"claim_id": "a", **JAN, "ingestion_timestamp": T2}).silver) == ["2024-01", "2024-03"]
    assert [r[:2] for r in state(spark, layout)] == [("a", "2024-01")]
    # Entries whose state was never written, as a broken run leaves them.
    index.forget()
    spark.range(1).selectExpr("1L as key_hash", "'2000-01' as place", "0 as slot").write.partitionBy("slot").parquet(f"{index.root}/entries-old")
    assert backfill.backfill_claims(spark, layout, valid(spark, {"claim_id": "a", **FEB, "ingestion_timestamp": "2024-09-01T00:00:00+00:00"}).silver) == ["2024-01", "2024-02"]


def test_a_run_that_broke_off_is_made_good(spark, tmp_path, monkeypatch):
    """The index has the fresh rows, the table has not: the rerun finds the old month and the new one."""
    layout = Layout(str(tmp_path))
    lake.write_built(spark, valid(spark, {"claim_id": "a", **JAN}, {"claim_id": "b", **JAN}), layout)
    moved = valid(spark, {"claim_id": "a", **MAR, "ingestion_timestamp": T2}).silver
    add = KeyIndex.add

    def then_stop(self, rows):
        add(self, rows)
        raise RuntimeError("stopped")

    monkeypatch.setattr(KeyIndex, "add", then_stop)
    with pytest.raises(RuntimeError, match="stopped"):
        backfill.backfill_claims(spark, layout, moved)
    monkeypatch.setattr(KeyIndex, "add", add)
    assert [r[:2] for r in state(spark, layout)] == [("a", "2024-01"), ("b", "2024-01")]
    assert backfill.backfill_claims(spark, layout, moved) == ["2024-01", "2024-03"]
    assert [r[:2] for r in state(spark, layout)] == [("a", "2024-03"), ("b", "2024-01")]


def test_merges_equal_the_newest_row_of_each_claim(spark, tmp_path, monkeypatch):
    """Random batches, an index with many slots that is made anew after two additions."""
    monkeypatch.setattr(Layout, "claim_index", lambda self, made=Layout.claim_index: replace(made(self), slot_entries=2, tidy_after=2))
    rng, layout, newest = random.Random(5), Layout(str(tmp_path)), {}

    def batch(n):
        rows = []
        for _ in range(n):
            month, at = rng.choice([JAN, FEB, MAR]), f"2024-0{rng.randint(4, 9)}-{rng.randint(10, 28)}T00:00:{rng.randint(10, 59)}+00:00"
            rows.append({"claim_id": f"C{rng.randrange(12)}", **month, "ingestion_timestamp": at})
        for r in rows:
            if r["claim_id"] not in newest or r["ingestion_timestamp"] > newest[r["claim_id"]][1]:
                newest[r["claim_id"]] = (r["service_date"][:7], r["ingestion_timestamp"])
        return valid(spark, *rows)

    lake.write_built(spark, batch(8), layout)
    for _ in range(3):
        backfill.backfill_claims(spark, layout, batch(4).silver)
        assert {c: m for c, m, _ in state(spark, layout)} == {c: m for c, (m, _) in newest.items()}
        for c, (m, _) in newest.items():
            assert m in months(layout.claim_index(), spark, c)
    assert len(list((tmp_path / "silver_index" / "claims").glob("entries-*"))) == 1
