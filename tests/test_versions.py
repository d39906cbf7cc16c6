"""Versioned tables: whole versions or none, nothing copied, nothing left."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import T2
from test_changes import valid
from test_key_index import FEB, JAN

from claimwright.plans import backfill, lake
from claimwright.sources.audit import AuditLog
from claimwright.sources.sinks import Layout, read_silver
from claimwright.sources.versions import NULL_PLACE, VersionedTable


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, m string")


def seen(df):
    return sorted((r.k, r.m or "") for r in df.collect())


def test_a_write_that_breaks_off_leaves_the_version_before(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path))
    lake.write_built(spark, valid(spark, {"claim_id": "a", **JAN}, {"claim_id": "b", **FEB}), layout)
    late = valid(spark, {"claim_id": "a", **FEB, "ingestion_timestamp": T2}, {"claim_id": "c", **JAN}).silver

    def state():
        return sorted((r.claim_id, r.service_year_month) for r in read_silver(spark, layout, "claims").collect())

    with monkeypatch.context() as m:
        def broken(*_):
            raise RuntimeError("the driver is lost")

        m.setattr(VersionedTable, "_publish", broken)  # both months are written by then
        with pytest.raises(RuntimeError):
            backfill.backfill_claims(spark, layout, late)
    assert state() == [("a", "2024-01"), ("b", "2024-02")]
    backfill.backfill_claims(spark, layout, late)
    assert state() == [("a", "2024-02"), ("b", "2024-02"), ("c", "2024-01")]
    assert len(list((tmp_path / "silver" / "claims").glob("version=*"))) == 2  # the broken run's folder is gone


def test_readers_keep_the_version_that_they_began_with(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"))
    table.replace(rows(spark, (1, "a"), (2, "b"), (3, "c")), ["m"])
    first = table.read(spark)
    stays = table.parts()[1]["c"]
    table.replace_partitions(rows(spark, (4, "a")), "m", ["a", "b"])
    assert seen(first) == [(1, "a"), (2, "b"), (3, "c")] and seen(table.read(spark)) == [(3, "c"), (4, "a")]
    assert seen(table.read(spark, version=1)) == seen(first)
    assert table.parts() == (2, table.parts()[1]) and table.parts()[1]["c"] == stays
    table.replace_partitions(rows(spark, (5, "a")), "m", ["a"])
    # The first version is gone but for the partition that newer ones name.
    assert table.versions() == [2, 3] and [p.name for p in Path(f"{table.root}/{stays}").parent.glob("m=*")] == ["m=c"]
    with pytest.raises(FileNotFoundError):
        table.read(spark, version=1)


def test_partitions_that_were_not_named_are_refused(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"))
    table.replace(rows(spark, (1, "a")), ["m"])
    with pytest.raises(ValueError, match="not named"):
        table.replace_partitions(rows(spark, (2, "b")), "m", ["a"])
    with pytest.raises(ValueError, match="columns"):
        table.replace_partitions(rows(spark, (2, "a")).selectExpr("k as other", "m"), "m", ["a"])
    assert seen(table.read(spark)) == [(1, "a")]


def test_empty_tables_null_and_odd_places(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.replace(rows(spark), ["m"])
    assert table.read(spark).columns == ["k", "m"] and table.read(spark).isEmpty()
    table.replace_partitions(rows(spark, (1, None), (2, "a/b c%"), (3, "2024-01")), "m", [NULL_PLACE, "a/b c%", "2024-01"])
    assert seen(table.read(spark)) == [(1, ""), (2, "a/b c%"), (3, "2024-01")]
    table.replace_partitions(rows(spark), "m", ["a/b c%", NULL_PLACE])
    assert seen(table.read(spark)) == [(3, "2024-01")]
    table.replace_partitions(rows(spark), "m", ["2024-01"])
    assert table.read(spark).isEmpty()
    table.replace(rows(spark, (7, "x")))  # without partitions
    assert seen(table.read(spark)) == [(7, "x")] and table.parts()[1].keys() == {""}


def test_a_manifest_that_was_not_finished_is_no_version(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"))
    table.replace(rows(spark, (1, "a")), ["m"])
    Path(f"{table.manifest}/00000002.json.unfinished").write_text("{")
    assert table.versions() == [1] and seen(table.read(spark)) == [(1, "a")]
    table.replace(rows(spark, (2, "b")), ["m"])
    assert table.parts()[0] == 2 and seen(table.read(spark)) == [(2, "b")]
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(rows(spark), 2, {})


def test_the_audit_log_stays_few_files(spark, tmp_path):
    """Many runs, each with a begun and an ended attempt: the files that are read stay bounded and no event is lost."""
    log = AuditLog(spark, str(tmp_path / "log"), compact_after=4)
    for run in range(9):
        begun = log.started(spark.createDataFrame([("a.csv", f"h{run}")], "source_file string, file_hash string"), "s", "full", f"2024-01-0{run + 1}")
        begun = spark.createDataFrame(begun.collect(), begun.schema)
        log.append(begun, "s")
        log.append(begun.withColumns({"status": F.lit("SUCCESS"), "event_time": F.lit(f"2024-01-0{run + 1}T01")}), "s")
        assert len(log.table("s").parts()[1]) <= 5
        files = log.events("s").inputFiles()
        assert len(files) <= 5 and log.events("s").count() == 2 * (run + 1)
    assert log.ingested("s").count() == 9 and [r.status for r in log.history("s").collect()] == ["SUCCESS"] * 9
    assert len(list((tmp_path / "log").rglob("*.parquet"))) <= 16 and log.source_names() == ["s"]
