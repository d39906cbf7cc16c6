import datetime as dt

import pytest

from claimwright.operators import metrics as m
from claimwright.plans import lake, silver as s
from claimwright.sources import sinks
from rows import T2, frame


def ids(df, key):
    return sorted(r[key] for r in df.collect())


def bronze(spark):
    return {
        "members": frame(spark, "members", {}, {}, {"member_id": "M2", "state": "ZZ"}, {"member_id": "M3", "zip_code": ""},
                         {"member_id": "M3", "enrollment_start_date": "2021-01-01"}),
        "providers": frame(spark, "providers", {}, {}, {"network_status": "Out-of-Network", "effective_date": "2022-06-01"},
                           {"provider_id": "P2", "npi": "2"}),
        "diagnoses": frame(spark, "diagnoses", {}, {"diagnosis_code": "Z", "category": ""}),
        "claims": frame(spark, "claims", {"claim_id": "OK"}, {"claim_id": "OK", "paid_amount": "90.00", "ingestion_timestamp": T2},
                        {"claim_id": "OK", "paid_amount": "-1", "ingestion_timestamp": "2025-01-01T00:00:00+00:00"},
                        {"claim_id": "ORPHAN", "diagnosis_code": "Z"}, {"claim_id": "LATE", "submission_date": "2024-06-01"},
                        {"claim_id": "LATE", "submission_date": "2024-06-01", "ingestion_timestamp": T2, "source_file": "b.csv"},
                        {"claim_id": "B2", "ingestion_batch_id": "BATCH_2", "adjustment_amount": "12.50"}),
    }


def test_members(spark):
    built = s.build_members(bronze(spark)["members"], "2025-01-01")
    row = built.metrics().first()
    assert ids(built.silver, "member_id") == ["M1", "M3"]
    assert built.silver.filter("member_id = 'M3'").first().enrollment_start_date == dt.date(2021, 1, 1)
    assert (row.input_count, row.output_count, row.exact_duplicate_rows_removed, row.business_key_duplicates_removed, row.quarantined_count) == (5, 2, 1, 1, 1)
    assert row.quarantine_reason_breakdown == {"invalid_state_code": 1}
    assert row.null_counts == {"date_of_birth": 0, "state": 0, "zip_code": 0}


def test_provider_history_is_kept(spark):
    built = s.build_providers(bronze(spark)["providers"])
    assert ids(built.silver, "provider_id") == ["P1", "P1", "P2"]
    row = built.metrics().first()
    assert (row.exact_duplicate_rows_removed, row.providers_with_historical_versions_preserved) == (1, 1)


def test_claims(spark):
    built = s.build_all(bronze(spark), "2025-01-01")["claims"]
    silver = {r.claim_id: r for r in built.silver.collect()}
    assert sorted(silver) == ["B2", "LATE", "OK"]
    # The correction supersedes; the later but invalid row does not.
    assert str(silver["OK"].paid_amount) == "90.00" and silver["LATE"].ingestion_timestamp == T2
    assert silver["OK"].service_year_month == "2024-01"
    row = built.metrics().first()
    assert row.referential_integrity_failures == {
        "invalid_member_id_reference": 0, "invalid_provider_id_reference": 0, "invalid_diagnosis_code_reference": 1}
    assert (row.batch_1_input_rows, row.batch_2_input_rows, row.late_arriving_count, row.adjustment_amount_present_count) == (6, 1, 1, 1)
    assert row.input_count == row.exact_duplicate_rows_removed + row.business_key_duplicates_removed + row.quarantined_count + row.output_count


def test_single_and_joined_reasons(spark):
    built = s.build_all(bronze(spark), "2025-01-01")["claims"]
    assert {r.reason: r.rows for r in m.reason_breakdown(built.validated).collect()} == {
        "negative_paid_amount": 1, "invalid_diagnosis_code_reference": 1}


def test_two_runs_write_the_same_silver(spark, tmp_path):
    out = []
    for run in ("a", "b"):
        layout = sinks.Layout(f"{tmp_path}/{run}")
        raw = {n: df.repartition(3 if run == "a" else 1) for n, df in bronze(spark).items()}
        tables = lake.write_layers(spark, raw, layout, as_of="2025-01-01")
        lake.run_gold(spark, layout, views=False)
        out.append({n: sorted(map(str, t.collect())) for n, t in tables.items()})
        done = {r.artifact: r for r in sinks.check_outputs(spark, layout, strict=False).collect()}
        assert done["gold/fact_claims"].row_count == 3 and not done["bronze/claims"].present
    assert out[0] == out[1]
    with pytest.raises(FileNotFoundError, match="bronze/claims"):
        sinks.check_outputs(spark, layout)


def test_only_requested_datasets_are_written(spark, tmp_path):
    layout = sinks.Layout(str(tmp_path))
    assert list(lake.write_layers(spark, bronze(spark), layout, ["claims"], "2025-01-01")) == ["claims"]
    assert [p.name for p in (tmp_path / "silver").iterdir()] == ["claims"]
    assert "service_year_month=2024-01" in [p.name for p in (tmp_path / "silver" / "claims").glob("version=*/*")]
    with pytest.raises(ValueError):
        lake.write_layers(spark, bronze(spark), layout, ["nope"])


def test_metrics_keep_a_history(spark, tmp_path):
    layout = sinks.Layout(str(tmp_path))
    built = s.build_diagnoses(bronze(spark)["diagnoses"])
    for _ in range(2):
        sinks.write_metrics(built.metrics(), layout, "diagnoses")
    assert spark.read.json(layout.metrics_history("diagnoses")).count() == 2
    latest = spark.read.json(layout.metrics("diagnoses")).collect()
    assert len(latest) == 1 and latest[0].dataset == "diagnoses" and latest[0].quarantined_count == 1


def test_no_claims_at_all(spark, tmp_path):
    raw = bronze(spark)
    raw["claims"] = raw["claims"].limit(0)
    tables = lake.write_layers(spark, raw, sinks.Layout(str(tmp_path)), as_of="2025-01-01")
    assert tables["claims"].count() == 0
