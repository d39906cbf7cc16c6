"""Bronze rows with defaults that pass every rule."""

from claimwright.contracts import CONTRACTS, PROVENANCE

T1, T2 = "2024-01-01T00:00:00+00:00", "2024-05-01T00:00:00+00:00"
_AT = {"ingestion_timestamp": T1, "source_file": "a.csv", "file_hash": "h"}

MEMBER = {
    "member_id": "M1", "first_name": "Wren", "last_name": "Okafor", "date_of_birth": "1984-07-19", "gender": "M",
    "enrollment_start_date": "2020-03-15", "enrollment_end_date": "", "plan_type": "POS", "state": "CA",
    "zip_code": "94612", "source_system": "ROSTER", **_AT,
}
PROVIDER = {
    "provider_id": "P1", "provider_name": "Harbor Street Practice", "specialty": "Podiatry", "npi": "1700200300",
    "network_status": "In-Network", "address_state": "CA", "effective_date": "2019-05-06", "source_system": "DIRECTORY", **_AT,
}
DIAGNOSIS = {"diagnosis_code": "E11", "diagnosis_description": "Sugar metabolism, adult", "category": "Metabolic", **_AT}
CLAIM = {
    "claim_id": "C1", "member_id": "M1", "provider_id": "P1", "diagnosis_code": "E11", "service_date": "2024-01-01",
    "submission_date": "2024-01-17", "billed_amount": "143.50", "paid_amount": "96.25", "claim_status": "Paid",
    "denial_reason": "", "ingestion_batch_id": "BATCH_1", "source_system": "DESK", "adjustment_amount": None, **_AT,
}
DEFAULTS = {"members": MEMBER, "providers": PROVIDER, "diagnoses": DIAGNOSIS, "claims": CLAIM}


def frame(spark, name, *changes):
    """One row per dict of changes to the default row."""
    schema = CONTRACTS[name].bronze_schema
    rows = [{**DEFAULTS[name], **change} for change in changes]
    assert set(PROVENANCE) <= set(schema.names)
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


def reasons(df, key):
    return {r[key]: list(r["_rejection_reasons"]) for r in df.collect()}
