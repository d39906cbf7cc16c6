"""Declared sources: where files land, which columns they must have, what happens on drift."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields, replace

from claimwright.contracts import CLAIMS, CONTRACTS, Contract

DRIFT_POLICIES = ("fail", "warn", "allow")
LOAD_TYPES = ("full", "incremental")


@dataclass(frozen=True)
class Source:
    name: str
    description: str
    source_dir: str
    file_pattern: str
    file_format: str
    load_type: str
    primary_key: tuple[str, ...]
    expected_columns: tuple[str, ...]
    required_columns: tuple[str, ...]
    schema_drift_policy: str
    bronze_path: str
    incremental_key: str | None = None

    def __post_init__(self) -> None:
        if self.schema_drift_policy not in DRIFT_POLICIES:
            raise ValueError(f"source {self.name}: schema_drift_policy must be one of {DRIFT_POLICIES}")
        if self.load_type not in LOAD_TYPES:
            raise ValueError(f"source {self.name}: load_type must be one of {LOAD_TYPES}")

    def under(self, landing_root: str, bronze_root: str) -> Source:
        """The same source with its folders below other roots."""
        return replace(self, source_dir=f"{landing_root}/{self.source_dir}", bronze_path=f"{bronze_root}/{self.bronze_path}")


_OPTIONAL_FIELDS = {"incremental_key"}
_LISTS = {"primary_key", "expected_columns", "required_columns"}


def _source(name: str, spec: dict) -> Source:
    known = [f.name for f in fields(Source) if f.name != "name"]
    missing = [f for f in known if f not in spec and f not in _OPTIONAL_FIELDS]
    if missing:
        raise ValueError(f"source {name}: missing field(s) {missing}")
    values = {f: tuple(spec[f]) if f in _LISTS else spec[f] for f in known if f in spec}
    return Source(name=name, **values)


def load_sources(path: str) -> dict[str, Source]:
    """Read and check a registry file: JSON, or YAML where a YAML parser is installed."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"source registry not found: {path}")
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            raw = json.load(f)
        else:
            try:
                import yaml
            except ImportError as e:
                raise ValueError("a YAML registry needs a YAML parser; use JSON instead") from e
            raw = yaml.safe_load(f)
    if not isinstance(raw, dict) or "sources" not in raw:
        raise ValueError(f"{path}: no top-level 'sources'")
    return {name: _source(name, spec) for name, spec in raw["sources"].items()}


def _declared(contract: Contract, description: str, pattern: str, load_type: str, policy: str) -> Source:
    expected = tuple(c for c in contract.business if c not in contract.optional)
    return Source(
        name=contract.name,
        description=description,
        source_dir=contract.name,
        file_pattern=pattern,
        file_format="csv",
        load_type=load_type,
        primary_key=contract.key,
        expected_columns=expected,
        required_columns=contract.required,
        schema_drift_policy=policy,
        bronze_path=contract.name,
        incremental_key="file" if contract is CLAIMS else None,
    )


def default_sources() -> dict[str, Source]:
    """The four declared sources; folders are relative to the roots given to ``under``."""
    declared = [
        _declared(CONTRACTS["members"], "Member enrollment records", "members*.csv", "full", "fail"),
        _declared(CONTRACTS["providers"], "Provider network records", "providers*.csv", "full", "fail"),
        _declared(CONTRACTS["diagnoses"], "Diagnosis reference", "diagnoses*.csv", "full", "fail"),
        _declared(CONTRACTS["claims"], "Claim batches, columns may be added", "claims_batch_*.csv", "incremental", "warn"),
    ]
    return {s.name: s for s in declared}
