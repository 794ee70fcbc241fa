"""Schemas of the blob listing, the nested documents and the flat table."""

from __future__ import annotations

from dataclasses import dataclass

# Field names and nesting of the published index documents.
LISTING_SCHEMA = "blobs array<struct<name: string, size: bigint, downloadUrl: string>>"

CORRUPT_COLUMN = "_corrupt_record"

INDEX_SCHEMA = f"""
    reporting_entity_name string,
    reporting_entity_type string,
    last_updated_on string,
    version string,
    reporting_structure array<struct<
        reporting_plans: array<struct<
            plan_name: string,
            plan_id: string,
            plan_id_type: string,
            plan_market_type: string,
            plan_sponsor_name: string,
            issuer_name: string>>,
        in_network_files: array<struct<description: string, location: string>>,
        allowed_amount_file: struct<description: string, location: string>>>,
    {CORRUPT_COLUMN} string
"""


@dataclass(frozen=True)
class FlatColumn:
    """One column of the flat table: where it comes from, its type, its rule."""

    name: str
    path: str
    type: str = "string"
    required: bool = True


# The columns of the flat table, in table order.
# ``path`` is relative to one (document, structure, plan, file) combination.
FLAT_COLUMNS = (
    FlatColumn("source_file", "source_file"),
    FlatColumn("reporting_date", "reporting_date", "date"),
    FlatColumn("processed_at", "processed_at", "timestamp_ntz"),
    FlatColumn("reporting_entity_name", "reporting_entity_name"),
    FlatColumn("reporting_entity_type", "reporting_entity_type"),
    FlatColumn("last_updated_on", "last_updated_on", "date"),
    FlatColumn("version", "version"),
    FlatColumn("plan_name", "plan.plan_name"),
    FlatColumn("plan_id", "plan.plan_id"),
    FlatColumn("plan_id_type", "plan.plan_id_type"),
    FlatColumn("plan_market_type", "plan.plan_market_type"),
    FlatColumn("plan_sponsor_name", "plan.plan_sponsor_name", required=False),
    FlatColumn("issuer_name", "plan.issuer_name"),
    FlatColumn("in_network_description", "network_file.description", required=False),
    FlatColumn("in_network_location", "network_file.location", required=False),
    FlatColumn("allowed_amount_description", "allowed_file.description", required=False),
    FlatColumn("allowed_amount_location", "allowed_file.location", required=False),
)

LOADED_AT = FlatColumn("loaded_at", "", "timestamp_ntz", required=False)
PARTITION_COLUMN = "partition_date"

FLAT_NAMES = [c.name for c in FLAT_COLUMNS]
REQUIRED_NAMES = [c.name for c in FLAT_COLUMNS if c.required]
TABLE_COLUMNS = (*FLAT_COLUMNS, LOADED_AT)

# All 18 columns as one DDL string, for readers of the exported table.
TABLE_SCHEMA = ", ".join(f"{c.name} {c.type}" for c in TABLE_COLUMNS)
