"""Schemas of the tables, fixed by contract; readers fail on a missing column instead of guessing."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


RAW_SPEC = (
    "row_id long, date date, hour_of_day long, sku_id long, fc string, inventory double, discount double, units_sold long, normal_asp double, "
    "final_price double, cogs_wo_vat double, ending_inventory double, hours_remaining double, category string, subcategory string, loaded_at timestamp"
)
OUTCOME_SPEC = (
    "delivery_id long, batch_id string, received_at timestamp, outcome_id string, decision_id string, units_sold long, starting_inventory long, "
    "ending_inventory long, applied_price double, is_stockout boolean, execution_status string, finalized_at string, adjustment_reason string, execution_failure_reason string"
)


def raw_schema() -> T.StructType:
    return _struct(RAW_SPEC)


def outcome_schema() -> T.StructType:
    return _struct(OUTCOME_SPEC)


def missing_columns(have: list[str], want: T.StructType) -> list[str]:
    return [f.name for f in want.fields if f.name not in have]
