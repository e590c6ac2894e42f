"""Business context and masking columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULT_RULES, RuleConfig
from txnflow.functions import (
    is_business_hour,
    is_holiday,
    is_maintenance,
    is_peak_hour,
    mask_account,
    mask_national_id,
    mask_phone,
    off_hours_large,
)

CLEAR_COLUMNS = ("account_number", "phone", "national_id", "full_name")


def tag_context(rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return rows.withColumns(
        {
            "is_peak_hour": is_peak_hour(F.hour("event_ts"), cfg),
            "is_business_hour": is_business_hour("event_ts", cfg),
            "is_holiday": is_holiday("event_ts", cfg),
            "is_maintenance": is_maintenance("event_ts", cfg),
            "is_night_large_risk": off_hours_large(cfg=cfg),
        }
    )


def split_maintenance(rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> tuple[DataFrame, DataFrame]:
    """(rows to process now, rows held until after the maintenance window)."""
    held = is_maintenance("event_ts", cfg)
    return rows.filter(~held), rows.filter(held)


def mask_pii(df: DataFrame) -> DataFrame:
    """Add masked columns for the clear ones present, then drop those."""
    masks = {"account_number": mask_account, "phone": mask_phone, "national_id": mask_national_id}
    names = {"account_number": "account_masked", "phone": "phone_masked", "national_id": "national_id_masked"}
    present = [c for c in masks if c in df.columns]
    return df.withColumns({names[c]: masks[c](c) for c in present}).drop(*CLEAR_COLUMNS)
