"""Dimension builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.config import DEFAULT_RULES, RuleConfig
from txnflow.functions import date_key, is_business_minute, is_peak_hour, maintenance_day, period_label
from txnflow.schemas import DIM_CALENDAR, DIM_CUSTOMER, DIM_TIME
from txnflow.sources.series import HOLIDAY_NAMES, days_between, holidays, minutes_of_day


def dim_time(spark: SparkSession, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    hour = F.col("hour")
    return (
        minutes_of_day(spark)
        .withColumns(
            {
                "time_id": hour * 100 + F.col("minute"),
                "is_peak_hour": is_peak_hour(hour, cfg),
                "is_business_hour": is_business_minute(hour, cfg),
                "period_label": period_label(hour),
            }
        )
        .select(*DIM_TIME.names)
    )


def calendar_of(days: DataFrame, names=HOLIDAY_NAMES, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Calendar rows for a table of ``full_date``s."""
    weekday = F.weekday("full_date")
    named = days.join(F.broadcast(holidays(days.sparkSession, names)), "full_date", "left")
    return named.withColumns(
        {
            "date_id": date_key("full_date"),
            "day_of_week": weekday,
            "is_weekend": weekday >= 5,
            "is_holiday": F.col("holiday_name").isNotNull(),
            "is_maintenance": reduce(Column.__or__, [maintenance_day("full_date", day) for day, _, _ in cfg.maintenance_windows]),
        }
    ).select(*DIM_CALENDAR.names)


def dim_calendar(spark: SparkSession, first: str = "2024-01-01", last: str = "2026-12-31") -> DataFrame:
    return calendar_of(days_between(spark, first, last))


def dim_customer(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in DIM_CUSTOMER.fields])
