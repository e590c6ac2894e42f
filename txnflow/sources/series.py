"""Generated series: minutes of the day, days of a span, named holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Public holidays and their names.
HOLIDAY_NAMES = (
    ("2025-01-01", "Tết Dương lịch"),
    ("2025-01-28", "Tết Nguyên Đán (nghỉ bù)"),
    ("2025-01-29", "Tết Nguyên Đán"),
    ("2025-01-30", "Tết Nguyên Đán"),
    ("2025-01-31", "Tết Nguyên Đán"),
    ("2025-02-01", "Tết Nguyên Đán"),
    ("2025-02-02", "Tết Nguyên Đán"),
    ("2025-02-03", "Tết Nguyên Đán"),
    ("2025-04-07", "Giỗ Tổ Hùng Vương"),
    ("2025-04-30", "Ngày Giải phóng miền Nam"),
    ("2025-05-01", "Ngày Quốc tế Lao động"),
    ("2025-09-02", "Ngày Quốc khánh"),
)


def minutes_of_day(spark: SparkSession) -> DataFrame:
    minute = F.col("id")
    return spark.range(1440).select(
        F.floor(minute / 60).cast("int").alias("hour"), (minute % 60).cast("int").alias("minute")
    )


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def holidays(spark: SparkSession, names=HOLIDAY_NAMES) -> DataFrame:
    df = spark.createDataFrame(list(names), "day string, holiday_name string")
    return df.select(F.col("day").cast("date").alias("full_date"), "holiday_name")
