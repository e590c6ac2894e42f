"""Transactions and customers derived from the benchmark tables.

``events`` is too sparse for sub-minute rules, so each event becomes a burst of
one to five transactions a few seconds apart; some bursts repeat the amount
(duplicates) and some change place (geo anomalies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.config import DUPLICATE, GEO, OFF_HOURS, VELOCITY
from txnflow.functions import mask_account, pad_id
from txnflow.operators.enrich import estimated_bytes
from txnflow.schemas import CHANNELS, SEGMENTS

# Provinces and their coordinates.
PROVINCES = (
    ("Ha Noi", 21.0278, 105.8342),
    ("Ho Chi Minh", 10.8231, 106.6297),
    ("Da Nang", 16.0544, 108.2022),
    ("Hai Phong", 20.8449, 106.6881),
    ("Can Tho", 10.0452, 105.7469),
    ("Bien Hoa", 10.9574, 106.8426),
    ("Hue", 16.4637, 107.5909),
    ("Nha Trang", 12.2388, 109.1967),
    ("Vung Tau", 10.3460, 107.0843),
    ("Quy Nhon", 13.7830, 109.2196),
    ("Buon Ma Thuot", 12.6667, 108.0500),
    ("Thai Nguyen", 21.5928, 105.8442),
    ("Nam Dinh", 20.4389, 106.1621),
)
#: Bytes of the events, as Spark estimates them, that one task makes transactions of: about 130,000 of these.
TASK_BYTES = 1 << 18
LABELS = (VELOCITY, GEO, OFF_HOURS, DUPLICATE)


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(table: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """The rows dealt to tasks by the size of their files.

    A scan has no more tasks with rows than the files have row groups, and files as narrow as ``events`` hold a million
    rows in one; each row becomes up to five of twenty times its width, which would be few tasks' work.
    """
    parts = estimated_bytes(table) // (task_bytes or TASK_BYTES)
    return table.repartition(parts) if parts > 1 else table


def transactions(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """The 14 message fields plus event_ts and loaded_at.

    ``wide`` says that each row becomes a text at once, so that the work to be spread is in the tasks that read.
    """
    eid, i, user = F.col("event_id"), F.col("i"), F.col("user_id")
    place = F.when(eid % 7 == 0, (user + i) % 13).otherwise(user % 13)
    number = eid * 5 + i
    labelled = eid % 29 == 0
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    bursts = (
        (spread(events) if wide else events)
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), eid % 5)))
        .withColumn(
            "event_ts",
            F.date_trunc("second", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
            + F.make_dt_interval(secs=(i * (7 + eid % 23)).cast("decimal(18,6)")),
        )
        .withColumn("place", place)
    )
    return bursts.select(
        pad_id("TXN", number, 10).alias("transaction_id"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        pad_id("****", user, 4).alias("account_masked"),
        pad_id("CUS", user + 1, 6).alias("customer_id"),
        _pick(CHANNELS, eid % 4).alias("channel"),
        pad_id("MER", eid % 500 + 1, 5).alias("merchant_id"),
        _pick([p[0] for p in PROVINCES], F.col("place")).alias("merchant_province"),
        _pick([p[1] for p in PROVINCES], F.col("place")).alias("merchant_lat"),
        _pick([p[2] for p in PROVINCES], F.col("place")).alias("merchant_lon"),
        (F.floor(F.col("value") * F.when(eid % 3 == 0, 1).otherwise(1 + i)) * 1_000_000)
        .cast("bigint")
        .alias("amount"),
        F.lit("VND").alias("currency"),
        F.lit("SUCCESS").alias("status"),
        labelled.cast("smallint").alias("fraud_label"),
        F.when(labelled, _pick(LABELS, F.floor(eid / 29) % 4)).alias("fraud_type"),
        F.col("event_ts"),
        (
            F.col("event_ts")
            + F.make_dt_interval(secs=((500 + number * 37 % 4500) / 1000).cast("decimal(18,6)"))
        ).alias("loaded_at"),
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer file layout, clear personal data included."""
    key = F.col("c_custkey")
    place = key % 13
    return read_table(spark, sf_dir, "customer").select(
        pad_id("CUS", key + 1, 6).alias("customer_id"),
        pad_id("VCB", key + 1_000_000_000, 10).alias("account_number"),
        pad_id("0", key * 7 + 900_000_000, 9).alias("phone"),
        pad_id("", key * 11 + 12_345_678_901, 12).alias("national_id"),
        F.col("c_name").alias("full_name"),
        _pick(SEGMENTS, key % 5).alias("segment"),
        (key % 90 + 10).cast("int").alias("risk_score"),
        _pick([p[0] for p in PROVINCES], place).alias("home_province"),
        _pick([p[1] for p in PROVINCES], place).cast("decimal(9,6)").alias("home_lat"),
        _pick([p[2] for p in PROVINCES], place).cast("decimal(9,6)").alias("home_lon"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dim_customer layout."""
    return customers_raw(spark, sf_dir).select(
        "customer_id",
        mask_account("account_number").alias("account_masked"),
        "segment",
        "risk_score",
        "home_province",
        "home_lat",
        "home_lon",
    )
