"""Channel files, dimension files and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.schemas import (
    CSV_CHANNELS,
    CUSTOMER_CSV,
    DIM_CUSTOMER,
    GENERATED_TXN,
    JSON_CHANNELS,
    MERCHANT_CSV,
    TEXT_TXN,
)


def read_csv(spark: SparkSession, path: str, schema, rows: int | None = None) -> DataFrame:
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return df.limit(rows) if rows is not None else df


def read_text_csv(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """Message fields as text, columns matched by header name."""
    df = spark.read.csv(path, header=True)
    df = df.select(*[F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in TEXT_TXN.names])
    return df.limit(rows) if rows is not None else df


def read_json_array(spark: SparkSession, path: str, schema=GENERATED_TXN) -> DataFrame:
    """A pretty-printed JSON array per file; files are read in parallel, not split."""
    return spark.read.json(path, schema=schema, multiLine=True)


def read_json_lines(spark: SparkSession, path: str, schema=GENERATED_TXN) -> DataFrame:
    return spark.read.json(path, schema=schema)


def channel_path(folder: str, channel: str) -> str:
    suffix = "csv" if channel in CSV_CHANNELS else "json"
    return f"{folder}/txn_{channel.lower()}.{suffix}"


def read_channel_files(spark: SparkSession, folder: str, arrays: bool = True) -> dict[str, DataFrame]:
    """One table per channel; ``arrays`` tells JSON arrays from JSON lines."""
    read_json = read_json_array if arrays else read_json_lines
    tables = {c: read_csv(spark, channel_path(folder, c), GENERATED_TXN) for c in CSV_CHANNELS}
    return tables | {c: read_json(spark, channel_path(folder, c)) for c in JSON_CHANNELS}


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CUSTOMER_CSV).select(*DIM_CUSTOMER.names)


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, MERCHANT_CSV)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options):
    """A warehouse table read in ``parts`` ranges of a numeric key."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options
    )
