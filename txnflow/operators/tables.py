"""Writing warehouse tables without a transactional table format.

Appended tables (facts, alerts, dead letters) are made idempotent by an
anti-join on their key.  Tables that change in place (dimensions) are written as numbered versions; a version
without its success marker is never read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.operators.normalise import type_rows
from txnflow.schemas import CSV_CHANNELS, JSON_CHANNELS, MESSAGE_FIELDS
from txnflow.session import COMPRESSION, GZIP, by_shuffle
from txnflow.sources.files import channel_path


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on any file system Spark can reach; [] if absent."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def has_data(spark: SparkSession, path: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in _names(spark, path))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    if has_data(spark, path):
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return spark.createDataFrame([], schema)


# ---- appended tables --------------------------------------------------------


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the first by ``order``, or by content."""
    ranking = Window.partitionBy(key).orderBy(*(order or df.columns))
    return df.withColumn("_n", F.row_number().over(ranking)).filter("_n = 1").drop("_n")


def absent_rows(
    incoming: DataFrame,
    path: str,
    key: str,
    partition: str | None = None,
    prune: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Incoming rows, one per key, whose key the table does not hold yet.

    ``unique`` says that incoming has one row per key already.  ``prune`` looks
    only at the partitions the batch touches.  That is exact when a key always
    comes with the same partition value, as a message sent again with its own
    timestamp does.
    """
    spark = incoming.sparkSession
    rows = incoming if unique else first_per_key(incoming, key)
    if not has_data(spark, path):
        return rows
    existing = spark.read.parquet(path)
    if partition and prune:
        # One value per calendar day in the batch.
        touched = [r[0] for r in incoming.select(partition).distinct().collect()]
        existing = existing.filter(F.col(partition).isin(touched))
    return rows.join(by_shuffle(existing.select(key)), key, "left_anti")


def rebalanced(rows: DataFrame, partition: tuple[str, ...], made: dict[str, Column] | None = None) -> DataFrame:
    """Rows dealt so that a partition value has few, evenly sized files; a large one is split.

    ``made`` are columns that the tasks that write make of the others, so that they are not shuffled.
    """
    made = made or {}
    dealt = rows.drop(*made).hint("rebalance", *partition)
    return dealt.withColumns(made).select(*rows.columns) if made else dealt


def append(rows: DataFrame, path: str, *partition: str, made: dict[str, Column] | None = None, without: tuple[str, ...] = ()) -> None:
    """Add rows to a table; columns ``without`` are read by ``made`` only."""
    if partition:
        rows = rebalanced(rows, partition, made).drop(*without)
        rows.write.partitionBy(*partition).parquet(path, mode="append", compression=COMPRESSION)
    else:
        rows.write.parquet(path, mode="append", compression=COMPRESSION)


def insert_if_absent(incoming: DataFrame, path: str, key: str, partition: str | None = None, **options) -> None:
    append(absent_rows(incoming, path, key, partition, **options), path, *([partition] if partition else []))


# ---- versioned tables -------------------------------------------------------


def current_version(spark: SparkSession, path: str) -> int | None:
    numbers = [int(m[1]) for n in _names(spark, path) if (m := re.fullmatch(r"v(\d+)", n))]
    done = [n for n in numbers if "_SUCCESS" in _names(spark, f"{path}/v{n}")]
    return max(done, default=None)


def read_current(spark: SparkSession, path: str, schema) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v{version}")


def write_version(df: DataFrame, path: str) -> int:
    version = (current_version(df.sparkSession, path) or 0) + 1
    df.write.parquet(f"{path}/v{version}", mode="overwrite")
    return version


def upsert(incoming: DataFrame, path: str, key: str, *order: str) -> int:
    """Insert, or replace every column of, the rows with the given keys."""
    latest = first_per_key(incoming, key, *order)
    existing = read_current(incoming.sparkSession, path, incoming.schema)
    kept = existing.join(by_shuffle(latest.select(key)), key, "left_anti")
    return write_version(kept.unionByName(latest), path)


def insert_new(incoming: DataFrame, path: str, key: str) -> int:
    """Insert rows with new keys, keep the others as they are."""
    existing = read_current(incoming.sparkSession, path, incoming.schema)
    new = first_per_key(incoming, key).join(by_shuffle(existing.select(key)), key, "left_anti")
    return write_version(existing.unionByName(new), path)


# ---- files ------------------------------------------------------------------


def export_channels(rows: DataFrame, folder: str) -> None:
    """CSV for ATM and POS, JSON lines for mobile and internet, one CSV of all; gzip, which readers tell by the names.

    The combined table is sorted by time in ranges, not in one task.
    """
    how = {"mode": "overwrite", "compression": "gzip"}
    for channel in CSV_CHANNELS:
        rows.filter(F.col("channel") == channel).write.csv(channel_path(folder, channel), header=True, **how)
    for channel in JSON_CHANNELS:
        rows.filter(F.col("channel") == channel).write.json(channel_path(folder, channel), **how)
    rows.orderBy("timestamp", "transaction_id").write.csv(f"{folder}/txn_all.csv", header=True, **how)


def archive_raw(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Raw records as JSON (gzip), by event date and channel."""
    dated = rows.withColumn("event_date", F.to_date("event_ts"))
    message = [c for c in rows.columns if c in MESSAGE_FIELDS and c != "channel"]
    dated.select("event_date", "channel", *message).hint("rebalance", "event_date", "channel").write.partitionBy(
        "event_date", "channel"
    ).options(**GZIP).json(path, mode=mode)


def load_staging(text: DataFrame, path: str, rejects_path: str) -> None:
    """Truncate and load the staging table; rows that fail go to the rejects."""
    typed = type_rows(text)
    typed.filter(F.size("errors") == 0).drop("errors").write.parquet(path, mode="overwrite")
    typed.filter(F.size("errors") > 0).write.parquet(rejects_path, mode="overwrite")


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
