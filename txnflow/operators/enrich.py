"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.session import by_shuffle

BROADCAST_BYTES = 10 * 1024 * 1024
HOT_SHARE = 1000
SALTS = 4096

CUSTOMER_COLUMNS = ("segment", "risk_score", "home_province", "home_lat", "home_lon")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: of files, their size on disk; unknown is huge."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    spread: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    source: DataFrame | None = None,
) -> DataFrame:
    """Left join to a dimension with one row per ``key``.

    A dimension estimated within ``broadcast_bytes`` is broadcast.  A larger
    one is joined by shuffle, except for keys holding more than 1/1000 of the
    rows: there are under 1000 of those, so their dimension rows are broadcast
    and the rows they match are spread by ``spread``, a column of many values.
    Null keys, which match nothing, are spread the same way.

    ``source`` is what ``rows`` were made of: the same values of ``spread``, each once, with the same keys, but cheap to
    read again.  Then only these two columns are shuffled by key, and ``rows`` meet what they found by ``spread``.
    """
    if estimated_bytes(dim) <= broadcast_bytes:
        return rows.join(F.broadcast(dim), key, "left")
    if source is not None:
        pairs = source.filter(F.col(key).isNotNull()).select(spread, key)
        found = lookup(pairs, dim.withColumn("_found", F.lit(True)), key, spread, broadcast_bytes)
        return rows.join(by_shuffle(found.filter("_found").drop("_found", key)), spread, "left")
    added = [c for c in dim.columns if c != key]
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot_keys = counts.filter(F.col("_n") * HOT_SHARE > total).select(key)
    hot = dim.join(F.broadcast(hot_keys), key, "left_semi").select(key, F.struct(*added).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    # Dimension rows have salt 0, so rows set apart are spread and match nothing.
    salt = F.when(apart, F.pmod(F.xxhash64(spread), F.lit(SALTS)) + 1).otherwise(0)
    cold = dim.select(key, F.lit(0).cast("bigint").alias("_salt"), F.struct(*added).alias("_cold"))
    joined = marked.withColumn("_salt", salt.cast("bigint")).join(cold, [key, "_salt"], "left")
    values = [F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cold.{c}")).alias(c) for c in added]
    return joined.select(*rows.columns, *values)


def enrich_customers(rows: DataFrame, customers: DataFrame, **options) -> DataFrame:
    """Add customer attributes; unmatched rows stay, with nulls.

    The message's own account_masked wins over the dimension's.
    """
    dim = customers.select("customer_id", *CUSTOMER_COLUMNS)
    return lookup(rows, dim, "customer_id", spread="transaction_id", **options)
