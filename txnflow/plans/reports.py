"""Report queries over the warehouse tables.

``facts`` and ``alerts`` are fact_txn and fact_alert.  Where a report looks at
a trailing hour, ``as_of`` stands for now.  Reports of a day or an hour open
only the folders of their days if the tables come with the column of the
folder, as ``Warehouse.dated_facts`` and ``dated_alerts`` do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions import date_key, local_time, percent
from txnflow.schemas import DETECTED_DATE, LOADED_DATE

FOLDERS = {"loaded_at": LOADED_DATE, "detected_at": DETECTED_DATE}


def _count(condition: Column | None = None) -> Column:
    return F.count("*") if condition is None else F.count_if(condition)


def on_day(column: str, day) -> Column:
    """Half-open range on the bare column, so files can be skipped by statistics."""
    start = F.lit(day).cast("date")
    return (F.col(column) >= start.cast("timestamp_ntz")) & (
        F.col(column) < F.date_add(start, 1).cast("timestamp_ntz")
    )


def trailing_hour(column: str, as_of) -> Column:
    return F.col(column) > local_time(as_of) - F.expr("interval 1 hour")


def of_day(rows: DataFrame, column: str, day) -> DataFrame:
    """Rows of a day, from its folder."""
    folder = FOLDERS[column]
    if folder in rows.columns:
        rows = rows.filter(F.col(folder) == date_key(F.lit(day).cast("date")))
    return rows.filter(on_day(column, day))


def of_last_hour(rows: DataFrame, column: str, as_of) -> DataFrame:
    """Rows of the trailing hour, from the folders of its day or days on."""
    folder = FOLDERS[column]
    if folder in rows.columns:
        rows = rows.filter(F.col(folder) >= date_key(local_time(as_of) - F.expr("interval 1 hour")))
    return rows.filter(trailing_hour(column, as_of))


# ---- end of day -------------------------------------------------------------


def end_of_day(facts: DataFrame, alerts: DataFrame, day) -> DataFrame:
    """One row; fraud_count is null on a day without transactions."""
    summary = of_day(facts, "loaded_at", day).agg(
        F.count("*").alias("total_txns"),
        F.coalesce(F.sum("amount"), F.lit(0).cast("bigint")).alias("total_amount_vnd"),
        F.sum(F.col("fraud_flag").cast("bigint")).alias("fraud_count"),
        F.countDistinct("channel").alias("channels_active"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    day_alerts = of_day(alerts, "detected_at", day).agg(F.count("*")).scalar()
    return summary.withColumn("alert_count", day_alerts)


# ---- dashboard --------------------------------------------------------------


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("value"))


def fraud_rate(facts: DataFrame) -> DataFrame:
    return facts.agg(percent(_count(F.col("fraud_flag")), F.count("*")).alias("value"))


def alert_latency(alerts: DataFrame, as_of) -> DataFrame:
    """Mean seconds from detection to creation over the trailing hour."""
    micros = latency_micros()
    return of_last_hour(alerts, "detected_at", as_of).agg(
        F.round(F.avg(micros) / 1e6, 2).alias("value")
    )


def latency_micros() -> Column:
    return F.unix_micros(F.col("created_at").cast("timestamp")) - F.unix_micros(
        F.col("detected_at").cast("timestamp")
    )


def clean_count(facts: DataFrame) -> DataFrame:
    return facts.filter(~F.col("fraud_flag")).agg(F.count("*").alias("value"))


def masking_violations(facts: DataFrame) -> DataFrame:
    return facts.filter(~F.col("account_masked").like("****%")).agg(F.count("*").alias("value"))


def volume_per_minute(facts: DataFrame, as_of=None, fraud_only: bool = False) -> DataFrame:
    rows = facts.filter("fraud_flag") if fraud_only else facts
    if as_of is not None:
        rows = of_last_hour(rows, "loaded_at", as_of)
    minute = F.date_trunc("minute", F.col("loaded_at")).cast("timestamp_ntz")
    return rows.groupBy(minute.alias("time")).agg(F.count("*").alias("value")).orderBy("time")


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy(F.col("rule_triggered").alias("metric"))
        .agg(F.count("*").alias("value"))
        .orderBy(F.desc("value"), "metric")
    )


def alerts_by_rule_severity(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("rule_triggered", "severity")
        .agg(F.count("*").alias("alert_count"))
        .orderBy(F.desc("alert_count"), "rule_triggered")
    )


def _fraud_split(facts: DataFrame, *keys: str) -> DataFrame:
    fraud = _count(F.col("fraud_flag"))
    return facts.groupBy(*keys).agg(
        F.count("*").alias("total"),
        fraud.alias("fraud"),
        percent(fraud, F.count("*")).alias("fraud_pct"),
    )


def volume_by_channel(facts: DataFrame) -> DataFrame:
    return _fraud_split(facts, "channel").orderBy(F.desc("total"), "channel")


def top_fraud_merchants(facts: DataFrame, n: int = 10) -> DataFrame:
    return (
        facts.filter("fraud_flag")
        .groupBy("merchant_id", "merchant_province")
        .agg(F.count("*").alias("fraud_count"))
        .orderBy(F.desc("fraud_count"), "merchant_id", "merchant_province")
        .limit(n)
    )


ALERT_COLUMNS = ("alert_id", "transaction_id", "rule_triggered", "severity", "detected_at")


def recent_alerts(alerts: DataFrame, n: int = 20, rule: str | None = None) -> DataFrame:
    rows = alerts if rule is None else alerts.filter(F.col("rule_triggered") == rule)
    return rows.select(*ALERT_COLUMNS).orderBy(F.desc("detected_at"), "alert_id").limit(n)


# ---- verification -----------------------------------------------------------


def recent_by_prefix(facts: DataFrame, *prefixes: str, n: int | None = 10) -> DataFrame:
    """Latest rows whose id starts with any prefix; all, oldest first, if n is None."""
    match = F.lit(False)
    for prefix in prefixes:
        match = match | F.col("transaction_id").startswith(prefix)
    rows = facts.filter(match).select(
        "transaction_id", "account_masked", "amount", "merchant_id", "merchant_province", "fraud_flag", "alert_id", "loaded_at"
    )
    if n is None:
        return rows.orderBy("loaded_at", "transaction_id")
    return rows.orderBy(F.desc("loaded_at"), "transaction_id").limit(n)


def by_id_pattern(facts: DataFrame, pattern: str) -> DataFrame:
    return facts.filter(F.col("transaction_id").like(pattern)).select("transaction_id", "fraud_flag", "alert_id")


def reconcile_alerts(facts: DataFrame, alerts: DataFrame) -> DataFrame:
    """Facts next to the alert of the same alert_id (unique on both sides)."""
    right = alerts.select("alert_id", "rule_triggered", "severity", "detected_at")
    return facts.filter(F.col("alert_id").isNotNull()).join(right, "alert_id").select(
        "transaction_id",
        "fraud_flag",
        F.col("alert_id").alias("txn_alert_id"),
        F.col("alert_id").alias("alert_table_id"),
        "rule_triggered",
        "severity",
        "detected_at",
    )


# ---- star joins -------------------------------------------------------------


def fraud_by_calendar(facts: DataFrame, calendar: DataFrame, *keys: str) -> DataFrame:
    """``calendar`` has a row per day, so it stays small whatever the facts."""
    days = calendar.select("date_id", *keys)
    return _fraud_split(facts.join(F.broadcast(days), "date_id"), *keys)


def fraud_by_time(facts: DataFrame, minutes: DataFrame, *keys: str) -> DataFrame:
    """``minutes`` has 1,440 rows."""
    return _fraud_split(facts.join(F.broadcast(minutes.select("time_id", *keys)), "time_id"), *keys)


def fraud_by_segment(enriched: DataFrame) -> DataFrame:
    return _fraud_split(enriched, "segment")


def activity_per_day(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every calendar day with its transaction count."""
    counts = facts.groupBy("date_id").agg(F.count("*").alias("txns"))
    return calendar.join(counts, "date_id", "left").fillna(0, ["txns"])


def activity_per_minute_of_day(facts: DataFrame, minutes: DataFrame) -> DataFrame:
    counts = facts.groupBy("time_id").agg(F.count("*").alias("txns"))
    return minutes.join(counts, "time_id", "left").fillna(0, ["txns"])


# ---- dataset summary --------------------------------------------------------


def dataset_summary(txn: DataFrame) -> DataFrame:
    """One row over labelled transactions with their context flags."""
    label = F.col("fraud_label").cast("bigint")
    flag = lambda name: F.col(name).cast("bigint")
    return txn.agg(
        F.count("*").alias("total_transactions"),
        F.sum(label).alias("fraud_transactions"),
        F.round(F.avg(label) * 100, 2).alias("fraud_pct"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.round(F.avg(F.when(label == 0, F.col("amount"))), 0).alias("mean_amount_normal"),
        F.round(F.avg(F.when(label == 1, F.col("amount"))), 0).alias("mean_amount_fraud"),
        F.sum(flag("is_peak_hour")).alias("peak_hour_txns"),
        F.round(F.avg(flag("is_peak_hour")) * 100, 1).alias("peak_hour_pct"),
        F.sum(flag("is_business_hour")).alias("business_hour_txns"),
        F.round(F.avg(flag("is_business_hour")) * 100, 1).alias("business_hour_pct"),
    )


def share_of(txn: DataFrame, key: str) -> DataFrame:
    """Count and percentage per value."""
    counts = txn.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total, 1))


def hour_label_matrix(txn: DataFrame) -> DataFrame:
    return (
        txn.groupBy(F.hour("event_ts").alias("hour"))
        .pivot("fraud_label", [0, 1])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .select("hour", F.col("0").alias("normal"), F.col("1").alias("fraud"))
    )


def amount_histogram(txn: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins between each label's own smallest and largest amount.

    The last bin is closed.  Equal amounts get the unit range around them.
    """
    amounts = txn.select("fraud_label", F.col("amount").cast("double").alias("amount"))
    spans = amounts.groupBy("fraud_label").agg(F.min("amount").alias("lo"), F.max("amount").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    spans = spans.select(
        "fraud_label",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.least(F.floor((F.col("amount") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    # One row per label.
    return (
        amounts.join(F.broadcast(spans), "fraud_label")
        .groupBy("fraud_label", bin_no.alias("bin"))
        .agg(F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        .select("fraud_label", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"), "n")
    )


def fraud_samples(txn: DataFrame, kind: str, k: int, one_account: bool = True) -> DataFrame:
    """First k rows by time of one labelled kind, for its first account or for all."""
    rows = txn.filter((F.col("fraud_label") == 1) & (F.col("fraud_type") == kind))
    account = rows.agg(F.min_by("account_masked", F.struct("timestamp", "transaction_id"))).scalar()
    return (
        (rows.filter(F.col("account_masked") == account) if one_account else rows)
        .select("timestamp", "transaction_id", "account_masked", "amount", "merchant_province")
        .orderBy("timestamp", "transaction_id")
        .limit(k)
    )


# ---- operations -------------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [t.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name, t in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def error_rate(validated: DataFrame) -> DataFrame:
    bad = _count(F.size("error_reasons") > 0)
    return validated.agg(
        F.count("*").alias("total"),
        bad.alias("dead_letters"),
        F.round(100.0 * bad.cast("double") / F.nullif(F.count("*"), F.lit(0)).cast("double"), 4).alias("error_pct"),
    )


def latency_percentiles(alerts: DataFrame) -> DataFrame:
    """p50 and p95 seconds, each a value that occurs, within 1e-5 of its rank.

    The sketch has a fixed size; an exact percentile would hold every distinct
    latency in one task.
    """
    at = lambda p: F.round(F.percentile_approx(latency_micros(), p, 100_000) / 1e6, 3)
    return alerts.agg(at(0.5).alias("p50_s"), at(0.95).alias("p95_s"))


def load_completeness(facts: DataFrame, prefix: str, expected: int | None = None) -> DataFrame:
    """Rows with an id prefix, the span they were loaded in, and rows per second."""
    seconds = (
        F.unix_micros(F.max("loaded_at").cast("timestamp")) - F.unix_micros(F.min("loaded_at").cast("timestamp"))
    ) / 1e6
    out = facts.filter(F.col("transaction_id").startswith(prefix)).agg(
        F.count("*").alias("arrived"),
        F.round(seconds, 3).alias("elapsed_s"),
        F.round(F.count("*") / F.nullif(seconds, F.lit(0.0)), 4).alias("rows_per_s"),
    )
    if expected is not None:
        out = out.withColumn("complete", F.col("arrived") >= expected)
    return out


def quality_report(txn: DataFrame) -> DataFrame:
    """One row of pass/fail checks over labelled channel records."""
    rate = F.avg(F.col("fraud_label").cast("double"))
    checks = {
        "account_prefix_ok": F.bool_and(F.col("account_number").startswith("VCB")),
        "masking_ok": F.bool_and(F.col("account_masked").startswith("****")),
        "transaction_id_ok": F.bool_and(F.col("transaction_id").isNotNull()),
        "amount_ok": F.bool_and(F.col("amount") > 0),
        "fraud_rate_ok": rate.between(0.01, 0.05),
    }
    return txn.agg(*[check.alias(name) for name, check in checks.items()])


# Fixed values: (at least, status), highest first, per indicator.
KPI_LEVELS = {
    "alerts": ((1, "red"),),
    "fraud_rate": ((5, "red"), (1, "orange")),
    "alert_latency": ((5, "red"), (3, "orange")),
    "masking_violations": ((1, "red"),),
    "error_rate": ((1, "red"),),
}


def kpi_status(facts: DataFrame, alerts: DataFrame, validated: DataFrame, as_of) -> DataFrame:
    """(kpi, value, status), each table read once."""
    from_facts = facts.agg(
        percent(_count(F.col("fraud_flag")), F.count("*")).alias("fraud_rate"),
        _count(~F.col("account_masked").like("****%")).cast("double").alias("masking_violations"),
    )
    recent = F.when(trailing_hour("detected_at", as_of), latency_micros())
    from_alerts = alerts.agg(
        F.count("*").cast("double").alias("alerts"), F.round(F.avg(recent) / 1e6, 2).alias("alert_latency")
    )
    from_errors = error_rate(validated).select(F.col("error_pct").alias("error_rate"))
    rows = None
    for table in (from_facts, from_alerts, from_errors):
        part = table.unpivot([], table.columns, "kpi", "value")
        rows = part if rows is None else rows.unionByName(part)
    status = F.lit("green")
    for kpi, levels in KPI_LEVELS.items():
        for floor, name in reversed(levels):
            status = F.when((F.col("kpi") == kpi) & (F.col("value") >= floor), name).otherwise(status)
    return rows.withColumn("status", status)
