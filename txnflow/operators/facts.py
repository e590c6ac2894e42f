"""Star-schema rows from scored transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.config import DEFAULT_RULES, OFF_HOURS, RuleConfig
from txnflow.functions import date_key, time_key
from txnflow.schemas import AUDIT_LOG, FACT_ALERT, FACT_TXN


def fact_txn(scored: DataFrame, cfg: RuleConfig = DEFAULT_RULES, *extra: str) -> DataFrame:
    """Expects event_ts, loaded_at and the cascade's columns; ``extra`` ones follow as they are."""
    flagged = F.col("fraud_flag")
    if not cfg.off_hours_marks_fact:
        flagged = flagged & (F.col("rule_triggered") != OFF_HOURS)
    values = {
        "currency": F.coalesce("currency", F.lit("VND")),
        "fraud_flag": F.coalesce(flagged, F.lit(False)),
        "alert_id": F.when(flagged, F.col("alert_id")),
        "time_id": time_key("event_ts"),
        "date_id": date_key("event_ts"),
    }
    return scored.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FACT_TXN.fields], *extra
    )


def fact_alert(scored: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One row per fired transaction; detected at the event, created at load."""
    values = {
        "detected_at": F.col("event_ts"),
        "resolved_at": F.lit(None),
        "created_at": F.col("loaded_at") if created_at is None else created_at,
    }
    return scored.filter("fraud_flag").select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FACT_ALERT.fields]
    )


def alert_messages(scored: DataFrame) -> DataFrame:
    """The whole flagged record as key/value JSON for the alert topic."""
    fired = scored.filter("fraud_flag")
    body = F.to_json(F.struct(*[c for c in fired.columns if c not in ("key", "value")]))
    return fired.select(F.lit(None).cast("string").alias("key"), body.alias("value"))


def audit_log(scored: DataFrame) -> DataFrame:
    """One row per stage a record passed."""
    step = lambda stage, event: F.struct(F.lit(stage).alias("processor_name"), event.alias("event_type"))
    fixed = {"consume": "RECEIVE", "validate": "ROUTE", "normalise": "CONTENT_MODIFIED"}
    steps = [step(stage, F.lit(fixed[stage])) for stage in ("consume", "validate", "normalise")]
    matched = F.when(F.col("segment").isNotNull(), "MATCHED").otherwise("UNMATCHED")
    steps += [
        step("lookup_customer", matched),
        step("score_rules", F.coalesce("rule_triggered", F.lit("PASS"))),
        step("load_fact_txn", F.lit("SEND")),
    ]
    alert = F.when(F.col("fraud_flag"), F.array(step("publish_alert", F.lit("SEND")), step("load_fact_alert", F.lit("SEND"))))
    nothing = F.array().cast("array<struct<processor_name:string,event_type:string>>")
    passed = F.concat(F.array(*steps), F.coalesce(alert, nothing))
    return (
        scored.select(F.col("transaction_id").alias("txn_id"), F.col("loaded_at").alias("logged_at"), F.inline(passed))
        .withColumn("flowfile_uuid", F.md5(F.concat_ws("|", "txn_id", "processor_name")))
        .select(*AUDIT_LOG.names)
    )
