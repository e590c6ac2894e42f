"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from txnflow.config import DEFAULT_RULES, GEO_ORDER
from txnflow.operators import rules
from txnflow.plans import catalogue
from txnflow.plans.batch import Warehouse, run_batch
from txnflow.session import local_session, scratch_table
from txnflow.sources.demo import customers, transactions

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
WITH_GEO = DEFAULT_RULES.with_options(rule_order=GEO_ORDER)
REPORTS = (
    "eod_report",
    "total_transactions",
    "total_alerts",
    "fraud_rate",
    "alert_latency",
    "clean_count",
    "masking_violations",
    "volume_per_minute",
    "fraud_per_minute",
    "alerts_by_rule",
    "recent_alerts",
    "volume_by_channel",
    "top_fraud_merchants",
    "alert_reconciliation",
    "holiday_fraud_rate",
    "segment_fraud_rate",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("txnflow-bench", CPUS, int(os.environ.get("BENCH_PARTITIONS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    txn = transactions(spark, SF_DIR)
    rows = txn.count()
    messages = catalogue.demo_messages(spark, SF_DIR).drop("event_ts")
    sent = scratch_table(spark, "messages")
    messages.write.parquet(sent)

    def load():
        house = Warehouse(spark, scratch_table(spark, "house"))
        house.seed(customers(spark, SF_DIR))
        run_batch(spark.read.parquet(sent), house)

    timed = {
        "cascade": lambda: run(rules.apply_cascade(txn)),
        "cascade_with_geo": lambda: run(rules.apply_cascade(txn, WITH_GEO)),
        "velocity_alerts": lambda: run(rules.velocity_alerts(txn)),
        "geo_anomaly_alerts": lambda: run(rules.geo_anomaly_alerts(txn)),
        "duplicate_alerts": lambda: run(rules.duplicate_alerts(txn)),
        "off_hours_alerts": lambda: run(rules.off_hours_alerts(txn)),
        "batch_load": load,
        "validate_records": lambda: run(catalogue.validate_records(spark, SF_DIR)),
        "staging_load": lambda: run(catalogue.staging_load(spark, SF_DIR)),
    }
    for name in REPORTS:
        timed[name] = lambda query=catalogue.QUERIES[name]: run(query(spark, SF_DIR))

    run(rules.apply_cascade(txn))
    catalogue.warehouse(spark, SF_DIR)
    seconds = {}
    for name, query in timed.items():
        start = time.perf_counter()
        query()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "transactions": rows,
                "cascade_rows_per_s": round(rows / seconds["cascade"]),
                "batch_rows_per_s": round(rows / seconds["batch_load"]),
            }
        )
    )


if __name__ == "__main__":
    main()
