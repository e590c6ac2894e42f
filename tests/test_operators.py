import contextlib
import io
import json
import os
from datetime import datetime

import pytest
from helpers import T0, frame, txn
from pyspark.sql import functions as F

from txnflow import functions as fn
from txnflow.config import DEFAULT_RULES, load_rule_config
from txnflow.operators import context, dims, enrich, facts, normalise, rules, tables, validate
from txnflow.operators.rules import apply_cascade
from txnflow.plans import reports
from txnflow.schemas import DIM_CUSTOMER, FACT_ALERT, FACT_TXN, MESSAGE_FIELDS
from txnflow.session import scratch_table
from txnflow.sources import files, messages


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return row.select(column.alias("x")).first()[0]


def test_masks(spark):
    assert one(spark, fn.mask_account("a"), a="VCB1234567890") == "****7890"
    assert one(spark, fn.mask_phone("a"), a="0901 234-567") == "090****567"
    assert one(spark, fn.mask_national_id("a"), a="012345678901") == "012******901"
    assert one(spark, fn.token_account("a"), a="VCB1").startswith("****")


def test_json_field(spark):
    assert one(spark, fn.json_field("a", "id"), a='[{"id": "x"}, {"id": "y"}]') == "x"
    assert one(spark, fn.json_field("a", "id"), a='{"id": 7}') == "7"
    assert one(spark, fn.json_field("a", "id"), a="{}") == ""


def test_distance(spark):
    km = fn.haversine_km(*[F.lit(v) for v in (21.0278, 105.8342, 10.8231, 106.6297)])
    assert round(one(spark, km), 3) == 1137.884
    assert one(spark, fn.format_km(km)) == "1137.9"
    assert one(spark, fn.haversine_km(*[F.lit(v) for v in (0.0, 0.0, 0.0, 180.0)])) == pytest.approx(20015.087, abs=0.01)


@pytest.mark.parametrize(
    "text, want",
    [
        ("2025-03-01T22:10:05", datetime(2025, 3, 1, 22, 10, 5)),
        ("2025-03-01T22:10:05.250", datetime(2025, 3, 1, 22, 10, 5, 250000)),
        ("2025-03-01T22:10:05+00:00", datetime(2025, 3, 1, 22, 10, 5)),
        ("2025-03-01T22:10:05+07:00", datetime(2025, 3, 1, 15, 10, 5)),
        ("soon", None),
    ],
)
def test_timestamps(spark, text, want):
    assert one(spark, fn.parse_timestamp("a"), a=text) == want


def test_local_time(spark):
    at = datetime(2025, 3, 1, 22, 10, 5, 250000)
    for value in (at, at.isoformat(), F.lit(at.isoformat())):
        assert one(spark, fn.local_time(value)) == at


def test_context_predicates(spark):
    days = ["2025-01-28T08:00:00", "2025-03-02T03:59:00", "2025-03-02T04:00:00", "2025-03-03T17:59:00", "2025-03-03T12:00:00"]
    rows = frame(spark, [txn(f"{i}", at=datetime.fromisoformat(d)) for i, d in enumerate(days)])
    got = {r["transaction_id"]: r for r in context.tag_context(rows).collect()}
    assert [got[str(i)]["is_holiday"] for i in range(5)] == [True, False, False, False, False]
    assert [got[str(i)]["is_maintenance"] for i in range(5)] == [False, True, False, False, False]
    assert [got[str(i)]["is_business_hour"] for i in range(5)] == [True, False, False, True, True]
    assert [got[str(i)]["is_peak_hour"] for i in range(5)] == [True, False, False, False, False]


def test_rule_document(spark):
    path = scratch_table(spark, "rules") + ".json"
    doc = {
        "peak_hours": [9],
        "business_hours": {"start": 7, "end": 16},
        "night_hours": {"start": 23, "end": 5},
        "maintenance_windows": [{"day_of_week": 5, "start_hour": 0, "end_hour": 1}],
        "holidays_2025": ["2025-01-01"],
        "thresholds": {"velocity_count": 4, "geo_anomaly_km": 100},
    }
    spark.createDataFrame([(json.dumps(doc, indent=1),)], "value string").coalesce(1).write.text(path)
    cfg = load_rule_config(spark, path)
    assert (cfg.velocity_count, cfg.geo_anomaly_km, cfg.peak_hours, cfg.night_start) == (4, 100, (9,), 23)
    assert (cfg.maintenance_weekday, cfg.holidays, cfg.duplicate_window_seconds) == (5, ("2025-01-01",), 30)


def parsed(spark, *texts):
    return messages.parse(spark.createDataFrame([(None, t) for t in texts], "key string, value string"))


def test_messages(spark):
    good = txn("G1")
    bad = {k: good[k] for k in ("transaction_id", "timestamp", "account_masked", "channel")}
    texts = {
        "object": json.dumps(good),
        "array": json.dumps([txn("G2"), txn("G3")], indent=1),
        "bad": json.dumps(bad),
        "cut": json.dumps(good)[:40],
        "fraction": json.dumps(txn("G4", amount=12.5)),
        "tiny": json.dumps({**txn("G7"), "amount": "1.0000000001"}),
        "whole": json.dumps(txn("G5", amount=12.0)),
        "blank": json.dumps(txn("G6", account="")),
        "empty_array": "[]",
    }
    rows = validate.validate(parsed(spark, *texts.values())).collect()
    names = [n for name in texts for n in ((name, "second") if name == "array" else (name,))]
    got = {name: (r["transaction_id"], r["amount"], r["error_reasons"]) for name, r in zip(names, rows, strict=True)}
    assert got["object"] == ("G1", 5_000_000, [])
    assert got["array"] == ("G2", 5_000_000, []) and got["second"] == ("G3", 5_000_000, [])
    assert got["bad"] == ("G1", None, ["amount", "currency", "status"])
    assert got["cut"][0] is None and got["cut"][2][0] == "json"
    assert got["fraction"][2] == got["tiny"][2] == ["amount"]
    assert got["whole"] == ("G5", 12, [])
    assert got["blank"][2] == ["account_masked"]
    assert "transaction_id" in got["empty_array"][2]


def test_redelivered_messages_count_once(spark):
    rows = frame(spark, [txn("A", 0), txn("A", 0), txn("A", 5), txn("B", 0)])
    kept = validate.dedupe_transactions(rows).collect()
    assert sorted((r["transaction_id"], r["event_ts"]) for r in kept) == [("A", T0), ("B", T0)]


def test_normalise_drops_clear_columns(spark):
    rows = frame(spark, [txn("A")]).withColumn("account_number", F.lit("VCB1")).drop("fraud_type")
    out = normalise.normalise(rows.withColumnRenamed("amount", "amt"), {"amt": "amount"})
    assert out.columns == MESSAGE_FIELDS
    row = out.first()
    assert row["amount"] == 5_000_000 and row["fraud_type"] is None


def test_files(spark):
    folder = scratch_table(spark, "files")
    array = json.dumps([txn("J1"), txn("J2")], indent=2)
    spark.createDataFrame([(array,)], "value string").coalesce(1).write.text(f"{folder}/txn_mobile.json")
    read = files.read_json_array(spark, f"{folder}/txn_mobile.json")
    assert {r["transaction_id"] for r in read.collect()} == {"J1", "J2"}
    frame(spark, [txn(f"C{i}") for i in range(5)]).drop("event_ts").write.csv(f"{folder}/c", header=True)
    text = files.read_text_csv(spark, f"{folder}/c")
    assert text.columns == MESSAGE_FIELDS and text.count() == 5
    assert files.read_text_csv(spark, f"{folder}/c", rows=2).count() == 2


def test_exported_channels_are_small_and_come_back_whole(spark):
    folder = scratch_table(spark, "channels")
    rows = [txn(f"T{i:04d}", i, channel=c, merchant_province="Ha Noi, Nội Bài") for i in range(200) for c in ("ATM", "mobile")]
    rows = frame(spark, rows).drop("event_ts")
    tables.export_channels(rows, folder)
    for name, n in (("txn_atm.csv", 200), ("txn_mobile.json", 200), ("txn_all.csv", 400)):
        parts = [f for f in os.listdir(f"{folder}/{name}") if f.startswith("part")]
        assert parts and all(f.endswith(f".{name[-4:].lstrip('.')}.gz") for f in parts)
        read = spark.read.json if name.endswith("json") else lambda path: spark.read.csv(path, header=True)
        back = read(f"{folder}/{name}")
        assert back.count() == n
        assert {r[0] for r in back.select("merchant_province").collect()} == {"Ha Noi, Nội Bài"}


def test_kafka_options():
    options = messages.kafka_options("b:9092", messages.RAW_TOPIC, per_trigger=500)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "500"


def customers(spark, ids, score=10):
    rows = [(i, "****1", "VIP", score, "Hue", None, None) for i in ids]
    return spark.createDataFrame(rows, DIM_CUSTOMER)


@pytest.mark.parametrize("limit", [enrich.BROADCAST_BYTES, -1])
def test_lookup_with_hot_null_and_missing_keys(spark, limit):
    rows = [txn(f"H{i}", customer_id="hot") for i in range(2000)]
    rows += [txn(f"N{i}", customer_id=None) for i in range(500)]
    rows += [txn(f"C{i}", customer_id=f"c{i}") for i in range(300)]
    dim = customers(spark, ["hot"] + [f"c{i}" for i in range(200)])
    out = enrich.enrich_customers(frame(spark, rows), dim, broadcast_bytes=limit)
    counts = {
        (r["k"], r["segment"]): r["count"]
        for r in out.groupBy(F.left("transaction_id", F.lit(1)).alias("k"), "segment").count().collect()
    }
    assert counts == {("H", "VIP"): 2000, ("N", None): 500, ("C", "VIP"): 200, ("C", None): 100}
    assert out.filter("account_masked <> '****0001'").count() == 0


def test_lookup_of_judged_rows_moves_them_once(spark):
    """Only ids and keys go to a large dimension; the rows of the cascade are neither computed twice nor shuffled by key."""
    rows = [txn(f"H{i}", customer_id="hot") for i in range(300)] + [txn(f"N{i}", customer_id=None) for i in range(50)]
    rows = frame(spark, rows + [txn(f"C{i}", customer_id=f"c{i}") for i in range(300)])
    dim = customers(spark, ["hot"] + [f"c{i}" for i in range(200)])
    judged = apply_cascade(rows)
    plain = enrich.enrich_customers(judged, dim, broadcast_bytes=-1)
    out = enrich.enrich_customers(judged, dim, broadcast_bytes=-1, source=rows)
    columns = plain.columns
    assert sorted(map(str, out.select(columns).collect())) == sorted(map(str, plain.collect()))
    with contextlib.redirect_stdout(io.StringIO()) as text:
        out.explain("formatted")
    moved = [part for part in text.getvalue().split("\n\n") if ") Exchange\n" in part and "merchant_province" in part]
    assert len(moved) == 1 and "hashpartitioning(transaction_id" in moved[0]


def test_upsert_and_insert_new(spark):
    path = scratch_table(spark, "dim")
    read = lambda: {r["customer_id"]: r["risk_score"] for r in tables.read_current(spark, path, DIM_CUSTOMER).collect()}
    tables.upsert(customers(spark, ["a", "b"]), path, "customer_id")
    tables.upsert(customers(spark, ["b", "c"], 20), path, "customer_id")
    assert read() == {"a": 10, "b": 20, "c": 20}
    tables.insert_new(customers(spark, ["c", "d"], 30), path, "customer_id")
    assert read() == {"a": 10, "b": 20, "c": 20, "d": 30}
    # A version without its marker is not read.
    customers(spark, ["z"]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/v9")
    assert "z" not in read()


@pytest.mark.parametrize("options", [{}, {"partition": "day"}, {"partition": "day", "prune": True}])
def test_insert_if_absent(spark, options):
    path = scratch_table(spark, "facts")
    make = lambda ids: spark.createDataFrame([(i, i % 3) for i in ids], "id long, day long")
    for ids in (range(10), range(5, 15), range(5, 15)):
        tables.insert_if_absent(make([*ids, *ids]), path, "id", **options)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(15))


def test_facts_and_alerts(spark):
    rows = frame(spark, [txn(f"v{i}", i, amount=1000 + i) for i in range(3)] + [txn("n", at=datetime(2025, 3, 3, 23, 30), account="x", amount=60_000_000)])
    rows = rows.withColumn("loaded_at", F.col("event_ts"))
    scored = rules.apply_cascade(rows)
    table = {r["transaction_id"]: r for r in facts.fact_txn(scored).collect()}
    assert facts.fact_txn(scored).columns == FACT_TXN.names
    assert [table[k]["fraud_flag"] for k in ("v0", "v1", "v2", "n")] == [False, False, True, True]
    assert table["n"]["time_id"] == 2330 and table["n"]["date_id"] == 20250303
    alerts = {r["transaction_id"]: r for r in facts.fact_alert(scored).collect()}
    assert facts.fact_alert(scored).columns == FACT_ALERT.names
    assert {k: (a["rule_triggered"], a["severity"]) for k, a in alerts.items()} == {
        "v2": ("velocity", "MEDIUM"),
        "n": ("off_hours_large", "HIGH"),
    }
    assert alerts["v2"]["alert_id"] == table["v2"]["alert_id"]
    ids = [row.x for t in ("T553903", "T11535750") for row in spark.range(1).select(fn.alert_id("off_hours_large", F.lit(t)).alias("x")).collect()]
    assert ids[0] != ids[1]  # their first 48 bits are equal
    cfg = DEFAULT_RULES.with_options(off_hours_marks_fact=False)
    plain = {r["transaction_id"]: r for r in facts.fact_txn(scored, cfg).collect()}
    assert (plain["n"]["fraud_flag"], plain["n"]["alert_id"], plain["v2"]["fraud_flag"]) == (False, None, True)


def test_dimensions(spark):
    minutes = {r["time_id"]: r for r in dims.dim_time(spark).collect()}
    assert len(minutes) == 1440
    assert minutes[1259]["is_peak_hour"] is False and minutes[1659]["is_business_hour"] and not minutes[1700]["is_business_hour"]
    days = {r["date_id"]: r for r in dims.dim_calendar(spark).collect()}
    assert len(days) == 1096 and sum(d["is_holiday"] for d in days.values()) == 12
    assert days[20250302]["day_of_week"] == 6 and days[20250302]["is_maintenance"]


def test_empty_day(spark):
    house = [spark.createDataFrame([], s) for s in (FACT_TXN, FACT_ALERT)]
    row = reports.end_of_day(*house, "2025-01-01").first()
    assert (row["total_txns"], row["total_amount_vnd"], row["fraud_count"], row["alert_count"]) == (0, 0, None, 0)
    assert reports.fraud_rate(house[0]).first()["value"] is None


def test_histogram_of_equal_amounts(spark):
    rows = frame(spark, [txn(f"{i}", amount=7) for i in range(4)])
    assert [(r["bin"], r["n"]) for r in reports.amount_histogram(rows).collect()] == [(25, 4)]


def test_day_filter_reaches_the_scan(spark, sf_dir):
    path = scratch_table(spark, "facts")
    spark.createDataFrame([], FACT_TXN).write.parquet(path)
    table = spark.read.schema(FACT_TXN).parquet(path)
    plan = reports.end_of_day(table, spark.createDataFrame([], FACT_ALERT), "2025-01-01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(loaded_at" in text and "LessThan(loaded_at" in text
    assert "account_masked" not in text
