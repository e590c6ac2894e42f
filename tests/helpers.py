"""Rows for tests, and the rules told one row at a time."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from txnflow.config import DEFAULT_RULES, DUPLICATE, GEO, OFF_HOURS, VELOCITY
from txnflow.functions import parse_timestamp
from txnflow.schemas import RAW_TXN

T0 = datetime(2025, 3, 3, 12, 0, 0)
HA_NOI, HO_CHI_MINH = ("Ha Noi", 21.0278, 105.8342), ("Ho Chi Minh", 10.8231, 106.6297)


def txn(txn_id, seconds=0.0, account="****0001", amount=5_000_000, merchant="MER00001", place=HA_NOI, **other):
    at = other.pop("at", None) or T0 + timedelta(seconds=seconds)
    row = {
        "transaction_id": txn_id,
        "timestamp": at.isoformat(timespec="milliseconds"),
        "account_masked": account,
        "customer_id": "CUS000001",
        "channel": "ATM",
        "merchant_id": merchant,
        "merchant_province": place[0] if place else None,
        "merchant_lat": place[1] if place else None,
        "merchant_lon": place[2] if place else None,
        "amount": amount,
        "currency": "VND",
        "status": "SUCCESS",
        "fraud_label": 0,
        "fraud_type": None,
    }
    return {**row, **other}


def frame(spark, rows):
    values = [tuple(r[f] for f in RAW_TXN.fieldNames()) for r in rows]
    df = spark.createDataFrame(values, RAW_TXN)
    return df.withColumn("event_ts", parse_timestamp("timestamp"))


def _km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def simulate(rows, cfg=DEFAULT_RULES):
    """Verdict per transaction id, processing rows one by one in order."""
    times, places, anchors, out = {}, {}, {}, {}
    ms = lambda r: round((datetime.fromisoformat(r["timestamp"]) - datetime(1970, 1, 1)).total_seconds() * 1000)
    for r in sorted(rows, key=lambda r: (ms(r), r["transaction_id"])):
        now, account, verdict = ms(r), r["account_masked"], None
        for rule in cfg.rule_order:
            fired = False
            if rule == VELOCITY and account:
                kept = [t for t in times.get(account, []) if now - t <= cfg.velocity_ms] + [now]
                times[account] = kept
                fired = len(kept) >= cfg.velocity_count
            elif rule == GEO and account and r["merchant_lat"] is not None and r["merchant_lon"] is not None:
                here = (r["merchant_lat"], r["merchant_lon"])
                if account in places:
                    then, there = places[account]
                    fired = 0 < now - then <= cfg.geo_ms and _km(there, here) > cfg.geo_anomaly_km
                places[account] = (now, here)
            elif rule == DUPLICATE and account and r["amount"] is not None and r["merchant_id"]:
                key = (account, r["amount"], r["merchant_id"])
                fired = key in anchors and now - anchors[key] <= cfg.duplicate_ms
                if not fired:
                    anchors[key] = now
            elif rule == OFF_HOURS and r["amount"] is not None:
                hour = int(r["timestamp"][11:13])
                fired = r["amount"] > cfg.off_hours_large_txn_vnd and (
                    hour >= cfg.night_start or hour < cfg.night_end
                )
            if fired:
                verdict = rule
                break
        out[r["transaction_id"]] = verdict
    return out


def verdicts(df):
    return {r["transaction_id"]: r["rule_triggered"] for r in df.select("transaction_id", "rule_triggered").collect()}
