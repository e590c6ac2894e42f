import json
import random
from datetime import timedelta

import pandas as pd
import pytest
from helpers import HA_NOI, HO_CHI_MINH, T0, frame, simulate, txn

from pyspark.sql import functions as F
from txnflow.config import DEFAULT_RULES, DUPLICATE, GEO_ORDER, OFF_HOURS, VELOCITY
from txnflow.operators.facts import fact_alert
from txnflow.operators.rules import apply_cascade
from txnflow.operators.tables import archive_raw
from txnflow.plans.batch import Warehouse, release_held, release_late, replay, run_batch
from txnflow.schemas import DIM_CUSTOMER
from txnflow.session import ROCKSDB_PROVIDER, scratch_table
from txnflow.sources import messages
from txnflow.streaming import cascade, keyed, windows

WITH_GEO = DEFAULT_RULES.with_options(rule_order=GEO_ORDER)


def as_messages(spark, rows):
    return spark.createDataFrame([(None, json.dumps(r)) for r in rows], "key string, value string")


def house_of(spark):
    house = Warehouse(spark, scratch_table(spark, "house"))
    house.seed(spark.createDataFrame([("CUS000001", "****1", "VIP", 5, "Hue", None, None)], DIM_CUSTOMER))
    return house


def load_mix():
    """8 clusters of 4, 13 large, 10 pairs and normal rows, all at night."""
    start, rows, i = T0.replace(hour=22, minute=0), [], 0

    def add(**options):
        nonlocal i
        i += 1
        options = {"account": f"****{i:05d}", "amount": (i % 20 + 1) * 1_000_000, "merchant": f"MER{i:05d}"} | options
        rows.append(txn(f"BENCH-{i:09d}", at=start + timedelta(milliseconds=10 * i), **options))

    clusters, pairs = 0, 0
    for n in range(1, 10_001):
        if n % 1000 == 0 and clusters < 8:
            for _ in range(4):
                add(account=f"****VL{clusters:02d}")
            clusters += 1
        elif n % 700 == 0:
            add(amount=75_000_000)
        elif n % 900 == 0 and pairs < 10:
            for _ in range(2):
                add(account=f"****DP{pairs:02d}", amount=(pairs + 1) * 2_000_000, merchant=f"MER{pairs:05d}")
            pairs += 1
        else:
            add()
    return rows


def test_load_mix(spark):
    rows = load_mix()
    assert len(rows) == 10_034
    alerts = fact_alert(apply_cascade(frame(spark, rows).withColumn("loaded_at", F.col("event_ts"))))
    counts = {r["rule_triggered"]: r["count"] for r in alerts.groupBy("rule_triggered").count().collect()}
    assert counts == {VELOCITY: 16, OFF_HOURS: 13, DUPLICATE: 10}


def test_batch_is_idempotent_and_replayable(spark):
    house = house_of(spark)
    good = [txn(f"v{i}", i, amount=1000 + i) for i in range(3)] + [txn("x", customer_id="nobody", account="****2")]
    bad = {k: v for k, v in txn("bad", account="****3").items() if k not in ("amount", "currency", "status")}
    sent = as_messages(spark, good + [good[0], bad])
    for _ in range(2):
        run_batch(sent, house)
    assert (house.facts.count(), house.alerts.count()) == (4, 1)
    dead = spark.read.parquet(house.path("dead_letter"))
    assert [r["error_reasons"] for r in dead.collect()] == [["amount", "currency", "status"]]
    assert spark.read.parquet(house.path("audit_log")).count() == 4 * 6 + 2
    published = spark.read.text(house.path("txn_alert")).collect()
    assert json.loads(published[0]["value"])["transaction_id"] == "v2"
    # Equal broken messages are as many dead letters, however often the run is repeated.
    cut = spark.createDataFrame([(None, '{"transaction_id"')] * 3 + [(None, None)], "key string, value string")
    other = house_of(spark)
    for _ in range(2):
        run_batch(cut, other)
        assert spark.read.parquet(other.path("dead_letter")).count() == 4
    # Replaying unrepaired dead letters rejects them again; repaired ones load.
    run_batch(replay(dead), house)
    assert (house.facts.count(), spark.read.parquet(house.path("dead_letter")).count()) == (4, 1)
    run_batch(as_messages(spark, [txn("bad", account="****3")]), house)
    assert house.facts.count() == 5


def random_history(seed, n=500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = rng.choice(["hot", "hot", "a", "b", "c"])
        rows.append(
            txn(
                f"R{i:05d}",
                rng.randrange(0, 7_200_000) / 1000,
                account=account,
                amount=rng.choice([1, 2]),
                place=rng.choice([HA_NOI, HO_CHI_MINH]),
            )
        )
    return sorted(rows, key=lambda r: (r["timestamp"], r["transaction_id"]))


def deliver(spark, folder, rows, start):
    as_messages(spark, rows).select("value").coalesce(1).write.mode("append").text(folder)
    query = start(messages.file_stream(spark, folder))
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("cfg", [DEFAULT_RULES, WITH_GEO], ids=["default", "with_geo"])
def test_stream_in_order_equals_batch(spark, cfg):
    house, folder = house_of(spark), scratch_table(spark, "topic")
    rows = random_history(11)
    sink = cascade.CascadeSink(house, cfg, delay_ms=60_000)
    start = lambda s: cascade.start_cascade(s, sink, house.path("checkpoint"), availableNow=True)
    for lo, hi in ((0, 100), (100, 101), (101, 500)):
        deliver(spark, folder, rows[lo:hi], start)
    want = {k: v for k, v in simulate(rows, cfg).items() if v}
    assert {r["transaction_id"]: r["rule_triggered"] for r in house.alerts.collect()} == want
    assert house.facts.count() == 500
    # Sent again: late rows are set aside, recent ones are known; nothing changes.
    deliver(spark, folder, rows[480:] + rows[:5], start)
    assert (house.facts.count(), house.alerts.count()) == (500, len(want))
    late = spark.read.parquet(house.path("late"))
    assert {r["transaction_id"] for r in late.collect()} >= {r["transaction_id"] for r in rows[:5]}


def test_stream_retry_of_a_batch_changes_nothing(spark):
    house = house_of(spark)
    rows = random_history(12, 200)
    sink = cascade.CascadeSink(house)
    sink(as_messages(spark, rows[:100]), 0)
    for _ in range(2):
        sink(as_messages(spark, rows[100:]), 1)
    want = {k for k, v in simulate(rows).items() if v}
    assert {r["transaction_id"] for r in house.alerts.collect()} == want
    assert house.facts.count() == 200


def test_stream_needs_the_single_pass(spark):
    with pytest.raises(ValueError):
        cascade.CascadeSink(house_of(spark), DEFAULT_RULES.with_options(velocity_count=4))


def test_keyed_cascade_in_order_equals_batch(spark):
    folder, out, checkpoint = (scratch_table(spark, n) for n in ("topic", "verdicts", "checkpoint"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    rows = random_history(13, 300)

    def start(stream):
        verdicts = keyed.keyed_cascade(windows.accepted(stream), WITH_GEO)
        writer = verdicts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    for lo, hi in ((0, 120), (120, 300)):
        deliver(spark, folder, rows[lo:hi], start)
    got = {r["transaction_id"]: r["rule_triggered"] for r in spark.read.parquet(out).collect()}
    assert got == simulate(rows, WITH_GEO)


def test_keyed_cascade_bursts_and_orders(spark):
    """Many rows of one instant, blocks apart, and off-hours first."""
    cfg = DEFAULT_RULES.with_options(rule_order=(OFF_HOURS, VELOCITY, DUPLICATE))
    rows = [txn(f"B{i:04d}", 0, account="hot") for i in range(300)]
    rows += [txn(f"E{i}", 3570 + 15 * i, account="edge", amount=5) for i in range(8)]
    rows += [txn(f"N{i}", 36_000 + 20 * i, account="night", amount=60_000_000) for i in range(4)]
    folder, out, checkpoint = (scratch_table(spark, n) for n in ("topic", "verdicts", "checkpoint"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)

    def start(stream):
        verdicts = keyed.keyed_cascade(windows.accepted(stream), cfg)
        writer = verdicts.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    deliver(spark, folder, rows, start)
    got = {r["transaction_id"]: r["rule_triggered"] for r in spark.read.parquet(out).collect()}
    assert got == simulate(rows, cfg)


def test_channel_totals_stream(spark):
    folder, checkpoint = scratch_table(spark, "topic"), scratch_table(spark, "checkpoint")
    totals = []

    def start(stream):
        counts = windows.totals_by_channel(windows.accepted(stream))
        keep = lambda df, _: totals.extend(r.asDict() for r in df.collect())
        writer = counts.writeStream.outputMode("update").foreachBatch(keep)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    deliver(spark, folder, [txn("a"), txn("b", fraud_label=1)], start)
    deliver(spark, folder, [txn("c"), txn("d")], start)
    assert [(t["total"], t["fraud"], t["fraud_pct"]) for t in totals] == [(2, 1, 50.0), (4, 1, 25.0)]


def verdicts(house):
    return {r["transaction_id"]: r["rule_triggered"] for r in house.alerts.collect()}


@pytest.mark.parametrize("cfg", [DEFAULT_RULES, WITH_GEO], ids=["default", "with_geo"])
def test_batch_in_parts_equals_one_run(spark, cfg):
    house, rows = house_of(spark), random_history(21, 300)
    for part in (rows[:90], rows[90:91], rows[91:200], rows[91:200], rows[200:]):
        run_batch(as_messages(spark, part), house, cfg, audit=False)
    assert verdicts(house) == {k: v for k, v in simulate(rows, cfg).items() if v}
    assert house.facts.count() == 300


def test_velocity_over_midnight_in_two_runs(spark):
    house, night = house_of(spark), T0.replace(hour=23, minute=59, second=50)
    rows = [txn(f"m{i}", at=night + timedelta(seconds=8 * i), amount=i + 1) for i in range(3)]
    run_batch(as_messages(spark, rows[:1]), house, audit=False)
    run_batch(as_messages(spark, rows[1:]), house, audit=False)
    assert verdicts(house) == {"m2": VELOCITY}


def test_orders_without_a_single_pass_judge_each_run_by_itself(spark):
    cfg = DEFAULT_RULES.with_options(velocity_count=4)
    house, rows = house_of(spark), [txn(f"s{i}", i, amount=i + 1) for i in range(4)]
    run_batch(as_messages(spark, rows[:2]), house, cfg, audit=False)
    run_batch(as_messages(spark, rows[2:]), house, cfg, audit=False)
    assert verdicts(house) == {}


def test_held_rows_are_judged_with_their_neighbours(spark):
    sunday = T0.replace(day=9, hour=0, minute=59, second=50)
    rows = [txn(f"h{i}", at=sunday + timedelta(seconds=8 * i), amount=i + 1) for i in range(4)]
    house = house_of(spark)
    run_batch(as_messages(spark, rows), house, hold_maintenance=True, audit=False)
    assert house.facts.count() == 2 and verdicts(house) == {}
    run_batch(release_held(spark, house), house, audit=False)
    assert house.facts.count() == 4
    assert verdicts(house) == {k: v for k, v in simulate(rows).items() if v} == {"h2": VELOCITY, "h3": VELOCITY}
    assert release_held(spark, house).isEmpty()


def test_late_rows_come_back_and_a_far_future_row_stops_nothing(spark):
    house = house_of(spark)
    sink = cascade.CascadeSink(house, delay_ms=60_000)
    sink(as_messages(spark, [txn("now", 600, account="****2"), txn("poison", at=T0.replace(year=2999))]), 0)
    sink(as_messages(spark, [txn("good", 601, account="****3")] + [txn(f"l{i}", i, amount=i + 1) for i in range(3)]), 1)
    assert {r["transaction_id"] for r in house.facts.collect()} == {"now", "poison", "good"}
    run_batch(release_late(spark, house), house, audit=False)
    assert house.facts.count() == 6 and verdicts(house) == {"l2": VELOCITY}
    assert release_late(spark, house).isEmpty()


def test_one_fact_per_id_in_stream_and_batch(spark):
    house = house_of(spark)
    sink = cascade.CascadeSink(house)
    sink(as_messages(spark, [txn("same")]), 0)
    sink(as_messages(spark, [txn("same", 90_000)]), 1)
    run_batch(as_messages(spark, [txn("same", 180_000)]), house, audit=False)
    assert house.facts.count() == 1


def test_minutes_that_the_stream_left_out(spark):
    """An open minute and rows that came after their minute was closed are given by the batch count."""
    rows = spark.sql("SELECT timestamp_seconds(1700000000 + id * 7) AS event_ts FROM range(100)")
    every = windows.volume_per_minute(rows)
    counts = {r.time: r.value for r in every.collect()}
    late, *_, still_open = sorted(counts)
    closed = every.filter(F.col("time") != F.lit(still_open)).withColumn("value", F.col("value") - (F.col("time") == F.lit(late)).cast("int"))
    rest = {r.time: r.value for r in windows.rest_per_minute(rows, closed).collect()}
    assert rest == {late: 1, still_open: counts[still_open]}


def test_keyed_cascade_state_is_a_row_per_account_of_a_group():
    """A key costs milliseconds whatever it holds: the accounts of a group share one, and one read and write of state."""
    calls = []

    class States:
        rows = []

        def get(self):
            calls.append("get")
            return iter(self.rows)

        def put(self, rows):
            calls.append("put")
            self.rows = rows

    class Handle:
        def getListState(self, name, schema):
            return States()

        def registerTimer(self, at):
            calls.append("timer")

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    processor = keyed.CascadeProcessor(WITH_GEO, 3_600_000)
    processor.init(Handle())

    def fed(second):
        names = ["transaction_id", "account_masked", "t", "amount", "merchant_id", "merchant_lat", "merchant_lon"]
        rows = [(f"T{a}-{second}", f"****{a:04d}", second * 1000, 5, "MER1", 21.0, 105.0 + 10 * (a % 2) * second) for a in range(100)]
        chunk = pd.DataFrame(rows, columns=names).assign(off_hours=False, core=True)
        out = pd.concat(processor.handleInputRows((0, 0), iter([chunk[:40], chunk[40:]]), Times()))
        return out.groupby("rule_triggered", dropna=False).size().to_dict()

    assert list(fed(1).values()) == [100]
    assert fed(2) == {"geo_anomaly": 50, "duplicate": 50}
    assert fed(3) == {"velocity": 100}
    assert calls == ["get", "put", "timer"] * 3


def test_an_hour_of_minutes_is_one_key_with_one_timer():
    timers = []

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            timers.append(at // 60_000)

    class Times:
        def __init__(self, minute):
            self.now = minute * 60_000

        def getCurrentWatermarkInMs(self):
            return self.now

    counter = windows.MinuteCounts()
    counter.init(Handle())
    chunk = lambda *minutes: iter([pd.DataFrame({"minute": [m * 60_000 for m in minutes]})])
    told = lambda frames: {(r.minute // 60_000, r.late): r.value for f in frames for r in f.itertuples()}
    assert told(counter.handleInputRows((0, 0), chunk(3, 3, 5, 7), Times(0))) == {}
    assert told(counter.handleInputRows((0, 0), chunk(1, 5, 9), Times(2))) == {(1, True): 1}
    assert told(counter.handleExpiredTimer((0, 0), Times(6), None)) == {(3, False): 2, (5, False): 2}
    assert told(counter.handleInputRows((0, 0), chunk(5, 9), Times(6))) == {(5, True): 1}
    assert told(counter.handleExpiredTimer((0, 0), Times(10), None)) == {(7, False): 1, (9, False): 2}
    assert not counter.open.exists() and timers == [4, 4, 8, 8]


def test_archive_is_compressed_and_whole(spark, tmp_path):
    rows = [txn(f"Z{i}") for i in range(50)]
    archive_raw(frame(spark, rows), str(tmp_path / "raw"))
    names = [p.name for p in tmp_path.glob("raw/*/*/part-*")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert {r[0] for r in spark.read.json(str(tmp_path / "raw")).select("transaction_id").collect()} == {r["transaction_id"] for r in rows}
