import random
import subprocess
import sys
from datetime import datetime

import numpy as np
import pytest
from helpers import HA_NOI, HO_CHI_MINH, frame, simulate, txn, verdicts
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from txnflow.config import DEFAULT_RULES, DUPLICATE, GEO, GEO_ORDER, OFF_HOURS, VELOCITY
from txnflow.operators import rules
from txnflow.operators.anchors import block_exits, duplicate_anchors, passed_on
from txnflow.operators.timeblocks import block_length, with_halo


def only(rule):
    return DEFAULT_RULES.with_options(rule_order=(rule,))


def ids(df):
    return {r["transaction_id"] for r in df.select("transaction_id").collect()}


def test_velocity_scenarios(spark):
    rows = []
    cases = {"fast": (0, 1, 2), "boundary": (0, 30, 59), "expired": (0, 61), "edge": (0, 30, 60), "past": (0, 30, 60.001)}
    for name, times in cases.items():
        rows += [txn(f"{name}{i}", t, account=name, amount=1000 + i) for i, t in enumerate(times)]
    rows += [txn(f"cluster{i}", i, account="cluster", amount=1000 + i) for i in range(4)]
    fired = ids(rules.velocity_alerts(frame(spark, rows)))
    assert fired == {"fast2", "boundary2", "edge2", "cluster2", "cluster3"}


def test_cascade_scenarios(spark):
    rows = [txn(f"fast{i}", i, account="fast") for i in range(3)]
    rows += [txn(f"bound{i}", t, account="bound") for i, t in enumerate((0, 30, 59))]
    rows += [txn(f"exp{i}", t, account="exp") for i, t in enumerate((0, 61))]
    rows += [txn(f"pair{i}", t, account="pair", amount=3_500_000, merchant="MER00042") for i, t in enumerate((0, 2))]
    got = verdicts(rules.apply_cascade(frame(spark, rows)))
    assert [got[f"fast{i}"] for i in range(3)] == [None, DUPLICATE, VELOCITY]
    assert [got[f"bound{i}"] for i in range(3)] == [None, DUPLICATE, VELOCITY]
    assert [got[f"exp{i}"] for i in range(2)] == [None, None]
    assert [got[f"pair{i}"] for i in range(2)] == [None, DUPLICATE]


def test_geo_scenarios(spark):
    far = [txn("far0", 0, "far", place=HA_NOI), txn("far1", 2, "far", place=HO_CHI_MINH)]
    same = [
        txn("same0", 0, "same", place=HA_NOI),
        txn("same1", 0, "same", place=HO_CHI_MINH),
        txn("same2", 5, "same", place=HO_CHI_MINH),
    ]
    between = [
        txn("gap0", 0, "gap", place=HA_NOI),
        txn("gap1", 60, "gap", place=None),
        txn("gap2", 120, "gap", place=HO_CHI_MINH),
    ]
    late = [txn("late0", 0, "late", place=HA_NOI), txn("late1", 1801, "late", place=HO_CHI_MINH)]
    edge = [txn("edge0", 0, "edge", place=HA_NOI), txn("edge1", 1800, "edge", place=HO_CHI_MINH)]
    zero = [txn("zero0", 0, "zero", place=("x", 0.0, 0.0)), txn("zero1", 5, "zero", place=HA_NOI)]
    alerts = rules.geo_anomaly_alerts(frame(spark, far + same + between + late + edge + zero))
    found = {r["transaction_id"]: r for r in alerts.collect()}
    assert set(found) == {"far1", "gap2", "edge1", "zero1"}
    assert round(found["far1"]["dist_km"], 1) == 1137.9
    assert found["far1"]["severity"] == "HIGH" and found["far1"]["alert_id"].startswith("ALT-G-")


def test_duplicate_anchor_is_not_refreshed(spark):
    rows = [txn(f"a{i}", t) for i, t in enumerate((0, 20, 40, 60))]
    assert ids(rules.duplicate_alerts(frame(spark, rows))) == {"a1", "a3"}


def test_off_hours(spark):
    rows = []
    for hour in (21, 22, 5, 6):
        for amount in (50_000_000, 50_000_001):
            rows.append(txn(f"h{hour}-{amount}", at=datetime(2025, 3, 3, hour, 30), account=f"{hour}{amount}", amount=amount))
    rows.append(txn("bad", amount=90_000_000, timestamp="no time here"))
    assert ids(rules.off_hours_alerts(frame(spark, rows))) == {"h22-50000001", "h5-50000001"}


def test_rows_without_keys_pass_and_leave_no_state(spark):
    rows = [txn(f"e{i}", i, account="") for i in range(4)]
    rows += [txn(f"n{i}", i, account=None) for i in range(4)]
    rows += [txn("m0", 0, "m", merchant=None), txn("m1", 1, "m", merchant=None), txn("m2", 100, "m", merchant="")]
    rows += [txn("night", at=datetime(2025, 3, 3, 23, 0), account="", amount=60_000_000)]
    rows += [txn(f"t{i}", account="t", timestamp="no time") for i in range(4)]
    got = verdicts(rules.apply_cascade(frame(spark, rows)))
    assert got.pop("night") == OFF_HOURS
    assert set(got.values()) == {None}


def random_rows(seed, accounts=40, longest=14, step=25_000):
    rng = random.Random(seed)
    rows = []
    for a in range(accounts):
        at = rng.randrange(0, 8_000) * 1000
        for i in range(rng.randint(1, longest)):
            # Ties, exact window edges and anything between.
            at += rng.choice([0, 0, 1, 1000, 15_000, 30_000, 30_001, 60_000, 60_001, 1_800_000, rng.randrange(step)])
            rows.append(
                txn(
                    f"T{seed}-{a:03d}-{rng.randrange(10**6):06d}-{i}",
                    at / 1000,
                    account=rng.choice([f"acc{a}"] * 30 + ["", None]),
                    amount=rng.choice([1_000_000, 1_000_000, 2_000_000, 70_000_000]),
                    merchant=rng.choice(["M1", "M1", "M1", "M2", None]),
                    place=rng.choice([HA_NOI, HA_NOI, HO_CHI_MINH, None]),
                )
            )
    return rows


@pytest.mark.parametrize("rule", [VELOCITY, GEO, DUPLICATE])
def test_each_rule_equals_the_simulation(spark, rule):
    rows = random_rows(1) + random_rows(2, accounts=3, longest=120, step=40_000)
    want = {k for k, v in simulate(rows, only(rule)).items() if v}
    assert want
    assert ids(rules.RULES[rule](frame(spark, rows))) == want


@pytest.mark.parametrize(
    "order",
    [
        DEFAULT_RULES.rule_order,
        GEO_ORDER,
        (OFF_HOURS, VELOCITY, DUPLICATE, GEO),
        (VELOCITY,),
        (DUPLICATE, VELOCITY, OFF_HOURS),
        (GEO, DUPLICATE),
    ],
)
def test_cascade_equals_the_simulation(spark, order):
    cfg = DEFAULT_RULES.with_options(rule_order=order)
    rows = random_rows(3) + random_rows(4, accounts=3, longest=120, step=40_000)
    assert verdicts(rules.apply_cascade(frame(spark, rows), cfg)) == simulate(rows, cfg)


def test_other_thresholds_equal_the_simulation(spark):
    cfg = DEFAULT_RULES.with_options(velocity_count=5, velocity_window_seconds=45, duplicate_window_seconds=40)
    assert not rules.single_pass(cfg)
    rows = random_rows(5)
    assert verdicts(rules.apply_cascade(frame(spark, rows), cfg)) == simulate(rows, cfg)


def test_one_account_holding_most_rows_across_many_blocks(spark):
    rng = random.Random(7)
    rows = [
        txn(f"H{i:05d}", rng.randrange(0, 40_000_000) / 1000, account="hot", amount=rng.choice([1, 2]), place=rng.choice([HA_NOI, HO_CHI_MINH]))
        for i in range(4000)
    ]
    cfg = DEFAULT_RULES.with_options(rule_order=GEO_ORDER)
    assert verdicts(rules.apply_cascade(frame(spark, rows), cfg)) == simulate(rows, cfg)


def test_burst_in_one_instant_shrinks_before_the_shuffle(spark):
    rows = [txn(f"B{i:05d}", 0, account="hot") for i in range(3000)] + [txn("C", 61, account="hot")]
    df = frame(spark, rows)
    assert len(ids(rules.velocity_alerts(df))) == 2998
    plan = rules.velocity_survivors(rules.rule_input(df))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_default_cascade_moves_full_rows_once_and_stays_in_the_jvm(spark, sf_dir):
    from txnflow.sources.demo import transactions

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rules.apply_cascade(transactions(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Python" not in plan and "Pandas" not in plan
    # Narrow rows: per instant, per account block, per id.  Full rows: per id.
    assert plan.count("Exchange hashpartitioning") == 4


def test_rule_order_is_checked(spark):
    df = frame(spark, [txn("a")])
    for order in (("velocity", "velocity"), ("speed",)):
        with pytest.raises(ValueError):
            rules.apply_cascade(df, DEFAULT_RULES.with_options(rule_order=order))


def greedy(times, window):
    anchors, last = [], None
    for t in times:
        if last is None or t - last > window:
            anchors.append(t)
            last = t
    return anchors


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=80), st.integers(1, 30), st.integers(30, 90))
def test_anchor_walk_equals_one_by_one(times, window, block):
    times, last = sorted(set(times)), -1000
    anchors = greedy(times, window)
    for b in sorted({t // block for t in times}):
        inside = np.array([t for t in times if t // block == b])
        last = passed_on(last, *block_exits(inside, b * block + window, window), window)
        assert last == max(a for a in anchors if a // block <= b)


@pytest.mark.parametrize("block", [30_000, 45_000, 600_000])
def test_anchors_over_small_blocks(spark, block):
    rng = random.Random(block)
    times = sorted({rng.randrange(0, 3_000_000) for _ in range(600)})
    rows = spark.createDataFrame([(f"I{t:08d}", t, "k") for t in times], "transaction_id string, t bigint, k string")
    got = ids(duplicate_anchors(rows, ("k",), 30_000, block))
    assert got == {f"I{t:08d}" for t in greedy(times, 30_000)}


def test_anchors_of_regular_and_sparse_keys(spark):
    """A row every second for an hour never restarts; sparse rows always do."""
    times = {"steady": range(0, 3_600_000, 1000), "sparse": range(0, 3_600_000, 41_000), "pairs": []}
    times["pairs"] = [t + d for t in range(0, 3_600_000, 100_000) for d in (0, 20_000, 40_000)]
    rows = [(f"{k}{t:08d}", t, k) for k, ts in times.items() for t in ts]
    df = spark.createDataFrame(rows, "transaction_id string, t bigint, k string")
    want = {f"{k}{t:08d}" for k, ts in times.items() for t in greedy(ts, 30_000)}
    assert ids(duplicate_anchors(df, ("k",), 30_000)) == want


def test_worker_code_needs_no_installed_package(tmp_path):
    from pyspark import cloudpickle

    from txnflow.streaming.keyed import CascadeProcessor

    for i, thing in enumerate((block_exits, passed_on, CascadeProcessor(DEFAULT_RULES, 3_600_000))):
        (tmp_path / f"{i}.pkl").write_bytes(cloudpickle.dumps(thing))
        load = f"import pickle; pickle.load(open('{i}.pkl', 'rb'))"
        done = subprocess.run([sys.executable, "-I", "-c", load], cwd=tmp_path, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr


def test_halo_must_fit_the_block(spark):
    rows = spark.createDataFrame([("a", 5)], "account_masked string, t bigint")
    with pytest.raises(ValueError):
        with_halo(rows, 1000, 10)
    assert block_length(90_000) == 3_600_000
    assert block_length(1_890_000) == 12 * 1_890_000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def test_verdicts_do_not_depend_on_the_session_zone(spark, zone):
    """The clocks of New York show 01:30 twice on that night."""
    rows = [{**txn("a"), "timestamp": "2024-11-03T05:30:00Z"}, {**txn("b"), "timestamp": "2024-11-03T06:30:00Z"}]
    rows += [{**txn("c", account="****9"), "timestamp": "2024-03-10T02:30:00"}]
    rows += [{**txn("d", account="****9"), "timestamp": "2024-03-10T09:30:20.250+07:00"}]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        judged = rules.apply_cascade(frame(spark, rows))
        columns = "transaction_id", F.col("event_ts").cast("string"), "rule_triggered"
        got = {r[0]: (r[1], r[2]) for r in judged.select(*columns).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {
        "a": ("2024-11-03 05:30:00", None),
        "b": ("2024-11-03 06:30:00", None),
        "c": ("2024-03-10 02:30:00", None),
        "d": ("2024-03-10 02:30:20.25", DUPLICATE),
    }
