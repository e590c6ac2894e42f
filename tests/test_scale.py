"""What is shuffled and written again, and that results are whole where it is not."""

import contextlib
import io
import random

from helpers import frame, simulate, txn

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from txnflow.config import DEFAULT_RULES, DUPLICATE, VELOCITY
from txnflow.operators import anchors, ids
from txnflow.operators.ids import IdIndex
from txnflow.operators.rules import apply_cascade, duplicate_alerts
from txnflow.plans.batch import Warehouse, store_facts
from txnflow.session import scratch_table
from txnflow.sources import demo


def exchanges(df):
    """The shuffles of a plan, with what they carry."""
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return [part for part in out.getvalue().split("\n\n") if ") Exchange\n" in part]


def test_only_blocks_that_reach_a_border_meet_others(spark, monkeypatch):
    """Rows on both sides of every border of blocks, a window from it and a millisecond more or less."""
    seen, real = [], anchors._passed_on

    def passed_on(blocks, *rest):
        seen.append(blocks.count())
        return real(blocks, *rest)

    monkeypatch.setattr(anchors, "_passed_on", passed_on)
    rng, rows = random.Random(21), []
    for account in range(40):
        for border in range(600, 6000, 600):
            near = [-30.001, -30, -29.999, -15, -0.001, 0, 0.001, 14.999, 15, 29.999, 30, 30.001]
            for at in rng.sample(near, rng.randint(0, 3)):
                rows.append(txn(f"T{len(rows):05d}", border + at, account=f"a{account}", amount=7, merchant="M"))
    lonely = [txn(f"L{i:05d}", 300 + 600 * i, account="b", amount=7, merchant="M") for i in range(500)]
    cfg = DEFAULT_RULES.with_options(rule_order=(DUPLICATE,))
    want = {k for k, v in simulate(rows, cfg).items() if v}
    assert {r["transaction_id"] for r in duplicate_alerts(frame(spark, rows + lonely)).collect()} == want
    assert want and seen[0] <= len(rows)


def test_a_cascade_rule_by_rule_writes_no_step_it_reads_once(spark, monkeypatch):
    kept, frames = [], type(spark.range(1))
    real = frames.checkpoint
    monkeypatch.setattr(frames, "checkpoint", lambda df, *a: kept.append(df) or real(df, *a))
    rng = random.Random(5)
    rows = [
        txn(f"T{i:04d}", rng.randint(0, 1500), account=f"a{rng.randint(0, 3)}", amount=rng.randint(1, 3), merchant="M")
        for i in range(400)
    ]
    cfg = DEFAULT_RULES.with_options(rule_order=(DUPLICATE, VELOCITY))
    got = {r["transaction_id"]: r["rule_triggered"] for r in apply_cascade(frame(spark, rows), cfg).collect()}
    assert got == simulate(rows, cfg) and {DUPLICATE, VELOCITY} <= set(got.values())
    assert len(kept) == 1


def test_ids_of_a_repeated_load_are_shuffled_without_their_loads_and_once(spark, monkeypatch):
    """Loads count as confirmed or not; an id of both kinds is held."""
    plans, real = {}, ids.stored
    monkeypatch.setattr(ids, "stored", lambda df, name: plans.update({name: exchanges(df)}) or real(df, name))
    monkeypatch.setattr(ids, "FEW_KEYS", 10)
    own = lambda low, high: spark.range(low, high).selectExpr("'k' as kind", "cast(id as string) as id")
    index = IdIndex(spark, scratch_table(spark, "ids"))
    index.begin(own(0, 600))  # not confirmed
    index.confirm(index.begin(own(400, 1000)))
    table = spark.range(100, 200).selectExpr("cast(id as string) as id")  # what the first load had written
    found = index.held(own(0, 2000), {"k": lambda: table})
    assert sorted(int(r["id"]) for r in found.collect()) == [*range(100, 200), *range(400, 1000)]
    moved = [e for e in plans["stored-ids"] if "kind#" in e]
    assert len(moved) == 2 and not any("load" in e for e in moved)


def test_facts_and_alerts_are_dealt_without_what_follows_from_their_rows(spark, sf_dir, monkeypatch):
    dealt, real = {}, DataFrameWriter.parquet

    def parquet(writer, path, *args, **options):
        dealt[path.rsplit("/", 1)[-1]] = exchanges(writer._df)
        return real(writer, path, *args, **options)

    txn_rows = demo.transactions(spark, sf_dir)
    scored = apply_cascade(txn_rows).limit(1500).cache()
    house = Warehouse(spark, scratch_table(spark, "house"))
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    for _ in range(2):
        store_facts(scored, house)
    for table in ("fact_txn", "fact_alert"):
        assert dealt[table] and not any("alert_id" in e.split("Arguments")[0] for e in dealt[table][-1:])
    pairs = lambda df: sorted((r[0], r[1]) for r in df.select("transaction_id", "alert_id").collect())
    alerts = scored.filter("fraud_flag")
    assert pairs(house.alerts) == pairs(alerts) and pairs(house.facts.filter("fraud_flag")) == pairs(alerts)
    assert house.facts.filter("not fraud_flag and alert_id is not null").isEmpty() and house.facts.count() == 1500
    minute = F.hour("event_ts") * 100 + F.minute("event_ts")
    assert house.facts.filter(F.col("time_id") != minute).isEmpty()
    # The index of ids lets them be compressed: no digests among them.
    kept = spark.read.parquet(f"{house.path('ids_of_facts_and_alerts')}/filters").select(F.inline("ids"))
    assert kept.filter("kind = 'alert'").agg(F.max(F.length("id"))).first()[0] < 38
    scored.unpersist()
