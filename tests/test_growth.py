"""What a load or a trigger costs while the warehouse grows, and what survives a run that broke off."""

import contextlib
import io
import os
from datetime import timedelta

import pytest
from helpers import T0, txn
from test_batch_and_streams import as_messages, house_of, verdicts

from pyspark.sql import functions as F
from txnflow.config import DEFAULT_RULES, VELOCITY
from txnflow.operators import ids, rules, validate
from txnflow.operators.ids import IdIndex, Insert, insert_once, stored_ids
from txnflow.plans import reports
from txnflow.plans.batch import Warehouse, replay_once, run_batch, store_facts
from txnflow.plans import catalogue
from txnflow.plans.catalogue import demo_messages, text_rows, warehouse
from txnflow.session import ROCKSDB_PROVIDER, scratch_table
from txnflow.sources import demo, messages
from txnflow.streaming import cascade, keyed, windows


def keys(spark, numbers, kind="k"):
    return spark.createDataFrame([(kind, f"id{n}") for n in numbers], "kind string, id string")


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part")}


@pytest.mark.parametrize("bits", [32_768, 64])
def test_ids_are_found_exactly(spark, monkeypatch, bits):
    """Also where the filters answer "perhaps" to nearly everything, and with loads of several sizes."""
    monkeypatch.setattr(ids, "BITS", bits)
    monkeypatch.setattr(ids, "PER_FILTER", 20)
    index = IdIndex(spark, scratch_table(spark, "ids"))
    none = {"k": lambda: spark.createDataFrame([], "id string"), "other": lambda: spark.createDataFrame([], "id string")}
    assert index.held(keys(spark, [1, 2]), none) is None
    for part in (range(0, 1000, 2), range(1001, 1011), [2001]):
        index.confirm(index.begin(keys(spark, part)))
    index.confirm(index.begin(keys(spark, [7], "other")))
    found = index.held(keys(spark, [*range(0, 30), 1001, 2001, 2002]), none)
    assert {r["id"] for r in found.collect()} == {f"id{n}" for n in [*range(0, 30, 2), 1001, 2001]}
    found = index.held(keys(spark, [2, 7], "other"), none)
    assert [tuple(r) for r in found.collect()] == [("other", "id7")]


def test_new_ids_open_no_stored_id_and_few_buckets(spark):
    index = IdIndex(spark, scratch_table(spark, "ids"))
    index.confirm(index.begin(keys(spark, range(5000))))
    asked = plan(index.perhaps(keys(spark, [9001])))
    assert "PartitionFilters: [" in asked and "bucket" in asked.split("PartitionFilters: [")[1].split("]")[0]
    assert "bits0" in asked and "ids:array" not in asked
    # A load into a warehouse ten times as large reads about as much: its filters, which are a few bytes an id.
    size = lambda n: sum(files(f"{index.path}/filters").values()) / n
    assert size(5000) < 100


def test_a_load_that_broke_off_is_completed(spark):
    """Ids without rows do not count, rows that were written are not written again."""
    house = house_of(spark)
    path, index = house.path("things"), house.ids("things")
    rows = spark.createDataFrame([(f"t{i}", i) for i in range(10)], "thing string, n int")
    index.begin(rows.select(F.lit("thing").alias("kind"), F.col("thing").alias("id")))  # never confirmed
    rows.filter("n < 4").write.parquet(path)
    for _ in range(2):
        insert_once(index, [Insert("thing", rows, "thing", path)])
        assert sorted(r[0] for r in stored_ids(spark, path, "thing").collect()) == [f"t{i}" for i in range(10)]


def test_a_table_older_than_its_index(spark):
    path = scratch_table(spark, "old")
    rows = spark.createDataFrame([(f"t{i}", i) for i in range(10)], "thing string, n int")
    rows.filter("n < 6").write.parquet(path)
    insert_once(IdIndex(spark, scratch_table(spark, "ids")), [Insert("thing", rows, "thing", path)])
    assert spark.read.parquet(path).count() == 10


def test_state_written_per_trigger_follows_the_batch(spark):
    """The same number of rows per trigger, the same bytes of history; nothing of it is written again."""
    house = house_of(spark)
    sink, sizes, seen = cascade.CascadeSink(house), [], {}
    for batch in range(4):
        rows = [txn(f"b{batch}r{i}", 700 * batch + i, account=f"****{i}", amount=i + 1) for i in range(40)]
        sink(as_messages(spark, rows), batch)
        now = files(house.path("history"))
        assert all(now[f] == size for f, size in seen.items())
        sizes.append(sum(now.values()) - sum(seen.values()))
        seen = now
    assert max(sizes) < 1.3 * min(sizes) and house.facts.count() == 160


def test_a_new_checkpoint_goes_on_from_the_history(spark):
    house = house_of(spark)
    rows = [txn(f"n{i}", 8 * i, amount=i + 1) for i in range(3)]
    run_batch(as_messages(spark, rows[:1]), house, audit=False)
    cascade.CascadeSink(house)(as_messages(spark, rows[1:2]), 0)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    try:
        sink = cascade.CascadeSink(house, delay_ms=1000)
        for _ in range(2):
            sink(as_messages(spark, [*rows[2:], txn("old", -3600)]), 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert verdicts(house) == {"n2": VELOCITY} and house.facts.count() == 3
    assert [r["transaction_id"] for r in spark.read.parquet(house.path("late")).collect()] == ["old"]


def test_letters_come_back_whole_and_once(spark):
    house, raw = house_of(spark), scratch_table(spark, "raw")
    text = '{"transaction_id": "a",\n "amount":\r\n 1}'
    sent = spark.createDataFrame([("k1", text), ("k2", text), (None, text)] + [(None, "x")] * 700, "key string, value string")
    for _ in range(2):
        run_batch(sent.repartition(3), house, audit=False)
    assert house.letters.count() == 703 and house.letters.select("position").distinct().count() == 703
    for _ in range(2):
        replay_once(house, raw)
    back = messages.letter_messages(spark, raw).groupBy("key", "value").count().collect()
    assert {(r["key"], r["value"]): r["count"] for r in back} == {("k1", text): 1, ("k2", text): 1, (None, text): 1, (None, "x"): 700}
    run_batch(spark.createDataFrame([("k3", "y")], "key string, value string"), house, audit=False)
    replay_once(house, raw)
    assert messages.letter_messages(spark, raw).filter("key = 'k3'").count() == 1
    assert messages.letter_messages(spark, raw).count() == 704


def test_a_failing_publish_leaves_no_trail_of_it(spark):
    house = house_of(spark)

    def fail(_):
        raise RuntimeError("the topic is away")

    sent = as_messages(spark, [txn(f"v{i}", i, amount=i + 1) for i in range(3)])
    with pytest.raises(RuntimeError):
        run_batch(sent, house, publish=fail)
    assert house.facts.count() == 3 and not os.path.exists(house.path("audit_log"))
    run_batch(sent, house)
    trail = spark.read.parquet(house.path("audit_log")).groupBy("processor_name").count().collect()
    assert {r[0]: r[1] for r in trail} == {
        **{s: 3 for s in ("consume", "validate", "normalise", "lookup_customer", "score_rules", "load_fact_txn")},
        "publish_alert": 1,
        "load_fact_alert": 1,
    }


@pytest.mark.parametrize("operator", ["keyed", "minutes"])
def test_late_rows_of_stateful_operators_come_out(spark, operator):
    """A row nine hours late is given as late, and changes nothing else."""
    folder, out, checkpoint = (scratch_table(spark, n) for n in ("topic", "out", "checkpoint"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    apply = keyed.keyed_cascade if operator == "keyed" else windows.minutes_and_late
    first = [txn(f"a{i}", 8 * i, amount=i + 1) for i in range(3)] + [txn("end", 3 * 3600, account="****9")]
    second = [txn("late", at=T0 - timedelta(hours=6)), txn("b", 3 * 3600 + 5, account="****8")]
    for part in (first, second):
        as_messages(spark, part).select("value").coalesce(1).write.mode("append").text(folder)
        writer = apply(windows.accepted(messages.file_stream(spark, folder))).writeStream.format("parquet")
        query = writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
    rows = spark.read.parquet(out)
    if operator == "keyed":
        got = {r["transaction_id"]: (r["rule_triggered"], r["late"]) for r in rows.collect()}
        plain = (None, False)
        assert got == {"a0": plain, "a1": plain, "a2": (VELOCITY, False), "end": plain, "b": plain, "late": (None, True)}
    else:
        got = {(r["time"], r["late"]): r["n"] for r in rows.groupBy("time", "late").agg(F.sum("value").alias("n")).collect()}
        assert got == {(T0, False): 3, (T0 - timedelta(hours=6), True): 1}


# ---- reports of a day and an hour -------------------------------------------


@pytest.fixture(scope="module")
def days(spark, sf_dir):
    """A warehouse of three days of loading, the last two around a midnight; the newest load is at 0:20."""
    scored = spark.read.parquet(warehouse(spark, sf_dir).path("scored")).limit(1500)
    n = F.pmod(F.xxhash64("transaction_id"), F.lit(1500))
    minutes = F.when(n < 500, n).otherwise(6 * 1440 + 20 - n % 90)
    when = (F.lit("2026-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)).cast("timestamp_ntz")
    house = Warehouse(spark, scratch_table(spark, "days"))
    store_facts(scored.withColumn("loaded_at", when).withColumn("event_ts", when), house)
    return house


AS_OF = "2026-03-07 00:20:00"


def day_reports(facts, alerts):
    return {
        "day": lambda: reports.end_of_day(facts, alerts, "2026-03-06"),
        "latency": lambda: reports.alert_latency(alerts, AS_OF),
        "hour": lambda: reports.volume_per_minute(facts, AS_OF),
        "fraud": lambda: reports.volume_per_minute(facts, AS_OF, fraud_only=True),
    }


def partition_filters(df):
    return [line.split("PartitionFilters: ")[1] for line in plan(df).splitlines() if line.startswith("PartitionFilters: ")]


def test_reports_of_folders_equal_those_of_the_whole_table(days):
    whole, folders = day_reports(days.facts, days.alerts), day_reports(days.dated_facts, days.dated_alerts)
    for name in whole:
        want = whole[name]().collect()
        assert want == folders[name]().collect(), name
        assert want and want[0][0] is not None
    hour = [r["time"] for r in folders["hour"]().collect()]
    assert min(hour).day == 6 and max(hour).day == 7  # both sides of midnight


def test_reports_open_the_folders_of_their_days_only(spark, days):
    """Beside them lie files that are no Parquet: a report that opened them would fail."""
    for table, column in (("fact_txn", "loaded_date"), ("fact_alert", "detected_date")):
        for day in (20260215, 20260301):
            folder = f"{days.path(table)}/{column}={day}" + (f"/date_id={day}" if table == "fact_txn" else "")
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/part-0.parquet", "w") as file:
                file.write("not a table")
    folders = day_reports(days.dated_facts, days.dated_alerts)
    for name, report in folders.items():
        report().collect()
        filters = partition_filters(report())
        assert filters and all("_date#" in f for f in filters), (name, filters)
    with pytest.raises(Exception, match="part-0.parquet|Parquet"):
        days.facts.agg(F.sum("amount")).collect()


def test_long_sides_of_joins_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Files of ids compress well; what is broadcast is decided by the number of ids."""
    own = spark.range(5000).select(F.lit("a").alias("kind"), F.col("id").cast("string").alias("id"))
    index = IdIndex(spark, str(tmp_path / "index"))
    index.confirm(index.begin(own))
    monkeypatch.setattr(ids, "FEW_KEYS", 1000)
    sides = []
    monkeypatch.setattr(F, "broadcast", lambda df, real=F.broadcast: sides.append(df) or real(df))
    table = str(tmp_path / "table")
    more = spark.range(2500, 7500).select(F.col("id").cast("string").alias("key"))
    rows = Insert("a", more, "key", table)
    insert_once(index, [rows], tables={"a": (table, "key")})
    assert spark.read.parquet(table).count() == 2500
    assert all(side.count() <= 1000 for side in sides) and sides
    before = files(table)
    insert_once(index, [rows], tables={"a": (table, "key")})
    assert files(table) == before  # a repeated load writes nothing


def test_bitmaps_of_the_id_index_are_not_shuffled(spark, monkeypatch):
    """A task that reads ids makes no bitmap of each filter: those would be tasks times filters."""
    monkeypatch.setattr(ids, "PER_FILTER", 10)
    index = IdIndex(spark, scratch_table(spark, "ids"))
    moved = [part for part in plan(index.built(keys(spark, range(100)), 64, "load")).split("\n\n") if ") Exchange\n" in part]
    assert len(moved) == 1 and "hashpartitioning(bucket" in moved[0] and "buf" not in moved[0]
    index.confirm(index.begin(keys(spark, range(20_000))))  # 128 filters a bucket, of four tasks each
    rows = spark.read.parquet(f"{index.path}/filters")
    assert rows.agg(F.sum(F.size("ids"))).first()[0] == 20_000
    assert rows.groupBy("bucket", "number").count().filter("count > 1").isEmpty()
    assert len(files(f"{index.path}/filters")) <= 64


@pytest.mark.parametrize("texts", [demo_messages, text_rows])
def test_texts_are_made_by_many_tasks_whatever_the_row_groups(spark, sf_dir, monkeypatch, texts):
    want = sorted(map(str, texts(spark, sf_dir).collect()))
    monkeypatch.setattr(demo, "TASK_BYTES", 1000)
    dealt = texts(spark, sf_dir)
    assert dealt.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert sorted(map(str, dealt.collect())) == want


def test_rows_without_copies_stay_where_they_are(spark):
    """Only ids are shuffled to find copies; a trigger without them stores its rows once, one with them judges the first."""
    house = house_of(spark)
    rows = [txn(f"c{i}", 700 * i, account=f"****{i}", amount=i + 1) for i in range(30)]
    sink = cascade.CascadeSink(house, delay_ms=10**9)
    sink(as_messages(spark, rows), 0)
    assert {n.rstrip("01") for n in os.listdir(house.path("stream_stage"))} == {"validated", "scored"}
    later = [txn(f"d{i}", 700 * i + 3, account=f"****{i}", amount=i + 1) for i in range(30)]
    sink(as_messages(spark, [*later, *later[:3], *rows[:2]]), 1)
    assert house.facts.count() == 60 and len(verdicts(house)) == 30
    once = spark.createDataFrame([("a", 1), ("b", 1)], "transaction_id string, n int")
    assert validate.dedupe_stored(once) is once


@pytest.mark.parametrize("few", [50_000, 0])
@pytest.mark.parametrize("order", [("velocity", "duplicate", "off_hours_large"), ("off_hours_large", "velocity", "geo_anomaly", "duplicate")])
def test_crowded_instants_change_no_verdict(spark, monkeypatch, few, order):
    from txnflow.operators import timeblocks

    monkeypatch.setattr(timeblocks, "FEW_CROWDED", few)
    cfg = DEFAULT_RULES.with_options(rule_order=order)
    rows = [txn(f"r{i}", (i * i) % 97 + 40 * (i % 3), account=f"****{i % 4}", amount=60_000_000 * (i % 2) + i % 5) for i in range(200)]
    rows += [txn(f"hot{i}", 500, account="****1", amount=i % 3) for i in range(50)]
    rows = [txn("none", 3, account=None), *rows]
    frame = validate.valid(validate.validate(messages.parse(as_messages(spark, rows)))).drop("value", "key")
    crowds = rules.crowded(frame, cfg)
    assert crowds is None if few == 0 else crowds.n > 0
    judged = lambda c: {tuple(r) for r in rules.apply_cascade(frame, cfg, crowds=c).select("transaction_id", rules.RULE, "dist_km").collect()}
    assert judged(crowds) == judged(None)


def test_history_of_other_blocks_is_not_looked_up(spark):
    """A first load has no history; where a load follows another, only the blocks that kept rows lie in are shuffled."""
    house = house_of(spark)
    frame = lambda rows: validate.valid(validate.validate(messages.parse(as_messages(spark, rows)))).drop("value", "key")
    first = frame([txn(f"a{i}", 600 * i, account=f"****{i % 5}") for i in range(60)])
    assert house.history.before(first) is None
    house.history.keep(first)
    second = frame([txn(f"b{i}", 36_000 + 600 * i, account=f"****{i % 5}") for i in range(600)])
    before = house.history.before(second)
    assert {r["transaction_id"] for r in before.collect()} <= {f"a{i}" for i in range(48, 60)} and before.count() > 0
    assert house.history.before(first).count() == 0


def test_checks_run_in_generated_code(spark):
    """A filter over an array of them would make each check, the time's among them, a second time outside of it."""
    checked = validate.validate(messages.parse(demo_messages(spark, "/root/testdata/sf0.001")))
    assert "lambdafunction" not in checked._jdf.queryExecution().executedPlan().toString()
    some = {tuple(r[0]) for r in checked.select("error_reasons").distinct().collect()}
    assert some == {(), ("timestamp",), ("amount",), ("amount", "currency", "status"), ("json", *validate.REQUIRED_FIELDS)}


@pytest.mark.parametrize("query", ["batch_load", "batch_in_parts"])
def test_messages_of_several_runs_are_made_once(spark, monkeypatch, query):
    seen = []
    monkeypatch.setattr(catalogue, "run_batch", lambda sent, *_, **__: seen.append(plan(sent)))
    with contextlib.suppress(Exception):  # nothing was loaded
        getattr(catalogue, query)(spark, "/root/testdata/sf0.001")
    assert len(seen) == (2 if query == "batch_load" else 3)
    assert all("sent-" in p and "sequence(" not in p and "to_json" not in p for p in seen)


def test_delivered_messages_are_compressed(spark):
    class Done:
        awaitTermination = exception = staticmethod(lambda: None)

    folder = catalogue._stream_into(spark, "/root/testdata/sf0.001", lambda stream: Done)
    assert all(f.endswith(".gz") for f in files(folder)) and len(files(folder)) > 1
    sent = demo_messages(spark, "/root/testdata/sf0.001").select("value")
    back = messages.file_messages(spark, folder).select("value")
    assert back.count() == sent.count() and back.exceptAll(sent).isEmpty()
