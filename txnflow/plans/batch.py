"""The batch job: messages in, warehouse tables out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from txnflow.config import DEFAULT_RULES, RuleConfig
from txnflow.functions import date_key, time_key, utc_time
from txnflow.operators.context import split_maintenance, tag_context
from txnflow.operators.dims import dim_calendar, dim_time
from txnflow.operators.enrich import enrich_customers
from txnflow.operators.facts import alert_messages, audit_log, fact_alert, fact_txn
from txnflow.operators.history import History
from txnflow.operators.ids import IdIndex, Insert, insert_once
from txnflow.operators.rules import ID, RULE, alert_ids, alert_key, apply_cascade, crowded, single_pass
from txnflow.operators.tables import archive_raw, insert_new, read_current, read_or_empty, upsert
from txnflow.operators.validate import dead_letters, dedupe_stored, keep_rejected_text, valid, validate
from txnflow.schemas import DETECTED_DATE, DIM_CALENDAR, DIM_CUSTOMER, DIM_TIME, FACT_ALERT, FACT_TXN, LOADED_DATE
from txnflow.session import GZIP, by_shuffle, stored
from txnflow.sources.messages import parse


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def of_runs(self, table: str) -> str:
        """Where batch runs write a table that streams write by batch id: next to the stream's folders."""
        return f"{self.path(table)}/batch_id=-1"

    @property
    def facts(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("fact_txn"), FACT_TXN)

    @property
    def alerts(self) -> DataFrame:
        return read_or_empty(self.spark, self.path("fact_alert"), FACT_ALERT)

    @property
    def dated_facts(self) -> DataFrame:
        """Facts with ``loaded_date``, the folder they lie in: reports of days and hours open only theirs."""
        schema = StructType([*FACT_TXN.fields, StructField(LOADED_DATE, IntegerType())])
        return read_or_empty(self.spark, self.path("fact_txn"), schema)

    @property
    def dated_alerts(self) -> DataFrame:
        """Alerts with ``detected_date``, the folder they lie in."""
        schema = StructType([*FACT_ALERT.fields, StructField(DETECTED_DATE, IntegerType())])
        return read_or_empty(self.spark, self.path("fact_alert"), schema)

    @property
    def history(self) -> History:
        """What the rules read of the rows of earlier runs."""
        return History(self.spark, self.path("history"))

    def ids(self, of: str) -> IdIndex:
        """The ids that tables hold: of ``facts_and_alerts``, ``audit``, ``letters``, ``held`` or ``replayed``."""
        return IdIndex(self.spark, self.path(f"ids_of_{of}"))

    @property
    def fact_tables(self) -> dict[str, tuple[str, str | Column]]:
        return {"fact": (self.path("fact_txn"), ID), "alert": (self.path("fact_alert"), alert_key())}

    @property
    def letters(self) -> DataFrame:
        """Dead letters with their position in the table."""
        rows = self.spark.read.parquet(self.path("dead_letter"))
        position = F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
        return rows.select("*", position.alias("position"))

    @property
    def customers(self) -> DataFrame:
        return read_current(self.spark, self.path("dim_customer"), DIM_CUSTOMER)

    @property
    def minutes(self) -> DataFrame:
        return read_current(self.spark, self.path("dim_time"), DIM_TIME)

    @property
    def calendar(self) -> DataFrame:
        return read_current(self.spark, self.path("dim_calendar"), DIM_CALENDAR)

    def seed(self, customers: DataFrame, first: str = "2024-01-01", last: str = "2026-12-31") -> None:
        """Upsert customers; add the minutes and days that are missing."""
        upsert(customers, self.path("dim_customer"), "customer_id")
        insert_new(dim_time(self.spark), self.path("dim_time"), "time_id")
        insert_new(dim_calendar(self.spark, first, last), self.path("dim_calendar"), "date_id")


def store_facts(
    scored: DataFrame, house: Warehouse, cfg: RuleConfig = DEFAULT_RULES, load: str | None = None
) -> None:
    """Insert facts and alerts that are not there yet; one scored row per id.

    Alert ids, some three fifths of an alert's shuffled bytes and a fifth of a fact's, are made again by the tasks that write.
    """
    facts = fact_txn(scored, cfg, RULE).withColumn(LOADED_DATE, date_key("loaded_at"))
    alerts = fact_alert(scored).withColumn(DETECTED_DATE, date_key("detected_at"))
    inserts = [
        Insert(
            "fact",
            facts,
            ID,
            house.path("fact_txn"),
            (LOADED_DATE, "date_id"),
            made={"alert_id": F.when(F.col("fraud_flag"), alert_ids()), "time_id": time_key("event_ts").cast("int")},
            without=(RULE,),
        ),
        Insert("alert", alerts, alert_key(), house.path("fact_alert"), (DETECTED_DATE,), made={"alert_id": alert_ids()}),
    ]
    insert_once(house.ids("facts_and_alerts"), inserts, load, house.fact_tables)


def store_audit(scored: DataFrame, house: Warehouse) -> None:
    """Add the trail of transactions that have none yet; called when its last stage has ended."""
    trail = Insert("audit", audit_log(scored), "txn_id", house.path("audit_log"), ids=scored.select(ID))
    insert_once(house.ids("audit"), [trail])


def store_dead_letters(dead: DataFrame, house: Warehouse) -> None:
    """One row per rejected message, equal ones as often as they were sent.

    ``dead`` has the place of each message (``file``, ``at``).  Equal messages are numbered file by file, and so in
    many tasks; a letter is known by its digest and number, so a run on the same messages adds none.
    """
    content = F.struct(*[c for c in ("key", "value") if c in dead.columns])
    rows = dead.withColumn("digest", F.sha2(F.to_json(content, {"ignoreNullFields": "false"}), 256))
    files = rows.groupBy("digest", "file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("digest").orderBy("file")) - F.col("n")  # a row per file
    files = files.select("digest", "file", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("digest", "file").orderBy("at"))
    rows = rows.withColumn("own", own).join(by_shuffle(files), ["digest", "file"])
    letter = F.concat_ws(":", "digest", (F.col("own") + F.col("before")).cast("string"))
    rows = stored(rows.withColumn("letter_id", letter).drop("file", "at", "own", "before"), "letters")
    letters = Insert("letter", rows, "letter_id", house.of_runs("dead_letter"), ids=rows.select("letter_id"))
    insert_once(house.ids("letters"), [letters])


def run_batch(
    messages: DataFrame,
    house: Warehouse,
    cfg: RuleConfig = DEFAULT_RULES,
    loaded_at: Column | None = None,
    hold_maintenance: bool = False,
    audit: bool = True,
    publish: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Process key/value messages into the warehouse; returns the scored rows.

    Running it again on the same messages changes nothing but the archive's
    and the alert topic's copies, as re-sending messages does.  ``publish`` takes the alerts as key/value
    rows, e.g. to ``kafka_publish`` them; without it they go to a folder.

    Rows are judged next to those of earlier runs, so data loaded in parts, in order, has the verdicts of one
    run.  Rule orders and thresholds outside ``single_pass`` look back without bound; there a run is judged by
    itself.  Held rows are context for the others, too: only their own loading waits for ``release_held``.
    """
    loaded = utc_time(F.current_timestamp()) if loaded_at is None else loaded_at.cast("timestamp_ntz")
    arrived = messages if "loaded_at" in messages.columns else messages.withColumn("loaded_at", loaded)
    carry = [c for c in ("key", "loaded_at") if c in arrived.columns]
    checked = stored(keep_rejected_text(validate(parse(arrived, *carry))), "validated")

    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    store_dead_letters(dead_letters(checked.select("*", *place), "file", "at"), house)

    good = valid(checked).drop("value", "key")
    accepted = dedupe_stored(good)
    past = house.history.before(accepted, cfg) if single_pass(cfg) else None
    crowds = crowded(accepted, cfg) if single_pass(cfg) else None
    judged = tag_context(apply_cascade(accepted, cfg, past, crowds), cfg)  # after the shuffle of the rows
    loading = accepted
    if hold_maintenance:
        loading, held = split_maintenance(accepted, cfg)
        judged, _ = split_maintenance(judged, cfg)
        insert_once(house.ids("held"), [Insert("held", held, ID, house.path("held"))])
    archive_raw(loading, house.of_runs("raw"))

    scored = stored(enrich_customers(judged, house.customers, source=loading), "scored")
    store_facts(scored, house, cfg)
    publish = publish or (lambda df: df.select("value").write.mode("append").options(**GZIP).text(house.of_runs("txn_alert")))
    publish(alert_messages(scored))
    if audit:
        store_audit(scored, house)
    if single_pass(cfg):
        house.history.keep(accepted, cfg, crowds=crowds)
    return scored


def _as_messages(house: Warehouse, rows: DataFrame, fields: tuple[str, ...] = ()) -> DataFrame:
    """Rows that are not loaded yet as messages for the next run."""
    waiting = rows.join(by_shuffle(house.facts.select(ID)), ID, "left_anti")
    body = F.to_json(F.struct(*(fields or [c for c in rows.columns if c not in ("event_ts", "loaded_at", "batch_id")])))
    arrived = [c for c in ("loaded_at",) if c in rows.columns]
    return waiting.select(F.lit(None).cast("string").alias("key"), body.alias("value"), *arrived)


def release_held(spark: SparkSession, house: Warehouse, *fields: str) -> DataFrame:
    """Messages held back during maintenance and not loaded since, ready for the next run."""
    return _as_messages(house, spark.read.parquet(house.path("held")), fields)


def release_late(spark: SparkSession, house: Warehouse, *fields: str) -> DataFrame:
    """Messages a stream set aside as late and not loaded since, ready for a batch run."""
    return _as_messages(house, spark.read.parquet(house.path("late")), fields)


def replay(dead: DataFrame, raw_path: str | None = None) -> DataFrame:
    """Dead letters as messages again, key and value untouched.

    With ``raw_path`` they are also added there as rows, for ``sources.messages.letter_messages`` or a stream of them.
    """
    key = F.col("key") if "key" in dead.columns else F.lit(None).cast("string")
    messages = dead.select(key.cast("string").alias("key"), "value")
    if raw_path is not None:
        messages.write.mode("append").parquet(raw_path)
    return messages


def replay_once(house: Warehouse, raw_path: str) -> None:
    """Replay the warehouse's dead letters that no replay has sent yet; each is known by its position in the table."""
    letters = house.letters
    key = F.col("key") if "key" in letters.columns else F.lit(None).cast("string")
    rows = letters.select(key.cast("string").alias("key"), "value", "position")
    insert_once(house.ids("replayed"), [Insert("replayed", rows, "position", raw_path)])
