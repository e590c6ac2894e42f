"""The cascade on a stream.

Each micro-batch is scored with the batch operators, next to a history table
of the recent past.  A verdict depends on a bounded time before its row
(``lookback_ms``), so with rows arriving in order the stream gives exactly the
batch result, and a hot account is spread over tasks as in batch.

Late rows wait in ``late`` for ``plans.batch.release_late``; a batch run then
judges them next to the rows around them, which are kept by event date.

The history is the warehouse's, an append-only log (``operators.history``): a batch reads the blocks its rows touch and
adds its own rows, and a stream with a new checkpoint goes on from what is there.  What a retried batch left behind
itself is told by its name and does not count.  Facts and alerts are inserted only if absent; the other outputs have a
folder per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.config import DEFAULT_RULES, RuleConfig
from txnflow.functions import local_time, utc_time
from txnflow.operators.context import tag_context
from txnflow.operators.enrich import enrich_customers
from txnflow.operators.facts import alert_messages
from txnflow.operators.ids import Insert, held_ids
from txnflow.operators.rules import ID, apply_cascade, crowded, single_pass
from txnflow.operators.tables import archive_raw, read_or_empty
from txnflow.operators.validate import dead_letters, dedupe_stored, keep_rejected_text, valid, validate
from txnflow.plans.batch import Warehouse, store_facts
from txnflow.session import COMPRESSION, GZIP
from txnflow.sources.messages import parse

#: How far a row's time may lie after its arrival and still move the stream's time on.
CLOCK_TOLERANCE_MS = 86_400_000

STATE = T.StructType(
    [
        T.StructField("newest", T.TimestampNTZType()),
        T.StructField("query", T.StringType()),
        T.StructField("slot", T.IntegerType()),
    ]
)


def _interval(milliseconds: int):
    return F.make_dt_interval(secs=F.lit(milliseconds / 1000).cast("decimal(18,6)"))


def newest_time(rows: DataFrame):
    """The latest event time; a row dated far after its arrival does not count, else all that follows were late."""
    known = F.col("event_ts") <= utc_time(F.current_timestamp()) + _interval(CLOCK_TOLERANCE_MS)
    return rows.filter(known).agg(F.max("event_ts")).first()[0]


class CascadeSink:
    """foreachBatch target holding the paths and settings."""

    def __init__(
        self, house: Warehouse, cfg: RuleConfig = DEFAULT_RULES, delay_ms: int = 3_600_000, loaded_at=None, publish=None
    ):
        if not single_pass(cfg):
            raise ValueError("the stream needs velocity first and windows that allow a single pass")
        self.house, self.cfg, self.delay_ms = house, cfg, delay_ms
        self.loaded_at, self.publish = loaded_at, publish

    def _state(self, query: str, batch_id: int) -> str:
        return self.house.path(f"stream_state/query={query}/slot={batch_id % 2}")

    def _newest_before(self, query: str, batch_id: int) -> str | None:
        """The newest event time before this batch; a new query goes on from those before it."""
        rows = read_or_empty(self.house.spark, self.house.path("stream_state"), STATE)
        own = F.col("query") == query
        mine = own & (F.col("slot") == (batch_id - 1) % 2) if batch_id > 0 else ~own
        return rows.filter(mine).agg(F.max("newest")).first()[0]

    def _batch(self, name: str, batch_id: int) -> str:
        return self.house.path(f"{name}/batch_id={batch_id}")

    def _stage(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """Write an intermediate table of this batch; two batches later it is overwritten."""
        return self._write(df, self.house.path(f"stream_stage/{name}{batch_id % 2}"))

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path, mode="overwrite", compression=COMPRESSION)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        house, cfg = self.house, self.cfg
        spark = messages.sparkSession
        loaded = utc_time(F.current_timestamp()) if self.loaded_at is None else self.loaded_at
        checked = keep_rejected_text(validate(parse(messages, "key"))).withColumn("loaded_at", loaded.cast("timestamp_ntz"))
        checked = self._stage(checked, "validated", batch_id)
        self._write(dead_letters(checked.drop("loaded_at")), self._batch("dead_letter", batch_id))

        # The same for a batch that is tried again, and another for each checkpoint.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        run = f"{query}-{batch_id}"
        newest = self._newest_before(query, batch_id)
        rows = valid(checked).drop("value", "key")
        if newest is not None:
            late = F.col("event_ts") < local_time(newest) - _interval(self.delay_ms)
            self._write(rows.filter(late).drop("loaded_at"), self._batch("late", batch_id))
            rows = rows.filter(~late)
        # A message sent again counts once, also across batches.
        accepted = dedupe_stored(rows, lambda df: self._stage(df, "once", batch_id))
        keys = Insert("fact", accepted, ID, house.path("fact_txn")).keys()
        known = held_ids(house.ids("facts_and_alerts"), keys, house.fact_tables, apart_from=run)
        if known is not None and not known.isEmpty():
            accepted = self._stage(accepted.join(known.select(F.col("id").alias(ID)), ID, "left_anti"), "accepted", batch_id)

        archive_raw(accepted, self._batch("raw", batch_id), mode="overwrite")
        crowds = crowded(accepted, cfg)
        past = house.history.before(accepted, cfg, run)
        judged = tag_context(apply_cascade(accepted, cfg, past, crowds), cfg)
        scored = self._stage(enrich_customers(judged, house.customers, source=accepted), "scored", batch_id)
        store_facts(scored, house, cfg, load=run)
        alerts = alert_messages(scored)
        if self.publish is not None:
            self.publish(alerts)
        else:
            alerts.select("value").write.mode("overwrite").options(**GZIP).text(self._batch("txn_alert", batch_id))
        house.history.keep(accepted, cfg, run, crowds)
        times = [t for t in (newest, newest_time(accepted)) if t is not None]
        state = spark.createDataFrame([(max(times, default=None),)], "newest timestamp_ntz").coalesce(1)
        self._write(state, self._state(query, batch_id))


def start_cascade(messages: DataFrame, sink: CascadeSink, checkpoint: str, **trigger):
    """Start scoring a key/value message stream."""
    writer = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
