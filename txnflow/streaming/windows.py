"""Windowed counts and live aggregates on a stream."""

from __future__ import annotations

import json
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from txnflow.functions import event_millis, millis_time, percent, utc_time
from txnflow.operators.validate import valid, validate
from txnflow.sources.messages import parse
from txnflow.streaming.keyed import kept_when_late

MINUTE_MS, HOUR_MS, SALTS = 60_000, 3_600_000, 16
WATERMARK = "1 hour"


def accepted(messages: DataFrame) -> DataFrame:
    """Valid transactions of a message stream, with event_ts as a watermarked timestamp."""
    rows = valid(validate(parse(messages)))
    return rows.withColumn("event_ts", F.timestamp_millis(event_millis("event_ts")))


def volume_per_minute(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    counts = rows.withWatermark("event_ts", delay).groupBy(F.window("event_ts", "1 minute")).agg(
        F.count("*").alias("value")
    )
    return counts.select(utc_time(F.col("window.start")).alias("time"), "value")


class MinuteCounts(StatefulProcessor):
    """Counts the minutes of one hour (a part of it); rows that come when their minute is closed are given as late.

    A key costs some milliseconds whatever it holds, so it is an hour, with one timer at a time: the end of its first
    open minute.  All minutes that the watermark has closed come out together.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "counts string")

    def _counts(self) -> dict[int, int]:
        return {int(m): n for m, n in json.loads(self.open.get()[0]).items()} if self.open.exists() else {}

    def _keep(self, counts: dict[int, int]) -> None:
        if counts:
            self.open.update((json.dumps(counts),))
            self.handle.registerTimer(min(counts) + MINUTE_MS)
        else:
            self.open.clear()

    def _rows(self, counts: dict[int, int], late: bool) -> pd.DataFrame:
        return pd.DataFrame({"minute": list(counts), "value": list(counts.values()), "late": late})

    def handleInputRows(self, key, rows, timerValues):
        found, passed = Counter(), timerValues.getCurrentWatermarkInMs()
        for chunk in rows:
            found.update(chunk["minute"].value_counts().to_dict())
        late = {int(m): int(n) for m, n in found.items() if m + MINUTE_MS <= passed}
        if late:
            yield self._rows(late, True)
        if len(late) < len(found):
            counts = Counter(self._counts())
            counts.update({int(m): int(n) for m, n in found.items() if m not in late})
            self._keep(counts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        counts, passed = self._counts(), timerValues.getCurrentWatermarkInMs()
        closed = {m: n for m, n in counts.items() if m + MINUTE_MS <= passed}
        if closed:
            yield self._rows(closed, False)
            self._keep({m: n for m, n in counts.items() if m not in closed})

    def close(self) -> None:
        pass


def minutes_and_late(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """(time, value, late): counts of closed minutes, and of rows that came later; to be summed by time and late.

    An hour is counted in SALTS parts, so a busy one is many tasks' work.
    """
    t = F.unix_millis("event_ts")
    parts = kept_when_late(rows.select("transaction_id", "event_ts", (t - F.pmod(t, F.lit(MINUTE_MS))).alias("minute")), delay)
    salt = F.pmod(F.xxhash64("transaction_id"), F.lit(SALTS)).alias("salt")
    hour = F.floor(F.col("minute") / HOUR_MS).alias("hour")
    counts = parts.select("minute", hour, salt, "mark").groupBy("hour", "salt").transformWithStateInPandas(
        statefulProcessor=MinuteCounts(),
        outputStructType="minute bigint, value bigint, late boolean",
        outputMode="append",
        timeMode="EventTime",
    )
    return counts.select(millis_time("minute").alias("time"), "value", "late")


def rest_per_minute(rows: DataFrame, closed: DataFrame) -> DataFrame:
    """What the stream has not given: open minutes and rows later than the watermark; ``rows`` is all that was delivered."""
    given = closed.groupBy("time").agg(F.sum("value").alias("given"))
    left = F.col("value") - F.coalesce("given", F.lit(0))
    return volume_per_minute(rows).join(given, "time", "left").select("time", left.alias("value")).filter("value > 0")


def totals_by_channel(rows: DataFrame) -> DataFrame:
    """For update mode: running totals per channel."""
    fraud = F.count_if(F.col("fraud_label") == 1)
    return rows.groupBy("channel").agg(
        F.count("*").alias("total"), fraud.alias("fraud"), percent(fraud, F.count("*")).alias("fraud_pct")
    )
