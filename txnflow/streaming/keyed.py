"""The cascade as one keyed stateful operator.

An alternative to ``streaming.cascade``: state lives in Spark's state store
and rows come out with the next trigger.  The key is a time block of a group of
accounts, with the tail of the block before it as context, so a backlog of one
account is spread over tasks.  A key costs some milliseconds whatever it holds;
with a key per account and block that was nearly all of the time.  The state
of a key is one list, a row per account, read and written as a whole, so
``GROUPS`` should grow with the number of accounts: a group of a thousand is
some 100 KB a block.  Within a block, rows that are bound to fire velocity
(the third or later of one instant) leave at once and are never held.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from txnflow.config import DEFAULT_RULES, DUPLICATE, GEO, OFF_HOURS, VELOCITY, RuleConfig
from txnflow.functions import off_hours_large
from txnflow.functions.scalar import EARTH_RADIUS_KM
from txnflow.operators.rules import ACCOUNT, lookback_ms, rule_input, single_pass, velocity_applies
from txnflow.operators.timeblocks import BLOCK, IN_CORE, block_length, with_halo

#: Groups of accounts, by hash.
GROUPS = 64
GROUP = "_group"
VERDICT_DDL = "transaction_id string, account_masked string, t bigint, rule_triggered string, dist_km double, late boolean"
COLUMNS = ["transaction_id", "account_masked", "t", "rule_triggered", "dist_km", "late"]


def distance_km(a: tuple[float, float], b: tuple[float, float]) -> float:
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    chord = (
        math.sin((lat2 - lat1) / 2) ** 2
        + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    )
    return 2 * EARTH_RADIUS_KM * math.atan2(math.sqrt(chord), math.sqrt(max(0.0, 1 - chord)))


class CascadeProcessor(StatefulProcessor):
    """Of each account of one block: velocity times, last place and last row per combination."""

    def __init__(self, cfg: RuleConfig, block_ms: int):
        self.cfg, self.block_ms = cfg, block_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.accounts = handle.getListState("accounts", "account string, state string")

    def handleInputRows(self, key, rows, timerValues):
        heads, passed = None, timerValues.getCurrentWatermarkInMs()
        for chunk in rows:
            # The state these rows would need may be gone; the caller gives them to a batch run.
            late = chunk["t"] < passed
            if late.any():
                yield self._verdicts(chunk[late], None, True)
                chunk = chunk[~late]
            if self.cfg.rule_order[0] == OFF_HOURS and chunk["off_hours"].any():
                yield self._verdicts(chunk[chunk["off_hours"]], OFF_HOURS)
                chunk = chunk[~chunk["off_hours"]]
            held = chunk if heads is None else pd.concat([heads, chunk], ignore_index=True)
            held = held.sort_values([ACCOUNT, "t", "transaction_id"], ignore_index=True)
            sure = held.groupby([ACCOUNT, "t"]).cumcount() >= self.cfg.velocity_count - 1
            if sure.any():
                yield self._verdicts(held[sure], VELOCITY)
            heads = held[~sure]
        if heads is not None and len(heads):
            yield self._score(heads)
        # The block is complete, and its state of no use, when the watermark has passed it.
        self.handle.registerTimer((key[1] + 1) * self.block_ms)

    def _verdicts(self, rows: pd.DataFrame, rule: str | None, late: bool = False) -> pd.DataFrame:
        core = rows[rows["core"]]
        return core[["transaction_id", ACCOUNT, "t"]].assign(rule_triggered=rule, dist_km=None, late=late)[COLUMNS]

    def _score(self, heads: pd.DataFrame) -> pd.DataFrame:
        """Verdicts of rows in order of account and time."""
        state = {r[0]: r[1] for r in self.accounts.get()}
        verdicts, account = [], None
        for row in heads.itertuples(index=False):
            if row.account_masked != account:
                if account is not None:
                    state[account] = self._text(recent, place, last, now)
                account = row.account_masked
                recent, place, last = self._known(state.get(account))
            now = int(row.t)
            recent = [t for t in recent if now - t <= self.cfg.velocity_ms] + [now]
            rule, km = (VELOCITY if len(recent) >= self.cfg.velocity_count else None), None
            # More times than the threshold needs change no verdict.
            recent = recent[-self.cfg.velocity_count :]
            if rule is None:
                for name in self.cfg.rule_order:
                    fired = False
                    if name == GEO:
                        fired, place, km = self._geo(row, place)
                    elif name == DUPLICATE:
                        fired = self._duplicate(row, last)
                    elif name == OFF_HOURS:
                        fired = bool(row.off_hours)
                    if fired:
                        rule = name
                        break
            if row.core:
                verdicts.append((row.transaction_id, account, now, rule, km if rule == GEO else None, False))
        state[account] = self._text(recent, place, last, now)
        self.accounts.put(list(state.items()))
        return pd.DataFrame(verdicts, columns=COLUMNS)

    def _known(self, text: str | None) -> tuple[list, tuple | None, dict]:
        if text is None:
            return [], None, {}
        times, place, last = json.loads(text)
        return times, place and tuple(place), {(a, m): t for a, m, t in last}

    def _text(self, recent: list, place: tuple | None, last: dict, now: int) -> str:
        kept = [(a, m, t) for (a, m), t in last.items() if now - t <= self.cfg.duplicate_ms]
        return json.dumps([recent, place, kept])

    def _geo(self, row, place):
        if pd.isna(row.merchant_lat) or pd.isna(row.merchant_lon):
            return False, place, None
        here, fired, km = (int(row.t), float(row.merchant_lat), float(row.merchant_lon)), False, None
        if place is not None and 0 < row.t - place[0] <= self.cfg.geo_ms:
            km = distance_km(place[1:], here[1:])
            fired = km > self.cfg.geo_anomaly_km
        return fired, here, km

    def _duplicate(self, row, last) -> bool:
        """Compare with the combination's last row; see ``rules.single_pass``."""
        if pd.isna(row.amount) or not isinstance(row.merchant_id, str) or not row.merchant_id:
            return False
        combo = (int(row.amount), row.merchant_id)
        before = last.get(combo)
        last[combo] = int(row.t)
        return before is not None and row.t - before <= self.cfg.duplicate_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.accounts.clear()
        return iter(())

    def close(self) -> None:
        pass


def kept_when_late(rows: DataFrame, delay: str) -> DataFrame:
    """The rows under a watermark on ``event_ts``, none of which the engine drops.

    The engine drops rows by the column that has the watermark.  That is ``mark`` here: a copy of each row has the
    time in it, moves the watermark, and ends here; the row itself has null and is never too late.  So the operator
    sees it, and compares its time with the watermark itself.
    """
    times = F.array(F.col("event_ts"), F.lit(None).cast("timestamp"))
    marked = rows.withColumn("mark", F.explode(times)).drop("event_ts").withWatermark("mark", delay)
    return marked.filter(F.col("mark").isNull())


def keyed_cascade(
    rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES, delay: str = "1 hour", groups: int = GROUPS
) -> DataFrame:
    """Verdict per row of a stream of accepted transactions, or ``late``: older than the watermark, and not judged.

    Rows without an account have no state and are left to ``off_hours_large``.
    """
    if not single_pass(cfg):
        raise ValueError("the stream needs velocity first and windows that allow a single pass")
    block_ms = block_length(lookback_ms(cfg))
    narrow = rule_input(rows, F.col("event_ts"), off_hours_large(cfg=cfg).alias("off_hours"))
    narrow = kept_when_late(narrow.filter(velocity_applies()), delay)
    blocked = with_halo(narrow, lookback_ms(cfg), block_ms).withColumnRenamed(IN_CORE, "core")
    blocked = blocked.withColumn(GROUP, F.pmod(F.xxhash64(ACCOUNT), F.lit(groups)))
    return blocked.groupBy(GROUP, BLOCK).transformWithStateInPandas(
        statefulProcessor=CascadeProcessor(cfg, block_ms),
        outputStructType=VERDICT_DDL,
        outputMode="append",
        timeMode="EventTime",
    )
