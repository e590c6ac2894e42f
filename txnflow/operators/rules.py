"""The four fraud rules and the first-match cascade, on event time.

Input rows need ``transaction_id`` (unique; see ``dedupe_transactions``),
``event_ts`` and the message fields.  Rows of one account are ordered by
(event_ts in ms, transaction_id).

Each rule is written so that one account, or one account-amount-merchant
combination, may hold any share of the table: rows are reduced per instant
before they are shuffled, and histories are worked on in time blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from txnflow.config import (
    DEFAULT_RULES,
    DUPLICATE,
    GEO,
    OFF_HOURS,
    SEVERITY,
    VELOCITY,
    RuleConfig,
)
from txnflow.functions import alert_id, event_millis, has_value, haversine_km, millis_time, off_hours_large
from txnflow.operators.anchors import duplicate_anchors
from txnflow.operators.timeblocks import BLOCK, IN_CORE, Crowded, crowded_instants, first_per_instant, with_halo
from txnflow.schemas import RAW_TXN
from txnflow.session import by_shuffle, ensure_checkpoint_dir

ACCOUNT = "account_masked"
ID = "transaction_id"
RULE = "rule_triggered"
# What the rules read of a row.
HISTORY = (ID, ACCOUNT, "event_ts", "timestamp", "amount", "merchant_id", "merchant_lat", "merchant_lon")
HISTORY_SCHEMA = T.StructType(
    [
        T.StructField(name, RAW_TXN[name].dataType if name in RAW_TXN.names else T.TimestampNTZType(), True)
        for name in HISTORY
    ]
)


# ---- who takes part in a rule -----------------------------------------------


def velocity_applies() -> Column:
    return has_value(ACCOUNT)


def has_history(txn_time: str = "event_ts") -> Column:
    """On input rows: those whose account and time the stateful rules can use."""
    return has_value(ACCOUNT) & F.col(txn_time).isNotNull()


def geo_applies() -> Column:
    return has_value(ACCOUNT) & F.col("merchant_lat").isNotNull() & F.col("merchant_lon").isNotNull()


def duplicate_applies() -> Column:
    return has_value(ACCOUNT) & F.col("amount").isNotNull() & has_value("merchant_id")


def rule_input(txn: DataFrame, *extra: str) -> DataFrame:
    """The few columns rules read, with event time as ``t`` in milliseconds.

    A row without a time has no place in a history: it loses its account here
    and passes the stateful rules.  ``event_ts`` is zone-free, or an instant
    where a watermark needs one.
    """
    instant = isinstance(txn.schema["event_ts"].dataType, T.TimestampType)
    millis = F.unix_millis("event_ts") if instant else event_millis("event_ts")
    return txn.select(
        ID,
        F.when(F.col("event_ts").isNotNull(), F.col(ACCOUNT)).alias(ACCOUNT),
        millis.alias("t"),
        "amount",
        "merchant_id",
        "merchant_lat",
        "merchant_lon",
        *extra,
    )


# ---- rule 1: velocity -------------------------------------------------------


def _velocity_fires(cfg: RuleConfig, order) -> Column:
    earlier = F.lag("t", cfg.velocity_count - 1).over(order)
    return F.coalesce(F.col("t") - earlier <= cfg.velocity_ms, F.lit(False))


def velocity_survivors(rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Eligible rows that velocity lets pass.

    With N = velocity_count, rows from the N-th of an instant on always fire.
    The first N-1 rows of each instant are enough to find any row's (N-1)-th
    predecessor's time, so only those are shuffled by account.
    """
    heads = first_per_instant(rows.filter(velocity_applies()), ACCOUNT, cfg.velocity_count - 1)
    blocked = with_halo(heads, cfg.velocity_ms)
    order = Window.partitionBy(ACCOUNT, BLOCK).orderBy("t", ID)
    judged = blocked.withColumn("_fires", _velocity_fires(cfg, order))
    return judged.filter(F.col(IN_CORE) & ~F.col("_fires")).drop("_fires", BLOCK, IN_CORE)


def _as_alerts(fired: DataFrame, rule: str, *extra: Column) -> DataFrame:
    return fired.select(
        alert_id(rule).alias("alert_id"),
        ID,
        F.lit(rule).alias(RULE),
        F.lit(SEVERITY[rule]).alias("severity"),
        ACCOUNT,
        millis_time("t").alias("detected_at"),
        *extra,
    )


def velocity_alerts(txn: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    rows = rule_input(txn)
    passed = velocity_survivors(rows, cfg).select(ID)
    return _as_alerts(rows.filter(velocity_applies()).join(passed, ID, "left_anti"), VELOCITY)


# ---- rule 2: geo anomaly ----------------------------------------------------


def _geo_distance(cfg: RuleConfig, prev_t: Column, prev_lat: Column, prev_lon: Column) -> Column:
    """Distance from the previous place when the rule fires, else null."""
    gap = F.col("t") - prev_t
    distance = haversine_km(prev_lat, prev_lon, F.col("merchant_lat"), F.col("merchant_lon"))
    in_window = (gap > 0) & (gap <= cfg.geo_ms)
    return F.when(in_window & (distance > cfg.geo_anomaly_km), distance)


def geo_hits(rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Eligible rows that fire, with ``dist_km``.

    Rows at the instant of their predecessor never fire, so an instant needs
    only its first row (which may fire) and its last (the place it leaves).
    """
    place = F.struct(ID, "merchant_lat", "merchant_lon")
    instants = (
        rows.filter(geo_applies())
        .groupBy(ACCOUNT, "t")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
    )
    order = Window.partitionBy(ACCOUNT, BLOCK).orderBy("t")
    return (
        with_halo(instants, cfg.geo_ms)
        .withColumn("_prev_t", F.lag("t").over(order))
        .withColumn("_prev", F.lag("last").over(order))
        .filter(IN_CORE)
        .select(ACCOUNT, "t", "first.*", "_prev_t", "_prev")
        .withColumn(
            "dist_km",
            _geo_distance(
                cfg, F.col("_prev_t"), F.col("_prev.merchant_lat"), F.col("_prev.merchant_lon")
            ),
        )
        .filter(F.col("dist_km").isNotNull())
        .drop("_prev_t", "_prev")
    )


def geo_anomaly_alerts(txn: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return _as_alerts(geo_hits(rule_input(txn), cfg), GEO, F.col("dist_km"))


# ---- rule 4: duplicate ------------------------------------------------------


def duplicate_alerts(txn: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Eligible rows that are not the anchor of their combination."""
    rows = rule_input(txn)
    eligible = rows.filter(duplicate_applies())
    anchors = duplicate_anchors(eligible, (ACCOUNT, "amount", "merchant_id"), cfg.duplicate_ms)
    return _as_alerts(eligible.join(anchors, ID, "left_anti"), DUPLICATE)


# ---- rule 3: off-hours large ------------------------------------------------


def off_hours_alerts(txn: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    fired = txn.filter(off_hours_large(cfg=cfg))
    return _as_alerts(fired.withColumn("t", event_millis("event_ts")), OFF_HOURS)


# ---- cascade ----------------------------------------------------------------


def single_pass(cfg: RuleConfig) -> bool:
    """Can the cascade run as windows over velocity's survivors?

    Velocity must come before the other stateful rules.  Its survivors hold at
    most N-1 rows per account in any velocity window.  With N = 3 and a window
    of at least two duplicate windows, no three survivors are chained by gaps
    within the duplicate window (the third would have fired), so the anchor a
    duplicate is compared with is always the row just before it.
    """
    stateful = [r for r in cfg.rule_order if r != OFF_HOURS]
    if not stateful or stateful[0] != VELOCITY:
        return False
    if DUPLICATE not in stateful:
        return True
    return cfg.velocity_count == 3 and cfg.velocity_ms >= 2 * cfg.duplicate_ms


def lookback_ms(cfg: RuleConfig) -> int:
    """How far back a verdict of the single pass can depend on other rows.

    A rule's verdict needs earlier rows within its window, and for each of
    those the verdicts of the rules before it, hence the sum.
    """
    windows = {VELOCITY: cfg.velocity_ms, GEO: cfg.geo_ms, DUPLICATE: cfg.duplicate_ms}
    return sum(windows.get(rule, 0) for rule in cfg.rule_order)


def crowded(stored_rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> Crowded | None:
    """Where rows that can be read again crowd at an instant of an account; for ``apply_cascade`` and the history."""
    rows = stored_rows.filter(has_history()).select(ACCOUNT, event_millis("event_ts").alias("t"))
    return crowded_instants(rows, ACCOUNT, cfg.velocity_count - 1)


def score(txn: DataFrame, cfg: RuleConfig = DEFAULT_RULES, crowds: Crowded | None = None) -> DataFrame:
    """Verdicts of the single pass: (transaction_id, rule_triggered, dist_km).

    Rows that velocity stops are absent; ``apply_cascade`` puts them back.  More rows of an instant than velocity
    needs change no verdict, they only cost; so where ``crowds`` tells that there are few such, others are not ranked.
    """
    rows = rule_input(txn, off_hours_large(cfg=cfg).alias("_off_hours"))
    rows = rows.filter(velocity_applies())
    if cfg.rule_order[0] == OFF_HOURS:
        # Rows the first rule takes never reach the state of the others.
        rows = rows.filter(~F.col("_off_hours"))
    heads = first_per_instant(rows, ACCOUNT, cfg.velocity_count - 1, crowds)
    blocked = with_halo(heads, lookback_ms(cfg))
    order = Window.partitionBy(ACCOUNT, BLOCK).orderBy("t", ID)
    alive = blocked.withColumn("_fires", _velocity_fires(cfg, order)).filter(~F.col("_fires")).drop("_fires")
    tagged = alive.withColumns({RULE: F.lit(None).cast("string"), "dist_km": F.lit(None).cast("double")})
    for rule in cfg.rule_order:
        if rule == GEO:
            tagged = _tag_geo(tagged, cfg)
        elif rule == DUPLICATE:
            tagged = _tag_duplicate(tagged, cfg)
        elif rule == OFF_HOURS:
            tagged = tagged.withColumn(
                RULE, F.when(F.col(RULE).isNull() & F.col("_off_hours"), OFF_HOURS).otherwise(F.col(RULE))
            )
    return tagged.filter(IN_CORE).select(ID, RULE, "dist_km")


def _tag_geo(rows: DataFrame, cfg: RuleConfig) -> DataFrame:
    # Rows an earlier rule took, or without a place, form groups of their own.
    takes_part = F.col(RULE).isNull() & geo_applies()
    order = Window.partitionBy(ACCOUNT, BLOCK, takes_part).orderBy("t", ID)
    distance = _geo_distance(
        cfg,
        F.lag("t").over(order),
        F.lag("merchant_lat").over(order),
        F.lag("merchant_lon").over(order),
    )
    measured = rows.withColumn("dist_km", F.when(takes_part, distance))
    return measured.withColumn(RULE, F.when(F.col("dist_km").isNotNull(), GEO).otherwise(F.col(RULE)))


def _tag_duplicate(rows: DataFrame, cfg: RuleConfig) -> DataFrame:
    takes_part = F.col(RULE).isNull() & duplicate_applies()
    order = Window.partitionBy(ACCOUNT, BLOCK, "amount", "merchant_id", takes_part).orderBy("t", ID)
    repeats = F.col("t") - F.lag("t").over(order) <= cfg.duplicate_ms
    return rows.withColumn(RULE, F.when(takes_part & repeats, DUPLICATE).otherwise(F.col(RULE)))


def apply_cascade(
    txn: DataFrame, cfg: RuleConfig = DEFAULT_RULES, history: DataFrame | None = None, crowds: Crowded | None = None
) -> DataFrame:
    """Input rows plus rule_triggered, severity, alert_id, fraud_flag, dist_km.

    The rules run on narrow rows; full rows are shuffled once, by their unique
    id, to meet their verdicts.  ``history`` holds earlier rows (the
    ``HISTORY`` columns) that count as context and are not returned; it must
    reach back ``lookback_ms`` before the first input row.  ``crowds`` is what ``crowded`` says of ``txn``.
    """
    unknown = set(cfg.rule_order) - set(SEVERITY)
    if unknown or len(set(cfg.rule_order)) < len(cfg.rule_order):
        raise ValueError(f"rules must be known and named once: {cfg.rule_order}")
    if single_pass(cfg):
        return stamp(_join_verdicts(txn, cfg, history, crowds))
    if history is not None:
        raise ValueError("history needs velocity (3 within twice the duplicate window) to come first")
    return stamp(_rule_by_rule(txn, cfg))


def _join_verdicts(txn: DataFrame, cfg: RuleConfig, history: DataFrame | None, crowds: Crowded | None) -> DataFrame:
    context = txn.select(*HISTORY)
    if history is not None:
        context = context.unionByName(history.select(*HISTORY))
    verdicts = score(context, cfg, crowds).withColumn("_judged", F.lit(True))
    at = cfg.rule_order.index(VELOCITY)
    before, after = cfg.rule_order[:at], cfg.rule_order[at + 1 :]
    off = off_hours_large(cfg=cfg)
    rule = F.when(F.col("_judged"), F.col(RULE))
    if OFF_HOURS in before:
        rule = F.when(off, OFF_HOURS).otherwise(rule)
    stopped = has_history() & F.col("_judged").isNull()
    if OFF_HOURS in before:
        stopped = stopped & ~off
    rule = F.when(stopped, VELOCITY).otherwise(rule)
    # Rows without a history skip the stateful rules, not this one.
    if OFF_HOURS in after:
        rule = F.when(~has_history() & off, OFF_HOURS).otherwise(rule)
    return txn.join(by_shuffle(verdicts), ID, "left").withColumn(RULE, rule).drop("_judged")


def _rule_by_rule(txn: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Any order and any thresholds: each rule sees what the earlier ones left.

    Each step but the last is checkpointed to shared storage, else every rule
    would compute all earlier ones again.
    """
    ensure_checkpoint_dir(txn.sparkSession)
    tagged = txn.select(*HISTORY).withColumns(
        {RULE: F.lit(None).cast("string"), "dist_km": F.lit(None).cast("double")}
    )
    for rule in cfg.rule_order:
        alive = tagged.filter(F.col(RULE).isNull()).drop(RULE, "dist_km")
        hits = RULES[rule](alive, cfg)
        distance = F.col("dist_km") if rule == GEO else F.lit(None).cast("double")
        hits = hits.select(ID, F.col(RULE).alias("_rule"), distance.alias("_dist"))
        tagged = (
            tagged.join(hits, ID, "left")
            .withColumn(RULE, F.coalesce(RULE, "_rule"))
            .withColumn("dist_km", F.coalesce("dist_km", "_dist"))
            .drop("_rule", "_dist")
        )
        if rule != cfg.rule_order[-1]:
            tagged = tagged.checkpoint()
    return txn.join(by_shuffle(tagged.select(ID, RULE, "dist_km")), ID, "left")


def _by_rule(values) -> Column:
    return reduce(
        lambda chain, rule: chain.when(F.col(RULE) == rule, values(rule)),
        SEVERITY,
        F.when(F.lit(False), F.lit(None).cast("string")),
    )


def alert_key() -> Column:
    """What an alert id is the digest of: as good a key, and much shorter where it is compressed."""
    return F.concat_ws("|", ID, RULE)


def alert_ids() -> Column:
    """The alert id of a row that carries a verdict."""
    return _by_rule(alert_id)


def stamp(judged: DataFrame) -> DataFrame:
    """Add severity, alert id and flag to rows that carry a verdict."""
    return judged.withColumns(
        {
            "severity": _by_rule(lambda rule: F.lit(SEVERITY[rule])),
            "alert_id": alert_ids(),
            "fraud_flag": F.col(RULE).isNotNull(),
        }
    )


RULES = {
    VELOCITY: velocity_alerts,
    GEO: geo_anomaly_alerts,
    OFF_HOURS: off_hours_alerts,
    DUPLICATE: duplicate_alerts,
}
