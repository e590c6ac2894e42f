"""The registered queries: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.config import DEFAULT_RULES, DUPLICATE, GEO, GEO_ORDER, OFF_HOURS, VELOCITY, load_rule_config
from txnflow.functions import (
    clamp_to_thousand,
    date_key,
    event_millis,
    format_km,
    haversine_km,
    json_field,
    local_time,
    period_label,
    time_key,
    token_account,
)
from txnflow.operators import context, dims, enrich, facts, normalise, rules, tables, validate
from txnflow.plans import reports
from txnflow.plans.batch import (
    Warehouse,
    release_held,
    release_late,
    replay,
    replay_once,
    run_batch,
    store_facts,
)
from txnflow.schemas import CUSTOMER_CSV, GENERATED_TXN, JSON_CHANNELS, MESSAGE_FIELDS
from txnflow.session import COMPRESSION, ROCKSDB_PROVIDER, scratch_table, stored
from txnflow.sources import demo, files, messages
from txnflow.streaming import cascade, keyed, windows

WITH_GEO = DEFAULT_RULES.with_options(rule_order=GEO_ORDER)

# Column names of the channel systems, by message field.
CHANNEL_LAYOUTS = {
    "ATM": {"ref_no": "transaction_id", "amt": "amount", "acct_no": "account_masked"},
    "POS": {"receipt": "transaction_id", "total": "amount", "shop": "merchant_id"},
    "mobile": {"id": "transaction_id", "at": "timestamp", "value": "amount"},
    "internet": {"order_id": "transaction_id", "user": "customer_id"},
}


def _number():
    return F.substring("transaction_id", 4, 30).cast("bigint")


# ---- rules ------------------------------------------------------------------


def velocity_alerts(spark, d):
    return rules.velocity_alerts(demo.transactions(spark, d))


def geo_anomaly_alerts(spark, d):
    return rules.geo_anomaly_alerts(demo.transactions(spark, d)).withColumn("dist_km", format_km(F.col("dist_km")))


def duplicate_alerts(spark, d):
    return rules.duplicate_alerts(demo.transactions(spark, d))


def off_hours_alerts(spark, d):
    return rules.off_hours_alerts(demo.transactions(spark, d))


def _verdicts(scored: DataFrame) -> DataFrame:
    return scored.select("transaction_id", "rule_triggered", "severity", "alert_id", "fraud_flag")


def cascade_verdicts(spark, d):
    return _verdicts(rules.apply_cascade(demo.transactions(spark, d)))


def cascade_with_geo(spark, d):
    scored = rules.apply_cascade(demo.transactions(spark, d), WITH_GEO)
    return scored.select(
        "transaction_id",
        "rule_triggered",
        "severity",
        "alert_id",
        "fraud_flag",
        format_km(F.col("dist_km")).alias("dist_km"),
    )


def cascade_duplicate_first(spark, d):
    """An order the single pass cannot take: rule by rule."""
    cfg = DEFAULT_RULES.with_options(rule_order=(DUPLICATE, VELOCITY))
    return _verdicts(rules.apply_cascade(demo.transactions(spark, d), cfg))


# ---- star schema ------------------------------------------------------------


def fact_txn(spark, d):
    return facts.fact_txn(rules.apply_cascade(demo.transactions(spark, d)))


def fact_txn_off_hours_unmarked(spark, d):
    cfg = DEFAULT_RULES.with_options(off_hours_marks_fact=False)
    scored = rules.apply_cascade(demo.transactions(spark, d), cfg)
    return facts.fact_txn(scored, cfg).select("transaction_id", "fraud_flag", "alert_id")


def fact_alert(spark, d):
    return facts.fact_alert(rules.apply_cascade(demo.transactions(spark, d)))


def _plain(df: DataFrame, **types: str) -> DataFrame:
    """Cast result columns whose form depends on the reader (decimals, dates, nullable integers)."""
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def _enriched(rows: DataFrame) -> DataFrame:
    columns = rows.select("transaction_id", "customer_id", "account_masked", *enrich.CUSTOMER_COLUMNS)
    return _plain(columns, home_lat="double", home_lon="double")


def customer_enrichment(spark, d):
    return _enriched(enrich.enrich_customers(demo.transactions(spark, d), demo.customers(spark, d)))


def customer_enrichment_hot_keys(spark, d):
    """The shuffled lookup, as for a dimension too large to broadcast."""
    rows = enrich.enrich_customers(demo.transactions(spark, d), demo.customers(spark, d), broadcast_bytes=-1)
    return _enriched(rows)


_houses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, d: str) -> Warehouse:
    """Facts, alerts and dimensions of one data set, loaded once per session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _houses:
        house = Warehouse(spark, scratch_table(spark, "warehouse"))
        house.seed(demo.customers(spark, d))
        txn = demo.transactions(spark, d)
        judged = context.tag_context(rules.apply_cascade(txn))
        scored = enrich.enrich_customers(judged, house.customers, source=txn)
        scored.write.parquet(house.path("scored"), compression=COMPRESSION)
        store_facts(spark.read.parquet(house.path("scored")), house)
        _houses[key] = house
    return _houses[key]


def _scored(house: Warehouse) -> DataFrame:
    return house.spark.read.parquet(house.path("scored"))


def _newest(table: DataFrame, column: str):
    return table.agg(F.max(column)).scalar()


def alert_messages(spark, d):
    """Published alerts, read back from their JSON."""
    sent = facts.alert_messages(_scored(warehouse(spark, d)))
    return sent.select(
        *[json_field("value", f).alias(f) for f in ("transaction_id", "rule_triggered", "alert_id", "amount")]
    )


def alert_reconciliation(spark, d):
    house = warehouse(spark, d)
    return reports.reconcile_alerts(house.facts, house.alerts)


def recent_velocity_reconciliation(spark, d):
    house = warehouse(spark, d)
    joined = reports.reconcile_alerts(house.facts, house.alerts).filter(F.col("rule_triggered") == VELOCITY)
    return joined.orderBy(F.desc("detected_at"), "transaction_id").limit(5)


def dim_time_activity(spark, d):
    house = warehouse(spark, d)
    return reports.activity_per_minute_of_day(house.facts, house.minutes)


def dim_calendar_activity(spark, d):
    house = warehouse(spark, d)
    return _plain(reports.activity_per_day(house.facts, house.calendar), full_date="string")


def calendar_from_data(spark, d):
    """Calendar rows for the days the transactions fall on."""
    days = demo.transactions(spark, d).select(F.to_date("event_ts").alias("full_date")).distinct()
    return _plain(dims.calendar_of(days), full_date="string")


def dim_customer_upsert(spark, d):
    """Customers, then a second delivery that changes some and adds others."""
    path = scratch_table(spark, "dim_customer")
    first = demo.customers(spark, d)
    tables.upsert(first, path, "customer_id")
    moved = (F.substring("customer_id", 4, 30).cast("bigint") + 500).cast("string")
    second = first.withColumn(
        "customer_id", F.concat(F.lit("CUS"), F.lpad(moved, F.greatest(F.lit(6), F.length(moved)), F.lit("0")))
    ).withColumn("risk_score", F.col("risk_score") + 1)
    tables.upsert(second, path, "customer_id")
    return _plain(tables.read_current(spark, path, first.schema), home_lat="double", home_lon="double")


# ---- projections ------------------------------------------------------------


def context_tags(spark, d):
    tagged = context.tag_context(demo.transactions(spark, d))
    return tagged.select(
        "transaction_id", "is_peak_hour", "is_business_hour", "is_holiday", "is_maintenance", "is_night_large_risk"
    )


def maintenance_hold(spark, d):
    now, held = context.split_maintenance(demo.transactions(spark, d))
    return now.agg(F.lit("now").alias("part"), F.count("*").alias("n")).unionByName(
        held.agg(F.lit("held").alias("part"), F.count("*").alias("n"))
    )


def time_keys(spark, d):
    txn = demo.transactions(spark, d)
    return txn.select(
        "transaction_id",
        time_key("event_ts").alias("time_id"),
        date_key("event_ts").alias("date_id"),
        period_label(F.hour("event_ts")).alias("period_label"),
        F.weekday("event_ts").alias("day_of_week"),
        clamp_to_thousand(F.col("amount") / 7.0).alias("amount_clamped"),
    )


def mask_pii(spark, d):
    return context.mask_pii(demo.customers_raw(spark, d)).select(
        "customer_id", "account_masked", "phone_masked", "national_id_masked", "segment"
    )


def token_accounts(spark, d):
    raw = demo.customers_raw(spark, d)
    return raw.select("customer_id", token_account("account_number").alias("account_token"))


def customer_csv(spark, d):
    """Customers through a CSV file with clear and masked personal data; only the dimension's columns are kept."""
    path = scratch_table(spark, "customers_csv")
    clear = demo.customers_raw(spark, d)
    masked = context.mask_pii(clear).select("customer_id", "account_masked", "phone_masked", "national_id_masked")
    wide = clear.join(masked, "customer_id").withColumn("avg_txn_multiplier", F.lit(1.5))
    wide.select(*CUSTOMER_CSV.names).write.csv(path, header=True)
    return _plain(files.read_customers(spark, path), home_lat="double", home_lon="double")


RULE_DOCUMENT = """{
  "night_hours": {"start": 21, "end": 5},
  "maintenance_windows": [
    {"day_of_week": 6, "start_hour": 1, "end_hour": 3},
    {"day_of_week": 2, "start_hour": 22, "end_hour": 23},
    {"date": "2024-01-15", "start_hour": 8, "end_hour": 11}
  ],
  "holidays_2024": ["2024-01-01", "2024-01-20"],
  "thresholds": {"off_hours_large_txn_vnd": 20000000, "velocity_window_seconds": 90}
}"""


def rule_document(spark, d):
    """Rules and windows from a document: verdicts, and which rows its three maintenance windows hold."""
    path = scratch_table(spark, "rule_document")
    spark.createDataFrame([(RULE_DOCUMENT,)], "value string").coalesce(1).write.text(path)
    cfg = load_rule_config(spark, path)
    judged = rules.apply_cascade(context.tag_context(demo.transactions(spark, d), cfg), cfg)
    return judged.select("transaction_id", "rule_triggered", "is_maintenance", "is_holiday", "is_night_large_risk")


def home_distance(spark, d):
    """Distance of each transaction from its customer's home."""
    rows = enrich.enrich_customers(demo.transactions(spark, d), demo.customers(spark, d))
    home = [F.col(c).cast("double") for c in ("home_lat", "home_lon")]
    km = haversine_km(*home, F.col("merchant_lat"), F.col("merchant_lon"))
    return rows.select("transaction_id", F.round(km, 3).alias("home_km"))


def _channel_tables(spark, d):
    txn = demo.transactions(spark, d)
    out = {}
    for channel, renames in CHANNEL_LAYOUTS.items():
        own = {field: name for name, field in renames.items()}
        rows = txn.filter(F.col("channel") == channel).withColumn("account_number", F.lit("VCB0000000000"))
        out[channel] = (rows.withColumnsRenamed(own).drop("channel", "loaded_at", "event_ts"), renames)
    return out


def normalise_channels(spark, d):
    return normalise.normalise_channels(_channel_tables(spark, d))


def text_rows(spark, d):
    """Message fields as text, as a CSV has them, some of them unreadable."""
    n = _number()
    txn = demo.transactions(spark, d, wide=True).select(*MESSAGE_FIELDS)
    faults = {
        "amount": F.when(n % 40 == 3, "x1").otherwise(F.col("amount").cast("string")),
        "merchant_lat": F.when(n % 40 == 13, "").otherwise(F.col("merchant_lat").cast("string")),
        "fraud_type": F.when(n % 40 == 23, "nan").otherwise(F.coalesce("fraud_type", F.lit(""))),
        "merchant_lon": F.when(n % 40 == 33, "abc").otherwise(F.col("merchant_lon").cast("string")),
        "timestamp": F.when(n % 40 == 39, "soon").otherwise(F.col("timestamp")),
        "fraud_label": F.col("fraud_label").cast("string"),
    }
    return txn.withColumns(faults)


def type_rows(spark, d):
    typed = normalise.type_rows(text_rows(spark, d)).drop("loaded_at")
    return _plain(typed.withColumn("errors", F.array_join("errors", ",")), amount="string")


def staging_load(spark, d):
    """Staging and rejects through a CSV file, loaded twice (truncate and load)."""
    source, target, rejects = (scratch_table(spark, n) for n in ("txn_csv", "staging", "rejects"))
    text_rows(spark, d).write.csv(source, header=True)
    for _ in range(2):
        tables.load_staging(files.read_text_csv(spark, source), target, rejects)
    loaded, bad = spark.read.parquet(target), spark.read.parquet(rejects)
    return loaded.agg(
        F.lit("staging").alias("table_name"), F.count("*").alias("n"), F.sum("amount").alias("amount")
    ).unionByName(
        bad.agg(F.lit("rejects").alias("table_name"), F.count("*").alias("n"), F.sum("amount").alias("amount"))
    )


# ---- messages and quality ---------------------------------------------------


def demo_messages(spark, d) -> DataFrame:
    """JSON messages, some broken: no amount, currency and status; a timestamp
    or an amount that cannot be read; cut-off JSON.  Some come as an array."""
    n = _number()
    txn = demo.transactions(spark, d, wide=True)
    gone = n % 50 == 12
    body = F.to_json(
        F.struct(
            "transaction_id",
            F.when(n % 50 == 17, "not-a-time").otherwise(F.col("timestamp")).alias("timestamp"),
            "account_masked",
            "customer_id",
            "channel",
            "merchant_id",
            "merchant_province",
            "merchant_lat",
            "merchant_lon",
            F.when(gone, None).when(n % 50 == 22, "12.5").otherwise(F.col("amount").cast("string")).alias("amount"),
            F.when(~gone, F.col("currency")).alias("currency"),
            F.when(~gone, F.col("status")).alias("status"),
            "fraud_label",
            "fraud_type",
        )
    )
    value = (
        F.when(n % 50 == 37, F.left(body, F.lit(20)))
        .when(n % 50 == 47, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
    )
    return txn.select(F.lit(None).cast("string").alias("key"), value.alias("value"), "loaded_at", "event_ts", "account_masked")


def _validated(spark, d):
    return validate.validate(messages.parse(demo_messages(spark, d), "loaded_at"))


def validate_records(spark, d):
    checked = _validated(spark, d).select(
        "transaction_id", "amount", "event_ts", F.array_join("error_reasons", ",").alias("error_reasons")
    )
    return _plain(checked, amount="string")


def dead_letters(spark, d):
    dead = validate.dead_letters(_validated(spark, d))
    return dead.groupBy(F.array_join("error_reasons", ",").alias("error_reasons")).agg(F.count("*").alias("n"))


def dead_letter_replay(spark, d):
    """Dead letters written, replayed to the raw folder, read and validated again."""
    path, raw = scratch_table(spark, "dead_letter"), scratch_table(spark, "raw")
    validate.dead_letters(_validated(spark, d)).write.parquet(path)
    replay(spark.read.parquet(path), raw)
    again = validate.validate(messages.parse(messages.letter_messages(spark, raw)))
    return again.agg(F.count("*").alias("replayed"), F.count_if(F.size("error_reasons") > 0).alias("rejected"))


def dead_letter_replay_keyed(spark, d):
    """Letters with a key and line ends in their text, replayed twice: each comes back whole, and once."""
    house, raw = Warehouse(spark, scratch_table(spark, "house")), scratch_table(spark, "raw")
    house.seed(demo.customers(spark, d))
    lines = F.concat(
        F.lit('{"transaction_id": "'), "transaction_id", F.lit('",\n "timestamp": "'), "timestamp", F.lit('"}')
    )
    sent = demo.transactions(spark, d).filter(_number() % 7 == 3)
    sent = sent.select(F.col("transaction_id").alias("key"), lines.alias("value"))
    run_batch(sent, house, audit=False)
    for _ in range(2):
        replay_once(house, raw)
    back = messages.letter_messages(spark, raw)
    return back.groupBy("key", "value").agg(F.count("*").alias("n"))


def array_messages(spark, d):
    """Messages that are arrays of one to five transactions, some elements broken."""
    n = _number()
    body = F.struct(
        "transaction_id",
        "timestamp",
        "account_masked",
        "channel",
        F.when(n % 11 != 4, F.col("amount")).alias("amount"),
        "currency",
        "status",
    )
    sent = demo.transactions(spark, d).groupBy(F.floor(n / 5)).agg(F.to_json(F.collect_list(body)).alias("value"))
    checked = validate.validate(messages.parse(sent.select(F.lit(None).cast("string").alias("key"), "value")))
    reasons = F.array_join("error_reasons", ",").alias("error_reasons")
    return checked.select("transaction_id", "amount", "event_ts", reasons).withColumn("amount", F.col("amount").cast("string"))


def dedupe_redelivered(spark, d):
    """Every message delivered twice counts once."""
    txn = demo.transactions(spark, d)
    return validate.dedupe_transactions(txn.unionByName(txn)).select("transaction_id", "event_ts", "amount")


def error_rate(spark, d):
    return reports.error_rate(_validated(spark, d))


def dq_report(spark, d):
    txn = demo.transactions(spark, d).withColumn("account_number", F.concat(F.lit("VCB"), F.col("customer_id")))
    return reports.quality_report(txn)


def audit_trail(spark, d):
    return facts.audit_log(_scored(warehouse(spark, d)))


def batch_load(spark, d):
    """The whole batch job, run twice on the same messages: counts per table."""
    house = Warehouse(spark, scratch_table(spark, "house"))
    house.seed(demo.customers(spark, d))
    sent = stored(demo_messages(spark, d).drop("event_ts", "account_masked"), "sent")
    for _ in range(2):
        run_batch(sent, house)
    return reports.table_counts(
        {
            "fact_txn": house.facts,
            "fact_alert": house.alerts,
            "dead_letter": spark.read.parquet(house.path("dead_letter")),
            "dim_customer": house.customers,
            "audit_log": spark.read.parquet(house.path("audit_log")),
        }
    )


def maintenance_release(spark, d):
    """Rows held during maintenance and loaded by a later run: verdicts as without a pause."""
    house = Warehouse(spark, scratch_table(spark, "house"))
    house.seed(demo.customers(spark, d))
    run_batch(demo_messages(spark, d).drop("event_ts"), house, hold_maintenance=True, audit=False)
    before = stored(house.facts.select("transaction_id", F.lit(True).alias("loaded_first")), "before")
    run_batch(release_held(spark, house), house, audit=False)
    first = F.coalesce("loaded_first", F.lit(False)).alias("loaded_first")
    return _fact_verdicts(house).join(before, "transaction_id", "left").select("transaction_id", "rule_triggered", first)


def _fact_verdicts(house: Warehouse) -> DataFrame:
    """Every fact with the rule of its alert."""
    alerts = house.alerts.select("alert_id", "rule_triggered")
    return house.facts.join(alerts, "alert_id", "left").select("transaction_id", "rule_triggered")


def batch_in_parts(spark, d):
    """Loaded by three runs, one after another in time: verdicts as of one run."""
    house = Warehouse(spark, scratch_table(spark, "house"))
    house.seed(demo.customers(spark, d))
    sent = stored(demo_messages(spark, d).drop("account_masked"), "sent")
    early, late = sent.agg(F.percentile_approx(event_millis("event_ts"), [0.3, 0.6])).first()[0]
    at = event_millis("event_ts")
    for part in (at <= early, (at > early) & (at <= late), at > late):
        run_batch(sent.filter(part).drop("event_ts"), house, audit=False)
    return _fact_verdicts(house)


# ---- reports ----------------------------------------------------------------

REPORT_DAY = "2024-01-15"


def eod_report(spark, d):
    house = warehouse(spark, d)
    return reports.end_of_day(house.dated_facts, house.dated_alerts, REPORT_DAY)


def eod_report_empty_day(spark, d):
    house = warehouse(spark, d)
    return _plain(reports.end_of_day(house.dated_facts, house.dated_alerts, "2031-01-01"), fraud_count="double")


def total_transactions(spark, d):
    return reports.count_rows(warehouse(spark, d).facts)


def total_alerts(spark, d):
    return reports.count_rows(warehouse(spark, d).alerts)


def fraud_rate(spark, d):
    return reports.fraud_rate(warehouse(spark, d).facts)


def alert_latency(spark, d):
    alerts = warehouse(spark, d).dated_alerts
    return reports.alert_latency(alerts, _newest(alerts, "detected_at"))


def clean_count(spark, d):
    return reports.clean_count(warehouse(spark, d).facts)


def masking_violations(spark, d):
    return reports.masking_violations(warehouse(spark, d).facts)


def volume_per_minute(spark, d):
    return reports.volume_per_minute(warehouse(spark, d).facts)


def volume_last_hour(spark, d):
    table = warehouse(spark, d).dated_facts
    return reports.volume_per_minute(table, _newest(table, "loaded_at"))


def fraud_per_minute(spark, d):
    return reports.volume_per_minute(warehouse(spark, d).facts, fraud_only=True)


def fraud_last_hour(spark, d):
    table = warehouse(spark, d).dated_facts
    return reports.volume_per_minute(table, _newest(table, "loaded_at"), fraud_only=True)


def alerts_by_rule(spark, d):
    return reports.alerts_by_rule(warehouse(spark, d).alerts)


def alerts_by_rule_severity(spark, d):
    return reports.alerts_by_rule_severity(warehouse(spark, d).alerts)


def volume_by_channel(spark, d):
    return reports.volume_by_channel(warehouse(spark, d).facts)


def top_fraud_merchants(spark, d):
    return reports.top_fraud_merchants(warehouse(spark, d).facts)


def recent_alerts(spark, d):
    return reports.recent_alerts(warehouse(spark, d).alerts)


def recent_duplicate_alerts(spark, d):
    return reports.recent_alerts(warehouse(spark, d).alerts, 5, DUPLICATE)


def recent_by_prefix(spark, d):
    return reports.recent_by_prefix(warehouse(spark, d).facts, "TXN", "V2")


def rows_by_id_pattern(spark, d):
    return reports.by_id_pattern(warehouse(spark, d).facts, "TXN%005")


def rows_by_prefix_in_order(spark, d):
    """Every row whose id has a prefix, oldest first."""
    return reports.recent_by_prefix(warehouse(spark, d).facts, "TXN000000", n=None)


def holiday_fraud_rate(spark, d):
    house = warehouse(spark, d)
    return reports.fraud_by_calendar(house.facts, house.calendar, "is_holiday", "is_weekend")


def period_fraud_rate(spark, d):
    house = warehouse(spark, d)
    return reports.fraud_by_time(house.facts, house.minutes, "period_label", "is_peak_hour", "is_business_hour")


def segment_fraud_rate(spark, d):
    house = warehouse(spark, d)
    return reports.fraud_by_segment(enrich.enrich_customers(house.facts, house.customers))


def _labelled(spark, d):
    return context.tag_context(demo.transactions(spark, d))


def dataset_summary(spark, d):
    return reports.dataset_summary(_labelled(spark, d))


def channel_share(spark, d):
    return reports.share_of(demo.transactions(spark, d), "channel")


def fraud_type_share(spark, d):
    return reports.share_of(demo.transactions(spark, d).filter("fraud_label = 1"), "fraud_type")


def hour_label_matrix(spark, d):
    return reports.hour_label_matrix(demo.transactions(spark, d))


def amount_histogram(spark, d):
    return reports.amount_histogram(demo.transactions(spark, d))


def fraud_samples(spark, d):
    return reports.fraud_samples(demo.transactions(spark, d), VELOCITY, 5)


def fraud_samples_of_all_kinds(spark, d):
    """Five rows of the first account for velocity, four for geo, the five first rows of all for off-hours."""
    txn, out = demo.transactions(spark, d), None
    for kind, k, one_account in ((VELOCITY, 5, True), (GEO, 4, True), (OFF_HOURS, 5, False)):
        part = reports.fraud_samples(txn, kind, k, one_account).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def sorted_dataset(spark, d):
    """Normal and labelled rows in one table, in time order."""
    txn = demo.transactions(spark, d)
    both = txn.filter("fraud_label = 0").unionByName(txn.filter("fraud_label = 1"))
    return both.select("timestamp", "transaction_id", "fraud_label").orderBy("timestamp", "transaction_id")


def table_counts(spark, d):
    house = warehouse(spark, d)
    return reports.table_counts(
        {
            "dim_customer": house.customers,
            "dim_calendar": house.calendar,
            "dim_time": house.minutes,
            "fact_txn": house.facts,
            "fact_alert": house.alerts,
        }
    )


def latency_percentiles(spark, d):
    return reports.latency_percentiles(warehouse(spark, d).alerts)


def load_completeness(spark, d):
    return reports.load_completeness(warehouse(spark, d).facts, "TXN", expected=1)


def load_completeness_of_sent(spark, d):
    """Against the number of messages sent: all have arrived, but of one range of ids only that range."""
    house, sent = warehouse(spark, d), demo.transactions(spark, d).count()
    parts = [
        reports.load_completeness(house.facts, prefix, sent).withColumn("prefix", F.lit(prefix))
        for prefix in ("TXN", "TXN00000002")
    ]
    return parts[0].unionByName(parts[1])


def kpi_status(spark, d):
    house = warehouse(spark, d)
    return reports.kpi_status(house.facts, house.alerts, _validated(spark, d), _newest(house.alerts, "detected_at"))


# ---- files ------------------------------------------------------------------


def channel_files(spark, d):
    """Exported per channel, read back, normalised."""
    folder = scratch_table(spark, "channels")
    rows = _labelled(spark, d)
    wide = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit("x").cast(f.dataType).alias(f.name))
            for f in GENERATED_TXN.fields
        ]
    )
    tables.export_channels(wide, folder)
    read = files.read_channel_files(spark, folder, arrays=False)
    return normalise.normalise_channels({c: (t, {}) for c, t in read.items()})


def channel_array_files(spark, d):
    """As ``channel_files``, but mobile and internet deliver files of one pretty-printed array each."""
    folder = scratch_table(spark, "channels")
    rows = _labelled(spark, d)
    wide = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit("x").cast(f.dataType).alias(f.name))
            for f in GENERATED_TXN.fields
        ]
    )
    tables.export_channels(wide, folder)
    for channel in JSON_CHANNELS:
        own = wide.filter(F.col("channel") == channel)
        part = F.floor(_number() / 5000).alias("part")
        arrays = own.groupBy(part).agg(F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value"))
        arrays.write.mode("overwrite").partitionBy("part").text(files.channel_path(folder, channel), compression="gzip")
    read = files.read_channel_files(spark, folder, arrays=True)
    return normalise.normalise_channels({c: (t, {}) for c, t in read.items()})


def raw_archive(spark, d):
    path = scratch_table(spark, "raw")
    tables.archive_raw(demo.transactions(spark, d), path)
    back = spark.read.json(path, schema="event_date date, channel string, transaction_id string, amount bigint")
    counts = back.groupBy("event_date", "channel").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return _plain(counts, event_date="string")


def idempotent_sink(spark, d):
    """Facts and alerts stored twice; counts as after the first time."""
    scored = _scored(warehouse(spark, d))
    house = Warehouse(spark, scratch_table(spark, "house"))
    store_facts(scored, house)
    store_facts(scored, house)
    return reports.table_counts({"fact_txn": house.facts, "fact_alert": house.alerts})


# ---- streams ----------------------------------------------------------------


def _halves(spark, d) -> tuple[DataFrame, list]:
    sent = demo_messages(spark, d)
    low, high = demo.transactions(spark, d).agg(F.min("event_ts"), F.max("event_ts")).first()
    middle = local_time(low + (high - low) / 2)
    return sent, [F.col("event_ts") < middle, F.col("event_ts") >= middle]


def _run(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _stream_into(spark, d, start):
    """Deliver the messages in two halves, running the stream to the end of each; the folder they were delivered to."""
    folder = scratch_table(spark, "topic")
    sent, parts = _halves(spark, d)
    for part in parts:
        sent.filter(part).select("value").write.mode("append").text(folder, compression="gzip")
        _run(start(messages.file_stream(spark, folder)))
    return folder


def _streamed_house(spark, d, cfg) -> Warehouse:
    house = Warehouse(spark, scratch_table(spark, "house"))
    house.seed(demo.customers(spark, d))
    sink = cascade.CascadeSink(house, cfg)
    _stream_into(spark, d, lambda s: cascade.start_cascade(s, sink, house.path("checkpoint"), availableNow=True))
    return house


def stream_cascade(spark, d):
    house = _streamed_house(spark, d, DEFAULT_RULES)
    alerts = house.alerts.select("transaction_id", "rule_triggered", "severity")
    return house.facts.select("transaction_id", "fraud_flag", "alert_id").join(alerts, "transaction_id", "left")


def stream_cascade_with_geo(spark, d):
    return _streamed_house(spark, d, WITH_GEO).alerts.select("transaction_id", "rule_triggered", "alert_id")


def _late_accounts(spark, d):
    """Messages, and the accounts that deliver theirs when all others have: none has one in the last two hours."""
    sent = demo_messages(spark, d)
    end = local_time(sent.agg(F.max("event_ts")).first()[0]) - F.expr("interval 2 hours")
    recent = sent.filter(F.col("event_ts") >= end).select("account_masked").distinct()
    picked = sent.filter(F.right("account_masked", F.lit(1)) == "3").join(recent, "account_masked", "left_anti")
    return sent, picked.select("account_masked").distinct()


def _late_deliveries(spark, d, start):
    sent, accounts = _late_accounts(spark, d)
    folder = scratch_table(spark, "topic")
    for part in ("left_anti", "left_semi"):
        sent.join(accounts, "account_masked", part).select("value").write.mode("append").text(folder, compression="gzip")
        _run(start(messages.file_stream(spark, folder)))


def stream_late_rows(spark, d):
    """Accounts whose messages arrive hours late: set aside by the stream, then loaded by a batch run.

    Accounts with a message in the last two hours arrive in time; verdicts are
    per account, so all are as if everything had.
    """
    house = Warehouse(spark, scratch_table(spark, "house"))
    house.seed(demo.customers(spark, d))
    sink = cascade.CascadeSink(house)
    _late_deliveries(spark, d, lambda s: cascade.start_cascade(s, sink, house.path("checkpoint"), availableNow=True))
    run_batch(release_late(spark, house), house, audit=False)
    return _fact_verdicts(house)


def _closed_minutes(spark, d) -> tuple[DataFrame, str]:
    """The minutes that the watermark has closed, and the folder of the delivered messages."""
    out, checkpoint = scratch_table(spark, "minutes"), scratch_table(spark, "checkpoint")

    def start(stream):
        counts = windows.volume_per_minute(windows.accepted(stream))
        writer = counts.writeStream.outputMode("append").format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    folder = _stream_into(spark, d, start)
    return spark.read.parquet(out), folder


def stream_volume_per_minute(spark, d):
    """Final minutes only: those the watermark has closed; ``stream_volume_every_minute`` has all."""
    return _closed_minutes(spark, d)[0]


def stream_volume_every_minute(spark, d):
    """The minutes the watermark has closed, then the rest in batch: open minutes and late rows."""
    closed, folder = _closed_minutes(spark, d)
    rest = windows.rest_per_minute(windows.accepted(messages.file_messages(spark, folder)), closed)
    return closed.unionByName(rest).groupBy("time").agg(F.sum("value").alias("value"))


def stream_totals_by_channel(spark, d):
    """Running totals in update mode; the last update of each channel."""
    out, checkpoint = scratch_table(spark, "totals"), scratch_table(spark, "checkpoint")

    def save(df, batch_id):
        df.write.parquet(f"{out}/batch_id={batch_id}", mode="overwrite")

    def start(stream):
        counts = windows.totals_by_channel(windows.accepted(stream))
        writer = counts.writeStream.outputMode("update").foreachBatch(save)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _stream_into(spark, d, start)
    latest = F.max_by(F.struct("total", "fraud", "fraud_pct"), "batch_id")
    return spark.read.parquet(out).groupBy("channel").agg(latest.alias("last")).select("channel", "last.*")


def _stateful(spark, d, operator, deliver):
    """The output of a stateful operator, whose state store must be RocksDB."""
    out, checkpoint = scratch_table(spark, "verdicts"), scratch_table(spark, "checkpoint")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)

    def start(stream):
        writer = operator(windows.accepted(stream)).writeStream.outputMode("append").format("parquet")
        writer = writer.option("path", out).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    spark.conf.set(provider, ROCKSDB_PROVIDER)
    try:
        deliver(spark, d, start)
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(out)


def stream_keyed_cascade(spark, d):
    """The stateful operator.  A backlog read in one go is fine: its accounts are split by time."""
    verdicts = _stateful(spark, d, lambda rows: keyed.keyed_cascade(rows, WITH_GEO), _stream_into)
    return verdicts.select("transaction_id", "rule_triggered")


def stream_keyed_late(spark, d):
    """The same where some accounts deliver hours late: their rows come out as late."""
    verdicts = _stateful(spark, d, lambda rows: keyed.keyed_cascade(rows, WITH_GEO), _late_deliveries)
    return verdicts.select("transaction_id", "rule_triggered", "late")


def stream_minutes_late(spark, d):
    """Closed minutes, and how many rows of a closed minute came later."""
    counts = _stateful(spark, d, windows.minutes_and_late, _late_deliveries)
    return counts.groupBy("time", "late").agg(F.sum("value").alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        velocity_alerts,
        geo_anomaly_alerts,
        duplicate_alerts,
        off_hours_alerts,
        cascade_verdicts,
        cascade_with_geo,
        cascade_duplicate_first,
        fact_txn,
        fact_txn_off_hours_unmarked,
        fact_alert,
        customer_enrichment,
        customer_enrichment_hot_keys,
        alert_messages,
        alert_reconciliation,
        recent_velocity_reconciliation,
        dim_time_activity,
        dim_calendar_activity,
        calendar_from_data,
        dim_customer_upsert,
        context_tags,
        maintenance_hold,
        time_keys,
        mask_pii,
        token_accounts,
        customer_csv,
        rule_document,
        home_distance,
        normalise_channels,
        type_rows,
        staging_load,
        validate_records,
        dead_letters,
        dead_letter_replay,
        dead_letter_replay_keyed,
        array_messages,
        dedupe_redelivered,
        error_rate,
        dq_report,
        audit_trail,
        batch_load,
        maintenance_release,
        batch_in_parts,
        eod_report,
        eod_report_empty_day,
        total_transactions,
        total_alerts,
        fraud_rate,
        alert_latency,
        clean_count,
        masking_violations,
        volume_per_minute,
        volume_last_hour,
        fraud_per_minute,
        fraud_last_hour,
        alerts_by_rule,
        alerts_by_rule_severity,
        volume_by_channel,
        top_fraud_merchants,
        recent_alerts,
        recent_duplicate_alerts,
        recent_by_prefix,
        rows_by_id_pattern,
        rows_by_prefix_in_order,
        holiday_fraud_rate,
        period_fraud_rate,
        segment_fraud_rate,
        dataset_summary,
        channel_share,
        fraud_type_share,
        hour_label_matrix,
        amount_histogram,
        fraud_samples,
        fraud_samples_of_all_kinds,
        sorted_dataset,
        table_counts,
        latency_percentiles,
        load_completeness,
        load_completeness_of_sent,
        kpi_status,
        channel_files,
        channel_array_files,
        raw_archive,
        idempotent_sink,
        stream_cascade,
        stream_cascade_with_geo,
        stream_late_rows,
        stream_volume_per_minute,
        stream_volume_every_minute,
        stream_totals_by_channel,
        stream_keyed_cascade,
        stream_keyed_late,
        stream_minutes_late,
    )
}
