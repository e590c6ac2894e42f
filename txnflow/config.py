"""Rule thresholds and business calendar, read from one JSON document."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

VELOCITY, GEO, OFF_HOURS, DUPLICATE = "velocity", "geo_anomaly", "off_hours_large", "duplicate"

# Severity and alert-id prefix of each rule.
SEVERITY = {VELOCITY: "MEDIUM", GEO: "HIGH", OFF_HOURS: "HIGH", DUPLICATE: "LOW"}
ALERT_PREFIX = {VELOCITY: "ALT-V-", GEO: "ALT-G-", OFF_HOURS: "ALT-R3-", DUPLICATE: "ALT-D-"}

DEFAULT_ORDER = (VELOCITY, DUPLICATE, OFF_HOURS)
GEO_ORDER = (VELOCITY, GEO, DUPLICATE, OFF_HOURS)


@dataclass(frozen=True)
class RuleConfig:
    # Thresholds, hours and holidays the rules are defined with.
    velocity_count: int = 3
    velocity_window_seconds: int = 60
    duplicate_window_seconds: int = 30
    geo_anomaly_km: float = 300.0
    geo_anomaly_minutes: int = 30
    off_hours_large_txn_vnd: int = 50_000_000
    night_start: int = 22
    night_end: int = 6
    peak_hours: tuple[int, ...] = (8, 9, 10, 11, 13, 14, 15, 16)
    business_start: int = 8
    business_end: int = 17
    maintenance_weekday: int = 6
    maintenance_start: int = 1
    maintenance_end: int = 3
    # Further windows: (weekday or ISO date, first hour, last hour).
    more_maintenance: tuple[tuple[int | str, int, int], ...] = ()
    holidays: tuple[str, ...] = (
        "2025-01-01",
        "2025-01-28",
        "2025-01-29",
        "2025-01-30",
        "2025-01-31",
        "2025-02-01",
        "2025-02-02",
        "2025-02-03",
        "2025-04-07",
        "2025-04-30",
        "2025-05-01",
        "2025-09-02",
    )
    rule_order: tuple[str, ...] = DEFAULT_ORDER
    # False keeps fraud_flag/alert_id of off-hours hits unset in fact_txn.
    off_hours_marks_fact: bool = True

    @property
    def maintenance_windows(self) -> tuple[tuple[int | str, int, int], ...]:
        return ((self.maintenance_weekday, self.maintenance_start, self.maintenance_end), *self.more_maintenance)

    @property
    def velocity_ms(self) -> int:
        return self.velocity_window_seconds * 1000

    @property
    def duplicate_ms(self) -> int:
        return self.duplicate_window_seconds * 1000

    @property
    def geo_ms(self) -> int:
        return self.geo_anomaly_minutes * 60_000

    def with_options(self, **changes) -> RuleConfig:
        return replace(self, **changes)


DEFAULT_RULES = RuleConfig()


def load_rule_config(spark: SparkSession, path: str, **options) -> RuleConfig:
    """Read a rule document (one JSON object) from any path Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()[0]
    doc = json.loads(text)
    values: dict = {k: v for k, v in doc.get("thresholds", {}).items()}
    if "peak_hours" in doc:
        values["peak_hours"] = tuple(doc["peak_hours"])
    if "business_hours" in doc:
        values["business_start"] = doc["business_hours"]["start"]
        values["business_end"] = doc["business_hours"]["end"]
    if "night_hours" in doc:
        values["night_start"] = doc["night_hours"]["start"]
        values["night_end"] = doc["night_hours"]["end"]
    if doc.get("maintenance_windows"):
        days = [w["date"] if "date" in w else w["day_of_week"] for w in doc["maintenance_windows"]]
        windows = [(d, w["start_hour"], w["end_hour"]) for d, w in zip(days, doc["maintenance_windows"])]
        weekly = next((w for w in windows if isinstance(w[0], int)), (-1, 0, 0))  # no weekday is -1
        values["maintenance_weekday"], values["maintenance_start"], values["maintenance_end"] = weekly
        values["more_maintenance"] = tuple(w for w in windows if w != weekly)
    holidays = [day for key in sorted(doc) if key.startswith("holidays") for day in doc[key]]
    if holidays:
        values["holidays"] = tuple(holidays)
    values.update(options)
    return RuleConfig(**values)
