"""Column functions.  All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from datetime import datetime

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnflow.config import ALERT_PREFIX, DEFAULT_RULES, RuleConfig

EARTH_RADIUS_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- identifiers and masking ------------------------------------------------


def pad_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the zero-padded number; longer numbers are never cut."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def mask_account(c: Column | str) -> Column:
    return F.concat(F.lit("****"), F.right(_col(c), F.lit(4)))


def mask_phone(c: Column | str) -> Column:
    digits = F.regexp_replace(_col(c), "[^0-9]", "")
    return F.concat(F.left(digits, F.lit(3)), F.lit("****"), F.right(digits, F.lit(3)))


def mask_national_id(c: Column | str) -> Column:
    c = _col(c)
    return F.concat(F.left(c, F.lit(3)), F.lit("******"), F.right(c, F.lit(3)))


def token_account(c: Column | str) -> Column:
    """Join-safe account token, for callers whose last four digits collide."""
    return F.concat(F.lit("****"), F.sha2(_col(c), 256))


def alert_id(rule: str, transaction_id: Column | str = "transaction_id") -> Column:
    """Same id on every run, so replays meet the rows they wrote before; the whole digest, as it is a key."""
    digest = F.md5(F.concat_ws("|", _col(transaction_id), F.lit(rule)))
    return F.concat(F.lit(ALERT_PREFIX[rule]), F.upper(digest))


def has_value(c: Column | str) -> Column:
    """Neither null nor empty text."""
    return F.coalesce(_col(c).cast("string") != "", F.lit(False))


def null_tokens(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~c.isin("", "nan", "None"), c)


def json_field(message: Column | str, field: str) -> Column:
    """A field of a JSON message or of its first element; empty text if absent."""
    message = _col(message)
    return F.coalesce(
        F.get_json_object(message, f"$[0].{field}"), F.get_json_object(message, f"$.{field}"), F.lit("")
    )


# ---- time -------------------------------------------------------------------


# Text that ends with a date or a clock, so without a zone.
_ZONELESS = r"^[^T ]*([T ]\d{1,2}(:\d{1,2}(:\d{1,2}(\.\d*)?)?)?)?$"


def _since_1970(seconds: Column) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc_time(instant: Column) -> Column:
    """A point in time as a zone-free timestamp in UTC, whatever the session's zone."""
    return _since_1970(F.unix_micros(instant).cast("decimal(19,0)") / F.lit(1_000_000))


def millis_time(millis: Column | str) -> Column:
    """The zone-free timestamp that ``event_millis`` gave the number of."""
    return _since_1970(_col(millis).cast("decimal(19,0)") / F.lit(1000))


def parse_timestamp(c: Column | str) -> Column:
    """ISO-8601 text to a zone-free timestamp; null if it is not a timestamp.

    With an offset it becomes UTC, without one it stays as written.  The
    session's zone plays no part, so verdicts and dates are the same everywhere.
    """
    text = F.trim(_col(c))
    as_written = text.try_cast("timestamp_ntz")
    return F.when(text.rlike(_ZONELESS), as_written).otherwise(utc_time(F.try_to_timestamp(text)))


def local_time(value) -> Column:
    """A zone-free timestamp from a datetime, ISO text or column.

    Datetimes go as text: as a literal they would pass through Python's zone.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(value.isoformat() if isinstance(value, datetime) else value).cast("timestamp_ntz")


def event_millis(c: Column | str) -> Column:
    """Milliseconds since 1970 of a zone-free timestamp."""
    c = _col(c)
    hours = F.unix_date(c.cast("date")).cast("long") * 24 + F.hour(c)
    millis = F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("long")
    return (hours * 60 + F.minute(c)) * 60_000 + millis


def text_hour(c: Column | str) -> Column:
    """Hour digits of ISO text as written (no zone conversion), null if absent."""
    return F.substring(_col(c), 12, 2).try_cast("int")


def time_key(c: Column | str) -> Column:
    c = _col(c)
    return F.hour(c) * 100 + F.minute(c)


def date_key(c: Column | str) -> Column:
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def period_label(hour: Column) -> Column:
    return (
        F.when((hour >= 6) & (hour < 12), "morning")
        .when((hour >= 12) & (hour < 18), "afternoon")
        .when((hour >= 18) & (hour < 22), "evening")
        .otherwise("night")
    )


def is_peak_hour(hour: Column, cfg: RuleConfig = DEFAULT_RULES) -> Column:
    return hour.isin(*cfg.peak_hours)


def is_business_hour(c: Column | str, cfg: RuleConfig = DEFAULT_RULES) -> Column:
    """Record level: a weekday, closing hour included."""
    c = _col(c)
    return (F.weekday(c) < 5) & F.hour(c).between(cfg.business_start, cfg.business_end)


def is_business_minute(hour: Column, cfg: RuleConfig = DEFAULT_RULES) -> Column:
    """Minute dimension: any day, closing hour excluded."""
    return (hour >= cfg.business_start) & (hour < cfg.business_end)


def is_holiday(c: Column | str, cfg: RuleConfig = DEFAULT_RULES) -> Column:
    if not cfg.holidays:
        return F.lit(False)
    return F.to_date(_col(c)).isin(*[F.lit(day).cast("date") for day in cfg.holidays])


def is_maintenance(c: Column | str, cfg: RuleConfig = DEFAULT_RULES) -> Column:
    """In one of the windows, both its hours included."""
    c = _col(c)
    inside = [maintenance_day(c, day) & F.hour(c).between(start, end) for day, start, end in cfg.maintenance_windows]
    return reduce(Column.__or__, inside)


def maintenance_day(c: Column | str, day: int | str) -> Column:
    """Is it that weekday, from 0 for Monday, or that date?"""
    c = _col(c)
    return F.weekday(c) == day if isinstance(day, int) else F.to_date(c) == F.lit(day).cast("date")


def is_night(hour: Column, cfg: RuleConfig = DEFAULT_RULES) -> Column:
    return (hour >= cfg.night_start) | (hour < cfg.night_end)


def off_hours_large(
    amount: Column | str = "amount",
    timestamp: Column | str = "timestamp",
    cfg: RuleConfig = DEFAULT_RULES,
) -> Column:
    """Rule 3; false, never null, when the amount or the hour is unreadable."""
    night = is_night(text_hour(timestamp), cfg)
    large = _col(amount) > F.lit(cfg.off_hours_large_txn_vnd).cast("bigint")
    return F.coalesce(large & night, F.lit(False))


# ---- numbers ----------------------------------------------------------------


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    # Rounding may push the chord a hair past 1 for antipodes.
    rest = F.greatest(F.lit(0.0), 1.0 - chord)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(rest))


def format_km(distance: Column) -> Column:
    return F.when(distance.isNotNull(), F.format_string("%.1f", distance))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; null when the whole is zero."""
    return F.round(100.0 * part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), 2)


def clamp_to_thousand(amount: Column) -> Column:
    """Round to whole thousands, ties to even, and lift to at least 10,000."""
    return F.greatest(F.lit(10_000).cast("bigint"), (F.bround(amount / 1000.0) * 1000).cast("bigint"))
