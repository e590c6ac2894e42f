from txnflow.functions.scalar import (
    alert_id,
    clamp_to_thousand,
    date_key,
    event_millis,
    format_km,
    has_value,
    haversine_km,
    is_business_hour,
    is_business_minute,
    is_holiday,
    is_maintenance,
    is_night,
    is_peak_hour,
    json_field,
    local_time,
    maintenance_day,
    mask_account,
    mask_national_id,
    mask_phone,
    millis_time,
    null_tokens,
    off_hours_large,
    pad_id,
    parse_timestamp,
    percent,
    period_label,
    text_hour,
    time_key,
    token_account,
    utc_time,
)

__all__ = [name for name in dir() if not name.startswith("_")]
