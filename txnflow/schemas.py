"""Table layouts.  All reads use these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_str, _int, _long = T.StringType(), T.IntegerType(), T.LongType()
_short, _bool, _double = T.ShortType(), T.BooleanType(), T.DoubleType()
_ntz, _date, _coord = T.TimestampNTZType(), T.DateType(), T.DecimalType(9, 6)

# The message contract: what survives normalisation, in this order.
RAW_TXN = _schema(
    ("transaction_id", _str),
    ("timestamp", _str),
    ("account_masked", _str),
    ("customer_id", _str),
    ("channel", _str),
    ("merchant_id", _str),
    ("merchant_province", _str),
    ("merchant_lat", _double),
    ("merchant_lon", _double),
    ("amount", _long),
    ("currency", _str),
    ("status", _str),
    ("fraud_label", _short),
    ("fraud_type", _str),
)
MESSAGE_FIELDS = RAW_TXN.fieldNames()

# Channel files carry eight more fields, one of them the clear account number.
GENERATED_TXN = T.StructType(
    RAW_TXN.fields
    + _schema(
        ("account_number", _str),
        ("customer_segment", _str),
        ("merchant_name", _str),
        ("merchant_category", _str),
        ("is_peak_hour", _bool),
        ("is_business_hour", _bool),
        ("is_holiday", _bool),
        ("is_maintenance", _bool),
    ).fields
)

# Lenient form for parsing messages: every field arrives as text and is typed
# afterwards, so one bad value marks that field and not the whole record.
TEXT_TXN = T.StructType([T.StructField(f.name, _str, True) for f in RAW_TXN.fields])

DIM_CUSTOMER = _schema(
    ("customer_id", _str),
    ("account_masked", _str),
    ("segment", _str),
    ("risk_score", _int),
    ("home_province", _str),
    ("home_lat", _coord),
    ("home_lon", _coord),
)
CUSTOMER_CSV = _schema(
    ("customer_id", _str),
    ("account_number", _str),
    ("account_masked", _str),
    ("phone", _str),
    ("phone_masked", _str),
    ("national_id", _str),
    ("national_id_masked", _str),
    ("full_name", _str),
    ("segment", _str),
    ("risk_score", _int),
    ("home_province", _str),
    ("home_lat", _coord),
    ("home_lon", _coord),
    ("avg_txn_multiplier", _double),
)
MERCHANT_CSV = _schema(
    ("merchant_id", _str),
    ("merchant_name", _str),
    ("category", _str),
    ("province", _str),
    ("lat", _double),
    ("lon", _double),
)
DIM_TIME = _schema(
    ("time_id", _int),
    ("hour", _int),
    ("minute", _int),
    ("is_peak_hour", _bool),
    ("is_business_hour", _bool),
    ("period_label", _str),
)
DIM_CALENDAR = _schema(
    ("date_id", _int),
    ("full_date", _date),
    ("day_of_week", _int),
    ("is_weekend", _bool),
    ("is_holiday", _bool),
    ("holiday_name", _str),
    ("is_maintenance", _bool),
)
# The folders of the fact tables: the day a fact was loaded (and, below it, its date_id), the day an alert was detected.
LOADED_DATE, DETECTED_DATE = "loaded_date", "detected_date"
FACT_TXN = _schema(
    ("transaction_id", _str),
    ("account_masked", _str),
    ("customer_id", _str),
    ("channel", _str),
    ("merchant_id", _str),
    ("merchant_province", _str),
    ("amount", _long),
    ("currency", _str),
    ("status", _str),
    ("fraud_flag", _bool),
    ("alert_id", _str),
    ("time_id", _int),
    ("date_id", _int),
    ("event_ts", _ntz),
    ("loaded_at", _ntz),
)
FACT_ALERT = _schema(
    ("alert_id", _str),
    ("transaction_id", _str),
    ("rule_triggered", _str),
    ("severity", _str),
    ("detected_at", _ntz),
    ("resolved_at", _ntz),
    ("created_at", _ntz),
)
AUDIT_LOG = _schema(
    ("flowfile_uuid", _str),
    ("processor_name", _str),
    ("event_type", _str),
    ("txn_id", _str),
    ("logged_at", _ntz),
)
STAGING_RAW = _schema(
    ("transaction_id", _str),
    ("ts", _ntz),
    ("account_masked", _str),
    ("customer_id", _str),
    ("channel", _str),
    ("merchant_id", _str),
    ("merchant_province", _str),
    ("merchant_lat", _double),
    ("merchant_lon", _double),
    ("amount", _long),
    ("currency", _str),
    ("status", _str),
    ("fraud_label", _short),
    ("fraud_type", _str),
    ("loaded_at", _ntz),
)

# A record lacking any of these goes to the dead-letter table.
REQUIRED_FIELDS = (
    "transaction_id",
    "timestamp",
    "account_masked",
    "channel",
    "amount",
    "currency",
    "status",
)

CHANNELS = ("ATM", "POS", "mobile", "internet")
CSV_CHANNELS = ("ATM", "POS")
JSON_CHANNELS = ("mobile", "internet")
STATUSES = ("SUCCESS", "FAILED", "PENDING")
SEGMENTS = ("VIP", "Premium", "Standard", "New", "Watch")
