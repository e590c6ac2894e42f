"""Message fields: whitelist, channel layouts, row typing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.functions import null_tokens, parse_timestamp, utc_time
from txnflow.schemas import RAW_TXN, STAGING_RAW


def normalise(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """The 14 message fields, typed; absent ones null, all others dropped.

    ``renames`` maps a channel's own column names to message fields.
    """
    source = {field: name for name, field in (renames or {}).items()}

    def pick(field):
        name = source.get(field.name, field.name)
        value = F.col(name) if name in df.columns else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[pick(f) for f in RAW_TXN.fields])


def normalise_channels(tables: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Channel layouts to one table; the channel name comes from the source."""
    parts = [
        normalise(df, renames).withColumn("channel", F.lit(channel))
        for channel, (df, renames) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def whole_number(c: Column) -> Column:
    """Text or number to bigint; null unless it is a whole number."""
    # Wide enough for a bigint, and for comparing without rounding.
    exact = c.try_cast("decimal(37,18)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def _optional_double(name: str) -> tuple[Column, Column]:
    """(value, is bad): empty text is null, other unreadable text is an error."""
    text = F.nullif(F.col(name), F.lit(""))
    value = text.try_cast("double")
    return value, text.isNotNull() & value.isNull()


def type_rows(text: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Text rows to the staging layout plus ``errors``, the fields that failed."""
    lat, bad_lat = _optional_double("merchant_lat")
    lon, bad_lon = _optional_double("merchant_lon")
    typed = {
        "ts": parse_timestamp("timestamp"),
        "merchant_lat": lat,
        "merchant_lon": lon,
        "amount": F.col("amount").try_cast("bigint"),
        "fraud_label": F.col("fraud_label").try_cast("smallint"),
        "fraud_type": null_tokens("fraud_type"),
        "loaded_at": utc_time(F.current_timestamp()) if loaded_at is None else loaded_at.cast("timestamp_ntz"),
    }
    checks = [
        F.when(typed["ts"].isNull(), "timestamp"),
        F.when(bad_lat, "merchant_lat"),
        F.when(bad_lon, "merchant_lon"),
        F.when(typed["amount"].isNull(), "amount"),
        F.when(typed["fraud_label"].isNull(), "fraud_label"),
    ]
    columns = [typed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in STAGING_RAW.fields]
    return text.select(*columns, F.array_compact(F.array(*checks)).alias("errors"))
