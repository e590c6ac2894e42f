"""Validation, dead letters and re-delivered messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.functions import has_value, null_tokens, parse_timestamp
from txnflow.operators.normalise import whole_number
from txnflow.schemas import MESSAGE_FIELDS, RAW_TXN, REQUIRED_FIELDS
from txnflow.session import by_shuffle, stored

REASONS = "error_reasons"
#: Repeated ids up to so many are broadcast (a few MB).
FEW_REPEATED = 50_000


def validate(parsed: DataFrame) -> DataFrame:
    """Type parsed text fields; add event_ts and the names of failed checks.

    A required field fails when absent, empty or not of its type; ``json``
    fails when the message was not JSON.
    """
    typed = {
        f.name: F.col(f.name).try_cast(f.dataType) if f.name != "amount" else whole_number(F.col("amount"))
        for f in RAW_TXN.fields
    }
    typed["fraud_type"] = null_tokens("fraud_type")
    event_ts = parse_timestamp("timestamp")
    checks = [F.when(F.col("_corrupt_record").isNotNull(), "json")]
    for name in REQUIRED_FIELDS:
        ok = {"timestamp": event_ts.isNotNull(), "amount": typed["amount"].isNotNull()}.get(name, has_value(name))
        checks.append(F.when(~ok, name))
    # Names as one text first: a filter over an array of them would run outside the generated code, and each check twice.
    names = F.concat_ws(",", *checks)
    reasons = F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, ","))
    others = [c for c in parsed.columns if c not in MESSAGE_FIELDS and c != "_corrupt_record"]
    return parsed.select(
        *others,
        *[typed[name].alias(name) for name in MESSAGE_FIELDS],
        event_ts.alias("event_ts"),
        reasons.alias(REASONS),
    )


def keep_rejected_text(validated: DataFrame) -> DataFrame:
    """Drop the message text of valid rows, whose fields say the same."""
    return validated.withColumn("value", F.when(F.size(REASONS) > 0, F.col("value")))


def valid(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size(REASONS) == 0).drop(REASONS)


def dead_letters(validated: DataFrame, *carry: str) -> DataFrame:
    """Rejected messages as received, with the reasons."""
    keep = [c for c in ("key", "value", "loaded_at", *carry) if c in validated.columns]
    return validated.filter(F.size(REASONS) > 0).select("transaction_id", *keep, REASONS)


def dedupe_transactions(rows: DataFrame) -> DataFrame:
    """One row per transaction_id: the earliest, by content where equal.

    Copies are dropped where they are read, before the shuffle.
    """
    content = [c for c in MESSAGE_FIELDS if c in rows.columns]
    order = Window.partitionBy("transaction_id").orderBy("event_ts", *content)
    return rows.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").drop("_copy")


def dedupe_stored(rows: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """As ``dedupe_transactions``, of rows that are stored and have ids: those without a copy stay where they are.

    Ids are counted first, so only they are shuffled, and the rows of ids that occur again.  Where none does, the rows
    are returned as they came; else the result is given to ``store``.
    """
    store = store or (lambda df: stored(df, "accepted"))
    again = rows.groupBy("transaction_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("transaction_id")
    again = stored(again, "repeated-ids")
    n = again.count()
    if not n:
        return rows
    again = F.broadcast(again) if n <= FEW_REPEATED else by_shuffle(again)
    single = rows.join(again, "transaction_id", "left_anti")
    copies = rows.join(again, "transaction_id", "left_semi")
    return store(single.unionByName(dedupe_transactions(copies)).select(*rows.columns))
