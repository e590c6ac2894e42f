"""Split an account's history into time blocks that can be processed apart.

The rules look back a bounded time.  A row's block, plus the rows of the block
before it that lie inside that look-back (the halo), hold everything its
verdict can depend on, so blocks of one account go to different tasks and a
hot account never becomes one task's work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.session import stored

#: Crowded instants up to so many are broadcast (a few MB); beyond, all rows are ranked.
FEW_CROWDED = 50_000
HOUR_MS = 3_600_000
BLOCK, IN_CORE = "_block", "_core"


def block_length(halo_ms: int) -> int:
    """At least an hour and twelve halos, so at most 1/12 of rows are repeated."""
    return max(HOUR_MS, 12 * halo_ms)


def block_of(t: Column, block_ms: int) -> Column:
    return F.floor(t / F.lit(block_ms))


def with_halo(rows: DataFrame, halo_ms: int, block_ms: int | None = None) -> DataFrame:
    """Add ``_block``; rows near a block's end also appear in the next block.

    ``_core`` is true in the block the row belongs to.  Expects ``t`` in ms.
    """
    block_ms = block_ms or block_length(halo_ms)
    if halo_ms > block_ms:
        raise ValueError("a block must be at least as long as its halo")
    own = block_of(F.col("t"), block_ms)
    near_end = F.pmod(F.col("t"), F.lit(block_ms)) >= block_ms - halo_ms
    blocks = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return rows.withColumn(BLOCK, F.explode(blocks)).withColumn(
        IN_CORE, F.col(BLOCK) == block_of(F.col("t"), block_ms)
    )


@dataclass(frozen=True)
class Crowded:
    """The (account, ``t``) of ``n`` instants that may hold too many rows; no other does."""

    instants: DataFrame
    n: int


def crowded_instants(rows: DataFrame, account: str, keep: int) -> Crowded | None:
    """Instants with more than ``keep`` of rows that are stored; None if they are many.

    Counts are small and shrink where the rows are read, so they cost a fraction of ranking all rows.
    """
    counts = rows.groupBy(account, "t").agg(F.count("*").alias("_n"))
    instants = stored(counts.filter(F.col("_n") > keep).select(account, "t"), "crowded")
    n = instants.count()
    return Crowded(instants, n) if n <= FEW_CROWDED else None


def first_per_instant(rows: DataFrame, account: str, keep: int, crowded: Crowded | None = None) -> DataFrame:
    """The first ``keep`` rows of each (account, millisecond).

    Spark cuts each map task's output to ``keep`` rows per instant before the
    shuffle, so a burst on one account shrinks where it is read.  With ``crowded``, rows elsewhere pass as they are.
    """
    if crowded is not None:
        if not crowded.n:
            return rows
        at = F.broadcast(crowded.instants)
        cut = first_per_instant(rows.join(at, [account, "t"], "left_semi"), account, keep)
        return rows.join(at, [account, "t"], "left_anti").unionByName(cut)
    order = Window.partitionBy(account, "t").orderBy("transaction_id")
    ranked = rows.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= keep).drop("_rank")
