"""Anchors of the duplicate rule.

Within one combination the first row is an anchor; the next anchor is the
first row more than the window after it; every other row is a duplicate.  The
chain is sequential, yet one combination may hold much of the table, so it is
cut into time blocks.  To mark a block's anchors one needs only the last
anchor before it, its carry:

* A gap longer than the window restarts the chain.  So a block with such a gap
  inside, or before it, is left with the same last anchor whatever came
  earlier, and that anchor is the next block's carry.
* Only a block that continues the one before and has no gap passes its own
  carry on.  It does so by a monotone step function: the anchor it is left with
  for each carry, kept as the few places where that changes.  Such functions
  compose to one of their kind, so a tree over the blocks finds all carries: up
  the tree the functions of FAN neighbours become one, down the tree each gets
  the carry that reaches it.  A task works on FAN blocks at a time, however many
  a combination fills.  Ordinary data has no such block, as it takes a row every
  window throughout a block; then nothing of this runs.

Blocks continue each other only where both reach the border between them to a
window.  Only such blocks are compared, and only those with a row in their first
window meet a carry; the others, most of ordinary data, are never shuffled again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.operators.timeblocks import block_of
from txnflow.session import stored

BLOCK_MS = 600_000
#: Neighbours that a task of the tree works on together.
FAN = 64


def block_exits(t: np.ndarray, first_free: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, exit) times for every instant the chain could enter at.

    ``t`` is sorted and unique; an anchor before the block cannot reach beyond
    ``first_free``, so the entry is at most the first instant from there on.
    """
    here = np.arange(len(t))
    nxt = np.searchsorted(t, t + window, side="right")
    leave = np.where(nxt < len(t), nxt, here)
    while True:
        further = leave[leave]
        if np.array_equal(further, leave):
            break
        leave = further
    entries = here[: np.searchsorted(t, first_free, side="left") + 1]
    return t[entries], t[leave[entries]]


@dataclass
class Passing:
    """What a block, or a run of blocks, makes of a carry: ``values[i]`` below ``bounds[i]``, which rise; from the last
    bound on ``rest``, or the carry itself if that is None."""

    bounds: np.ndarray
    values: np.ndarray
    rest: int | None = None

    @classmethod
    def of_block(cls, t: np.ndarray, first_free: int, window: int) -> Passing:
        entry, leave = block_exits(t, first_free, window)
        return cls(entry - window, leave).shortened()

    @classmethod
    def constant(cls, value: int) -> Passing:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), value)

    def shortened(self) -> Passing:
        last = np.flatnonzero(np.diff(self.values, append=self.values[-1:] - 1))
        return Passing(self.bounds[last], self.values[last], self.rest)

    def __call__(self, carry: int) -> int:
        i = int(np.searchsorted(self.bounds, carry, side="right"))
        if i < len(self.bounds):
            return int(self.values[i])
        return int(carry) if self.rest is None else self.rest

    def then(self, after: Passing) -> Passing:
        i = np.searchsorted(after.bounds, self.values, side="right")
        beyond = self.values if after.rest is None else np.full(len(i), after.rest)
        found = np.append(after.values, 0)[i]
        values = np.where(i < len(after.bounds), found, beyond)
        if self.rest is not None:
            return Passing(self.bounds, values, after(self.rest)).shortened()
        more = np.searchsorted(after.bounds, self.bounds[-1], side="right") if len(self.bounds) else 0
        bounds = np.concatenate([self.bounds, after.bounds[more:]])
        return Passing(bounds, np.concatenate([values, after.values[more:]]), after.rest).shortened()


def passed_on(carry: float, entry: np.ndarray, leave: np.ndarray, window: int) -> int:
    """The anchor a block is left with when ``carry`` is the last one before it."""
    return Passing(entry - window, leave)(carry)


def _last_anchor(instants: Column, window_ms: int) -> Column:
    def step(at, row):
        return F.when(at.isNull() | (row["t"] - at > window_ms), row["t"]).otherwise(at)

    return F.aggregate(instants, F.lit(None).cast("bigint"), step)


def _has_gap(instants: Column, window_ms: int) -> Column:
    start = F.struct(F.lit(None).cast("bigint").alias("t"), F.lit(False).alias("gap"))

    def step(before, row):
        far = F.coalesce(row["t"] - before["t"] > window_ms, F.lit(False))
        return F.struct(row["t"].alias("t"), (before["gap"] | far).alias("gap"))

    return F.aggregate(instants, start, step)["gap"]


def _anchor_ids(instants: Column, carry: Column, window_ms: int) -> Column:
    # At most block/window + 1 anchors per block, so the id list stays short.
    start = F.struct(carry.alias("at"), F.array().cast("array<string>").alias("ids"))

    def step(state, row):
        opens = state["at"].isNull() | (row["t"] - state["at"] > window_ms)
        grown = F.struct(row["t"].alias("at"), F.concat(state["ids"], F.array(row["id"])).alias("ids"))
        return F.when(opens, grown).otherwise(state)

    return F.aggregate(instants, start, step)["ids"]


def duplicate_anchors(
    rows: DataFrame, keys: tuple[str, ...], window_ms: int, block_ms: int = BLOCK_MS
) -> DataFrame:
    """Ids of the anchor rows.  ``rows``: transaction_id, t and non-null keys.

    Blocks are as long as the window at least.  Runs jobs: the blocks are written to the shared folder.
    """
    block_ms = max(block_ms, window_ms)
    keys = list(keys)
    key_block = [*keys, "_block"]
    key_ddl = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    # One row per instant: at most one per millisecond, whatever the input.
    instants = rows.groupBy("t", *keys).agg(F.min("transaction_id").alias("id"))
    inst = F.col("inst")
    blocks = (
        instants.withColumn("_block", block_of(F.col("t"), block_ms))
        .groupBy(*key_block)
        .agg(F.sort_array(F.collect_list(F.struct("t", "id"))).alias("inst"))
        .select(
            "*",
            inst[0]["t"].alias("first_t"),
            F.element_at(inst, -1)["t"].alias("last_t"),
            _last_anchor(inst, window_ms).alias("last_anchor"),
            _has_gap(inst, window_ms).alias("has_gap"),
        )
    )
    # The steps below all read the blocks; without this each would compute them anew.
    blocks = stored(blocks, "blocks")

    starts = F.col("_block") * F.lit(block_ms)
    early = F.col("first_t") < starts + F.lit(window_ms)
    late = F.col("last_t") >= starts + F.lit(block_ms - window_ms)
    along = Window.partitionBy(*keys).orderBy("_block")
    continues = F.coalesce(F.col("first_t") - F.lag("last_t").over(along) <= window_ms, F.lit(False))
    edges = (
        blocks.filter(early | late)
        .drop("inst")
        .withColumn("continues", continues)
        .withColumn("open", F.col("continues") & ~F.col("has_gap"))
        .withColumn("carry", F.when(~F.lag("open").over(along), F.lag("last_anchor").over(along)))
    )
    edges = stored(edges.filter("continues").select(*key_block, "open", "carry"), "edges")

    reached = blocks.filter(early)
    through = _passed_on(reached, edges, keys, key_ddl, window_ms, block_ms)
    carries = edges.select(*key_block, "carry")
    if through is not None:
        carries = carries.join(through, key_block, "left").select(*key_block, F.coalesce("carry", "_passed").alias("carry"))
    marked = reached.join(carries, key_block, "left").select("inst", "carry")
    marked = marked.unionByName(blocks.filter(~early).select("inst", F.lit(None).cast("bigint").alias("carry")))
    return marked.select(F.explode(_anchor_ids(inst, F.col("carry"), window_ms)).alias("transaction_id"))


_MEMBER = "struct<n:bigint,bounds:array<bigint>,values:array<bigint>,rest:bigint>"


def _passings(members) -> list[tuple[int, Passing]]:
    """(number, function) of the members of a group, in order."""
    rows = sorted(members, key=lambda m: m["n"])
    as_array = lambda x: np.array(x, np.int64)
    return [(m["n"], Passing(as_array(m["bounds"]), as_array(m["values"]), m["rest"])) for m in rows]


def _passed_on(
    blocks: DataFrame, edges: DataFrame, keys: list[str], key_ddl: str, window_ms: int, block_ms: int
) -> DataFrame | None:
    """(keys, _block, _passed): the carry that an open block hands to the next one; None without open blocks."""
    key_block = [*keys, "_block"]
    open_blocks = edges.filter("open").select(*key_block, "carry")
    span = open_blocks.agg(F.min("_block"), F.max("_block")).first()
    if span[0] is None:
        return None

    def functions(batches):
        for pdf in batches:
            found = []
            for t, block, carry in zip(pdf.pop("t"), pdf["n"], pdf.pop("carry")):
                own = Passing.of_block(np.asarray(t), (block + span[0]) * block_ms + window_ms, window_ms)
                # The first of a run of open blocks knows its carry.
                found.append(own if pd.isna(carry) else Passing.constant(own(int(carry))))
            yield pdf.assign(bounds=[f.bounds for f in found], values=[f.values for f in found], rest=pd.array([f.rest for f in found], "Int64"))

    def compose(batches):
        for pdf in batches:
            found = []
            for members in pdf.pop("members"):
                (_, whole), *others = _passings(members)
                for _, f in others:
                    whole = whole.then(f)
                found.append(whole)
            yield pdf.assign(bounds=[f.bounds for f in found], values=[f.values for f in found], rest=pd.array([f.rest for f in found], "Int64"))

    def hand_down(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                at = None if pd.isna(row.carry) else int(row.carry)
                for n, f in _passings(row.members):
                    out.append((*row[: len(keys)], n, at))
                    # Only at the start of a combination is there no carry; there the function is constant.
                    at = f.rest if at is None else f(at)
            yield pd.DataFrame(out, columns=[*keys, "n", "carry"]).astype({"carry": "Int64"})

    ddl = f"{key_ddl}, n bigint, bounds array<bigint>, values array<bigint>, rest bigint"
    inst = blocks.select(*key_block, F.col("inst.t").alias("t"))
    level = inst.join(open_blocks, key_block).select(*keys, (F.col("_block") - span[0]).alias("n"), "t", "carry")
    level = level.mapInPandas(functions, ddl)
    groups, width = [], span[1] - span[0] + 1
    while True:
        member = F.struct("n", "bounds", "values", "rest").cast(_MEMBER)
        grouped = level.groupBy(*keys, F.floor(F.col("n") / FAN).alias("g")).agg(F.collect_list(member).alias("members"))
        groups.append(stored(grouped, "block-groups"))
        width = -(-width // FAN)
        if width <= 1:
            break
        level = groups[-1].withColumnRenamed("g", "n").mapInPandas(compose, ddl)
    carries = groups[-1].select(*keys, "g", F.lit(None).cast("bigint").alias("carry"))
    for grouped in reversed(groups):
        known = grouped.join(carries, [*keys, "g"]).select(*keys, "carry", "members")
        carries = known.mapInPandas(hand_down, f"{key_ddl}, n bigint, carry bigint").withColumnRenamed("n", "g")
    # What reaches a block is what the one before it, if that is open, handed on; the last of a run hands on, too.
    last = groups[0].select(*keys, F.inline("members")).select(*keys, F.col("n").alias("g"), "bounds", "values", "rest")

    def apply(batches):
        for pdf in batches:
            out = []
            for bounds, values, rest, carry in zip(pdf.pop("bounds"), pdf.pop("values"), pdf.pop("rest"), pdf.pop("carry")):
                f = Passing(np.asarray(bounds, np.int64), np.asarray(values, np.int64), None if pd.isna(rest) else int(rest))
                out.append(f.rest if pd.isna(carry) else f(int(carry)))
            yield pdf.assign(_passed=out)

    passed = last.join(carries, [*keys, "g"]).mapInPandas(apply, f"{key_ddl}, g bigint, _passed bigint")
    return passed.select(*keys, (F.col("g") + span[0] + 1).alias("_block"), "_passed")
