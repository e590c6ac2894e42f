"""The rows that later verdicts may depend on, kept as an append-only log in time blocks.

A row is written once, in the folder of its time.  Reading opens the folders that the new rows and the blocks
(``timeblocks``) before them lie in, skips what is older, and keeps the accounts and blocks that the new rows touch; so
what a run or a trigger reads and writes follows its own rows and their time.  Batch runs and streams share the log,
and a stream with a new checkpoint goes on from it.

Old folders may be removed at any time; rows that arrive for them later are then judged without them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.config import DEFAULT_RULES, RuleConfig
from txnflow.functions import event_millis, millis_time
from txnflow.operators.rules import ACCOUNT, HISTORY, HISTORY_SCHEMA, ID, has_history, lookback_ms
from txnflow.operators.tables import append
from txnflow.operators.timeblocks import Crowded, block_length, block_of, first_per_instant
from txnflow.session import by_shuffle

#: A folder holds whole blocks, about this time.
FOLDER_MS = 6 * 3_600_000
#: Folders named one by one; beyond, all are listed.
MOST_NAMED = 2000
#: Ids of kept rows up to so many are broadcast (about 10 MB).
FEW_KNOWN = 100_000
SCHEMA = T.StructType(
    [*HISTORY_SCHEMA.fields, T.StructField("run", T.StringType()), T.StructField("folder", T.LongType())]
)


@dataclass(frozen=True)
class History:
    spark: SparkSession
    path: str

    def _read(self, root: str, folders: list[int]) -> DataFrame | None:
        reader = self.spark.read.schema(SCHEMA).option("basePath", root)
        try:
            if len(folders) <= MOST_NAMED:
                return reader.parquet(f"{root}/folder={{{','.join(map(str, folders))}}}")
            return reader.parquet(root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _root(self, cfg: RuleConfig) -> tuple[str, int, int]:
        """Where the rows are, and the lengths of a block and of a folder; other rules have others."""
        length = block_length(lookback_ms(cfg))
        folder = length * max(1, FOLDER_MS // length)
        return f"{self.path}/folder_ms={folder}", length, folder

    def _near(self, rows: DataFrame, cfg: RuleConfig, before: int) -> tuple[DataFrame | None, DataFrame]:
        """Kept rows from the first block on, in the folders, that ``rows`` touch, None if there are no such folders; the
        (account, block) pairs they touch, some more than once.

        A row touches its block and those ``before`` it.
        """
        root, length, folder = self._root(cfg)
        own = block_of(event_millis("event_ts"), length)
        blocks = F.explode(F.array(*[own - i for i in range(before + 1)]))
        touched = rows.filter(has_history()).select(ACCOUNT, blocks.alias("block"))
        number = F.floor(F.col("block") * F.lit(length) / F.lit(folder)).alias("folder")
        folders = touched.groupBy(number).agg(F.min("block").alias("first")).limit(MOST_NAMED + 1).collect()
        if not folders:
            return None, touched
        near = self._read(root, [r["folder"] for r in folders])
        if near is not None and len(folders) <= MOST_NAMED:
            near = near.filter(F.col("event_ts") >= millis_time(F.lit(min(r["first"] for r in folders) * length)))
        return near, touched

    def before(self, rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES, run: str | None = None) -> DataFrame | None:
        """Earlier rows that verdicts of these rows can depend on; those of this ``run`` itself do not count.

        None if there are none.  Kept rows mostly lie in few of the blocks that new rows touch, as where one load ends and
        the next begins; pairs of other blocks are dropped before they are shuffled.
        """
        near, touched = self._near(rows, cfg, 1)
        if near is None:
            return None
        if run is not None:
            near = near.filter(F.coalesce(F.col("run") != run, F.lit(True)))
        length = block_length(lookback_ms(cfg))
        near = near.withColumn("block", block_of(event_millis("event_ts"), length))
        first, last = near.agg(F.min("block"), F.max("block")).first()
        if first is None:
            return None
        touched = touched.filter(F.col("block").between(first, last)).distinct()
        # Rows that were sent again are dropped first: where all were, nothing is left for the second join.
        near = near.join(by_shuffle(rows.select(ID)), ID, "left_anti")
        return near.join(by_shuffle(touched), [ACCOUNT, "block"], "left_semi").select(*HISTORY)

    def keep(
        self, rows: DataFrame, cfg: RuleConfig = DEFAULT_RULES, run: str | None = None, crowds: Crowded | None = None
    ) -> None:
        """Add the rows, those of an earlier attempt left out; ``crowds`` is what ``rules.crowded`` says of them.

        Later rows of one instant always fire and tell the rules nothing more.
        """
        root, _, folder = self._root(cfg)
        known, _ = self._near(rows, cfg, 0)
        new = rows.filter(has_history()).select(*HISTORY)
        if known is not None:
            known = known.select(ID)
            n = known.count()
            new = new.join(F.broadcast(known) if n <= FEW_KNOWN else by_shuffle(known), ID, "left_anti") if n else new
        new = new.withColumn("t", event_millis("event_ts"))
        heads = first_per_instant(new, ACCOUNT, max(1, cfg.velocity_count - 1), crowds)
        heads = heads.withColumn("folder", block_of(F.col("t"), folder)).drop("t")
        append(heads.withColumn("run", F.lit(run).cast("string")), root, "folder")
