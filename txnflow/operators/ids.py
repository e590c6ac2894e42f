"""Which ids a table holds, told without reading the table.

An index lies beside the tables.  Each load adds the ids it brings, dealt to buckets by hash; a bucket's ids are cut
to filters of at most PER_FILTER ids.  A filter is a row: HASHES bitmaps of BITS bits, one per hash function (a Bloom
filter), and the ids themselves.  To look ids up,

1. only the buckets of these ids are opened, and of them only the bitmaps, 4 to 8 bytes an id;
2. an id for which some filter answers "perhaps" (one in several thousand that are new, each one that is not) is
   looked up among that filter's ids, in that bucket's files; where none does, no stored id is read.

So a load costs its own size and the bitmaps, whatever the width of the tables, and an id counts once whatever its date.

A load's ids are written before its rows, and confirmed after them.  Ids of a load that was never confirmed, because
it broke off, are looked up in the table itself.  Tables that are older than their index are indexed when first used.

One index serves several tables: ids are kept by kind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.operators.tables import append, has_data
from txnflow.session import COMPRESSION, by_shuffle, stored

BUCKETS, HASHES, PER_FILTER, BITS = 16, 4, 4096, 32_768
KEY = ["kind", "id"]
#: Filters of a bucket that one task builds, and that lie in one file.
TOGETHER = 32
#: A side of a join with at most so many rows, or filters, is broadcast (about 10 MB); sizes of files would mislead.
FEW_KEYS, FEW_FILTERS = 100_000, 512
FILTER = ["bucket", "filters", "number", "load"]
_BITMAPS = [f"bits{i}" for i in range(HASHES)]
_SCHEMA = (
    "filters int, number long, load string, "
    + ", ".join(f"{b} binary" for b in _BITMAPS)
    + ", ids array<struct<kind:string,id:string>>, bucket int"
)


def _side(df: DataFrame, n: int) -> DataFrame:
    """The right side of a join, of ``n`` rows."""
    return F.broadcast(df) if n <= FEW_KEYS else by_shuffle(df)


def _hash(salt: int) -> Column:
    return F.xxhash64(*KEY, F.lit(salt))


def _position(i: int) -> Column:
    return _hash(i + 1).bitwiseAND(F.lit(BITS - 1))  # a power of two


def _number() -> Column:
    return F.pmod(F.shiftrightunsigned(_hash(0), 16), F.col("filters"))


def _placed(keys: DataFrame) -> DataFrame:
    """With the bucket, and the number of the filter in it out of ``filters``."""
    return keys.withColumn("bucket", F.pmod(_hash(0), F.lit(BUCKETS)).cast("int")).withColumn("number", _number())


def _is_set(bits: str, position: Column) -> Column:
    byte = F.substring(F.col(bits), F.shiftright(position, 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), position.bitwiseAND(F.lit(7)).cast("int")) == 1


@dataclass(frozen=True)
class IdIndex:
    spark: SparkSession
    path: str

    @property
    def _filters(self) -> str:
        return f"{self.path}/filters"

    @property
    def _confirmed(self) -> str:
        return f"{self.path}/confirmed"

    def _read(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self._filters)

    def confirmed(self) -> DataFrame:
        if has_data(self.spark, self._confirmed):
            return self.spark.read.schema("load string").parquet(self._confirmed)
        return self.spark.createDataFrame([], "load string")

    def begin(self, keys: DataFrame, load: str | None = None) -> str | None:
        """Write the ids (distinct ``kind``, ``id``) of a load; its name, to be confirmed when the rows are written."""
        n = keys.count()
        if not n:
            return None
        load = f"{load or ''}/{uuid.uuid4().hex}"
        filters = 1 << (-(-n // (BUCKETS * PER_FILTER)) - 1).bit_length()
        self.built(keys, filters, load).write.partitionBy("bucket").parquet(
            self._filters, mode="append", compression=COMPRESSION
        )
        return load

    def built(self, keys: DataFrame, filters: int, load: str) -> DataFrame:
        """The filters of a load.

        Its ids meet before they are aggregated, so a bitmap is made once, by the task that writes it: made by every task
        that reads some ids, there would be bitmaps by tasks times filters, the square of the load.
        """
        rows = _placed(keys.select(*KEY, F.lit(filters).alias("filters")))
        rows = rows.select(*KEY, "bucket", F.floor(F.col("number") / TOGETHER).alias("share"))
        rows = rows.repartition(max(1, BUCKETS * filters // TOGETHER), "bucket", "share")
        rows = rows.select("bucket", "share", *KEY, F.lit(filters).alias("filters"))
        rows = rows.withColumn("number", _number())
        bitmaps = [F.bitmap_construct_agg(_position(i)).alias(b) for i, b in enumerate(_BITMAPS)]
        rows = rows.groupBy("bucket", "share", "filters", "number").agg(*bitmaps, F.collect_list(F.struct(*KEY)).alias("ids"))
        return rows.drop("share").withColumn("load", F.lit(load))

    def confirm(self, load: str | None) -> None:
        if load is not None:
            append(self.spark.createDataFrame([(load,)], "load string").coalesce(1), self._confirmed)

    def perhaps(self, keys: DataFrame) -> DataFrame:
        """(kind, id, bucket, filters, number, load) of the filters that answer so."""
        own = F.pmod(_hash(0), F.lit(BUCKETS)).cast("int")
        touched = [r[0] for r in keys.select(own.alias("bucket")).distinct().collect()]  # of BUCKETS
        rows = self._read().filter(F.col("bucket").isin(touched))
        counted = rows.groupBy("filters").agg(F.count("*").alias("n")).collect()
        sizes = [r["filters"] for r in counted]  # powers of two
        sized = keys.withColumn("filters", F.explode(F.lit(sizes).cast("array<int>")))
        asked = _placed(sized)
        bitmaps = rows.select(*FILTER, *_BITMAPS)
        # Many are shuffled and hashed, a few bytes an id: the ids, which are many more rows, need not be sorted then.
        few = sum(r["n"] for r in counted) <= FEW_FILTERS
        bitmaps = F.broadcast(bitmaps) if few else bitmaps.hint("shuffle_hash")
        met = asked.join(bitmaps, ["bucket", "filters", "number"])
        hit = reduce(Column.__and__, [_is_set(b, _position(i)) for i, b in enumerate(_BITMAPS)])
        return met.filter(hit).select(*KEY, *FILTER)

    def held(
        self, keys: DataFrame, tables: dict[str, Callable[[], DataFrame]], apart_from: str | None = None
    ) -> DataFrame | None:
        """The keys (kind, id) that are stored; None if the index shows at once that none is.

        ``tables`` gives the ids of a kind's table (one column).  Loads begun under the name ``apart_from`` do not count.
        """
        if not has_data(self.spark, self._filters):
            for kind, ids in tables.items():
                old = ids().toDF("id").select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id")).distinct()
                self.confirm(self.begin(old))
            if not has_data(self.spark, self._filters):
                return None
        perhaps = self.perhaps(keys)
        if apart_from is not None:
            perhaps = perhaps.filter(~F.startswith("load", F.lit(f"{apart_from}/")))
        perhaps = stored(perhaps, "perhaps-stored")
        where = perhaps.groupBy("bucket").agg(F.count("*").alias("n")).collect()
        if not where:
            return None
        ids = self._read().filter(F.col("bucket").isin([r["bucket"] for r in where]))
        # A row per PER_FILTER ids.
        ids = ids.join(F.broadcast(perhaps.select(*FILTER).distinct()), FILTER, "left_semi")
        confirmed = F.broadcast(self.confirmed().withColumn("sure", F.lit(True)))  # a row per load
        ids = ids.join(confirmed, "load", "left").select(F.coalesce("sure", F.lit(False)).alias("sure"), F.inline("ids"))
        # Whatever load an id is of, its filter answers "perhaps"; so the load need not be compared, nor be shuffled.
        hits = ids.join(_side(perhaps.select(*KEY), sum(r["n"] for r in where)), KEY, "left_semi")
        hits = stored(hits.groupBy(*KEY).agg(F.max("sure").alias("sure")), "stored-ids")
        sure, broken = hits.filter("sure").select(*KEY), hits.filter(~F.col("sure")).select(*KEY)
        if broken.isEmpty():
            return sure
        for kind, table in tables.items():
            own = table().toDF("id").select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"))
            sure = sure.unionByName(broken.join(by_shuffle(own), KEY, "left_semi"))
        return sure.distinct()


def stored_ids(spark: SparkSession, path: str, key: str | Column) -> DataFrame:
    """The ids in a table, or none."""
    if has_data(spark, path):
        return spark.read.parquet(path).select(key)
    return spark.createDataFrame([], f"{key if isinstance(key, str) else 'id'} string")


@dataclass(frozen=True)
class Insert:
    """Rows to be added to a table if their ``key`` is absent: one per key, unless ``ids`` has the keys, each once.

    ``made`` and ``without`` are those of ``tables.append``.
    """

    kind: str
    rows: DataFrame
    key: str | Column
    path: str
    partition: tuple[str, ...] = ()
    ids: DataFrame | None = None
    made: dict[str, Column] | None = None
    without: tuple[str, ...] = ()

    def keys(self) -> DataFrame:
        own = (self.rows.select(self.key) if self.ids is None else self.ids).toDF("id")
        return own.select(F.lit(self.kind).alias("kind"), F.col("id").cast("string").alias("id"))


Tables = dict[str, tuple[str, str | Column]]


def held_ids(index: IdIndex, keys: DataFrame, tables: Tables, apart_from: str | None = None) -> DataFrame | None:
    """As :meth:`IdIndex.held`; ``tables`` names path and key of every table the index serves."""
    own = {kind: lambda at=at: stored_ids(index.spark, *at) for kind, at in tables.items()}
    return index.held(keys, own, apart_from)


def _per_kind(keys: DataFrame) -> dict[str, int]:
    return {r["kind"]: r["n"] for r in keys.groupBy("kind").agg(F.count("*").alias("n")).collect()}


def insert_once(index: IdIndex, inserts: list[Insert], load: str | None = None, tables: Tables | None = None) -> None:
    """Add the rows whose key their table does not hold, and their keys to the index."""
    keys = reduce(DataFrame.unionByName, [i.keys() for i in inserts])
    found = held_ids(index, keys, tables or {i.kind: (i.path, i.key) for i in inserts})
    held = _per_kind(found) if found is not None else {}
    if held and held == _per_kind(keys):
        return  # as when a run is repeated
    begun = index.begin(keys if not held else keys.join(_side(found, sum(held.values())), KEY, "left_anti"), load)
    for i in inserts:
        rows = i.rows
        if n := held.get(i.kind, 0):
            own = found.filter(F.col("kind") == i.kind).select(F.col("id").alias("_id"))
            key = F.col(i.key) if isinstance(i.key, str) else i.key
            rows = rows.join(_side(own, n), key.cast("string") == F.col("_id"), "left_anti")
        append(rows, i.path, *i.partition, made=i.made, without=i.without)
    index.confirm(begun)
