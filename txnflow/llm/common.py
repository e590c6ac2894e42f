"""Helpers shared by the operators: tables, words, word hashes, batches."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Multipliers of the polynomial that turns word hashes into a shingle hash (odd, from splitmix64).
SHINGLE_BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True if crc32 of the id as text leaves ``fold`` modulo ``folds``; null ids are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20, owner: str = ""
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the named column holds about ``max_bytes`` in each (one row at least).

    ``owner`` is whose memory the process keeps (:func:`process_memory`).
    """
    process_memory(owner)
    for batch in batches:
        sizes = np.array(pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist(), dtype=np.int64)
        block = (np.cumsum(sizes) - sizes) // max_bytes
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Within it, jobs hand Python at most ``n`` rows at once: for rows that are large each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def process_memory(owner: str) -> dict:
    """A dictionary that outlives the task: that of a module which exists in the worker process only.

    One operator's at a time, or what one leaves behind would stand beside the next one's for as long as Spark uses the
    process again.
    """
    memory = sys.modules.get("_txnflow_memory")
    if memory is None or memory.owner != owner:
        memory = sys.modules["_txnflow_memory"] = ModuleType("_txnflow_memory")
        memory.owner = owner
        pa.default_memory_pool().release_unused()
    return memory.__dict__


class WordHashes(dict):
    """xxhash64 of a word, remembered; emptied when it grows over ``limit`` words."""

    def __init__(self, limit: int = 250_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n consecutive words; empty if there are fewer."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out *= np.uint64(SHINGLE_BASE)
        out += hashes[i : i + size]
    return mix(out)


#: A-Z to a-z, other ASCII marks to spaces; what remains between spaces are plain words.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Marks(dict):
    """For str.translate: letters, digits and their accents stay, invisible characters go, the rest are spaces."""

    def __missing__(self, code: int) -> str:
        kind = unicodedata.category(chr(code))
        value = self[code] = chr(code) if kind[0] in "LNM" or code < 128 else "" if kind == "Cf" else " "
        return value


MARKS = Marks()


def plain_words(text: bytes) -> list[bytes]:
    """The words without case and marks: runs of letters and digits, by Unicode where the text is not ASCII alone."""
    if not text.isascii():
        folded = unicodedata.normalize("NFC", text.decode(errors="replace").casefold())
        for c in set(folded):
            if c > "\x7f" and MARKS[ord(c)] != c:
                folded = folded.translate(MARKS)
                break
        text = folded.encode()
    return text.translate(PLAIN).split()


def members(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values occur in the sorted array."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


MOST_BITS = 1 << 28


def possible_members(rows: DataFrame, column: Column, keys: DataFrame) -> DataFrame:
    """The rows with ``_possible``: false only if the column is surely not among ``keys`` (one column).

    A bitmap of the keys' hashes, 16 bits a key but at most MOST_BITS (32 MB), is broadcast, so that a following join
    shuffles only rows that may match.  With more keys than that allows, more rows are possible; none is lost.
    """
    bits = min(MOST_BITS, max(1 << 20, 1 << (16 * keys.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    marks = keys.select(place(F.col(keys.columns[0])).alias("_place"))
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap")
    bitmaps = marks.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(bitmap)
    placed = rows.select(F.struct("*").alias("_row"), place(column).alias("_place"))
    placed = placed.withColumn("_bucket", F.bitmap_bucket_number("_place"))
    joined = placed.join(F.broadcast(bitmaps), "_bucket", "left")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(bitmap_bit_position(_place) div 8 + 1 as int), 1)")), 16, 10)
    possible = F.coalesce(F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1, F.lit(False))
    return joined.select("_row.*", possible.alias("_possible"))
