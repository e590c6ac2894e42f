"""Substring dedup by seeds and runs of words around them.

A repeat is a run of at least ``length`` words that also occurs in a document with a smaller id.  Seeds are hashes of
``seed`` consecutive words, winnowed: of the seeds in a run of ``length`` words the smallest is taken.  So equal runs
have equal seeds, and only seeds that two documents share can belong to a repeat.  The runs
of ``length`` words that hold such a seed are brought together by their 64-bit hashes, which takes the place of an
extension word by word; overlapping ones that have an earlier document merge to maximal repeats.

Documents are dealt to slices by a hash of their id; a slice holds about ``slice_bytes`` of text however large the
input is.  Within a slice equal seeds, and equal runs, are reduced to that of the smallest id before they move: a
passage that a third of all documents share costs a row per slice.  The texts are shuffled once, their slices read
three times (seeds, runs, removal).  No pairs of documents are formed.

Words are taken unchanged.  A null text has none.  A null id takes no part: nothing is removed from such a row, and it
is no source.  Rows with one id do not remove from each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import WordHashes, byte_texts, gram_hashes, mix

LENGTH, SEED = 13, 5


def run_seeds(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """For each run of ``length`` words, its seed: the smallest hash of ``seed`` words in it."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    return sliding_window_view(gram_hashes(words, seed), length - seed + 1).min(1)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n words lie in a run that begins at one of the starts."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def spans(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def smallest(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the entries that have the smallest key of their hash, in the order of the hashes."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    order = np.lexsort((keys, hashes))
    h, k = hashes[order], keys[order]
    new = np.r_[True, h[1:] != h[:-1]]
    first = k[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order[k == first]


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, seed: int = SEED, slice_bytes: int = 8 << 20
) -> DataFrame:
    """(key, n_words, n_removed, repeats, kept): the maximal repeats as word positions and the words that are left.

    ``key`` is an integer column.
    """
    if not 1 <= seed <= length:
        raise ValueError("a seed is part of a run")
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_slices = max(16 * partitions, math.ceil(size / slice_bytes))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(n_slices)))
    by_slice = rows.groupBy("slice")
    hashes = WordHashes()

    def in_order(table: pa.Table) -> Iterator[tuple[int | None, int, list[bytes]]]:
        """(key, words before, words): rows with one id count as parts of one document, in the order of their texts."""
        texts = byte_texts(table.column("text").combine_chunks())
        last, before = None, 0
        for k, t in sorted(zip(table.column("key").to_pylist(), texts, strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
            words = t.split()
            before = before if k == last else 0
            yield k, before, words
            last, before = k, before + len(words)

    def find_seeds(table: pa.Table) -> pa.Table:
        found, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, _, words in in_order(table):
            own = np.unique(run_seeds(hashes.of(words if k is not None else []), length, seed))
            found.append(own)
            keys.append(np.full(len(own), k or 0))
        found, keys = np.concatenate(found), np.concatenate(keys)
        values, at, places = np.unique(found, return_index=True, return_inverse=True)
        low, high = keys[at], keys[at].copy()
        np.minimum.at(low, places, keys)
        np.maximum.at(high, places, keys)
        number = table.column("slice")[0].as_py()
        columns = [np.full(len(values), number), values.view(np.int64), low < high]
        return pa.table(dict(zip(("slice", "seed", "many"), map(pa.array, columns), strict=True)))

    seeds = by_slice.applyInArrow(find_seeds, "slice long, seed long, many boolean")
    same = Window.partitionBy("seed")
    shared = seeds.withColumn("n", F.count("*").over(same)).filter("n > 1 or many").select("slice", "seed")

    def extend(table: pa.Table, wanted: pa.Table) -> pa.Table:
        """Runs that hold a shared seed: of equal ones in the slice those of the smallest id, one row for each with its
        starts; the others are repeats, listed in one row per document with the start -1."""
        seeds = np.sort(wanted.column("seed").to_numpy().view(np.uint64))
        found, keys, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, before, texts in in_order(table) if len(seeds) else ():
            words = hashes.of(texts if k is not None else [])
            own = run_seeds(words, length, seed)
            at = np.searchsorted(seeds, own)
            at[at == len(seeds)] = 0
            place = np.flatnonzero(seeds[at] == own)
            found.append(gram_hashes(words, length)[place] if len(place) else found[0])
            keys.append(np.full(len(place), k or 0))
            starts.append(place + before)
        found, keys, starts = np.concatenate(found), np.concatenate(keys), np.concatenate(starts)
        first = smallest(found, keys)
        later = np.ones(len(found), bool)
        later[first] = False
        number, begin, more = found[first], starts[first].astype(np.int32), []
        again = np.r_[False, number[1:] == number[:-1]] if len(first) else np.zeros(0, bool)  # a run twice in a document
        ends = np.r_[np.flatnonzero(~again)[1:], len(first)]
        for lo, hi in zip(np.flatnonzero(~again).tolist(), ends.tolist(), strict=False):
            more.append(begin[lo + 1 : hi].astype("<i4").tobytes() if hi - lo > 1 else None)
        order = np.flatnonzero(later)
        order = order[np.argsort(keys[order], kind="stable")]
        heads = np.flatnonzero(np.diff(keys[order], prepend=keys[order][:1] - 1))
        done = keys[order][heads]
        more += [starts[part].astype("<i4").tobytes() for part in np.split(order, heads[1:])] if len(order) else []
        return pa.table(
            {
                "run": pa.array(np.concatenate([number[~again], mix(done.view(np.uint64))]).view(np.int64)),
                "key": pa.array(np.concatenate([keys[first][~again], done])),
                "start": pa.array(np.concatenate([begin[~again], np.full(len(done), -1, np.int32)])),
                "more": pa.array(more, pa.binary()),
            }
        )

    runs = by_slice.cogroup(shared.groupBy("slice")).applyInArrow(
        extend, "run long, key long, start int, more binary"
    )
    repeated = runs.withColumn("first", F.min("key").over(Window.partitionBy("run"))).filter("first < key or start < 0")
    repeated = repeated.select(F.pmod(F.xxhash64("key"), F.lit(n_slices)).alias("slice"), "key", "start", "more")
    result = pa.schema(
        [("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
        + [("repeats", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())]
    )

    def remove(table: pa.Table, found: pa.Table) -> pa.Table:
        starts: dict[int, list] = {}
        for k, s, more in zip(*(found.column(c).to_pylist() for c in ("key", "start", "more")), strict=True):
            own = starts.setdefault(k, [])
            if s >= 0:
                own.append(np.array([s]))
            if more is not None:
                own.append(np.frombuffer(more, "<i4"))
        begin = {k: np.sort(np.concatenate(own)).astype(np.int64) for k, own in starts.items()}
        out: list[tuple] = []
        for k, before, words in in_order(table):
            mask, kept = np.zeros(len(words), bool), words
            if k in begin:
                lo, hi = np.searchsorted(begin[k], [before, before + len(words)])
                mask = covered(begin[k][lo:hi] - before, length, len(words))
                kept = [w for w, gone in zip(words, mask.tolist(), strict=True) if not gone]
            out.append((k, len(words), int(mask.sum()), spans(mask), b" ".join(kept).decode(errors="replace")))
        columns = zip(*out, strict=True) if out else [[] for _ in result]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, result, strict=True)], schema=result)

    final = by_slice.cogroup(repeated.groupBy("slice")).applyInArrow(
        remove, "key long, n_words long, n_removed long, repeats array<struct<start:long,end:long>>, kept string"
    )
    return final.withColumnRenamed("key", key)
