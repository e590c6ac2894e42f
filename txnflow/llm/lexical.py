"""Ranked lexical search with NRA: sequential reads of impact-sorted lists, no random access.

Terms are the runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.  A document's score
for an item is the sum, over the item's distinct terms, of the term's weight times a saturating share of its count, in
whole numbers (:func:`weight`, :func:`length_norm`, :func:`share`).

1. Documents are read once and become blocks of about ``block_bytes`` of text: a row of arrays with each document's
   length and the counts of the terms that any item asks for.  No document moves; a term that all documents hold
   costs a few bytes a document.
2. The number of documents and of terms, and how many documents hold a term, are sums over the blocks.
3. A task turns a block's counts to lists of falling impact and reads the lists of an item together, in rounds.  Each
   document seen has a lower bound, what its lists have given so far, and an upper one, which adds the impact where
   reading stands in its other lists.  Rounds go on until the best ``k`` have met their upper bounds, no other
   document can reach or tie them with a smaller id, and no document that is still unseen can.
4. A task carries the k-th best score of an item from block to block as a bound, and gives k rows an item at most.
   Those of all tasks are ranked by a window, which keeps k rows of each task.

Items are taken in blocks of about ``most_terms`` distinct terms, a pass over the documents for each.  Rows with one
item id are one item, of all their terms.  A null text has no terms; a document without terms counts nowhere.  Rows
with one document id are documents each; null ids come after all others of their score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import PLAIN, byte_texts, slices
from txnflow.session import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = np.iinfo(np.int64).max

INDEX = "ids array<long>, terms_of array<long>, documents long, terms long, term binary, holders binary, place binary, count binary"


def weight(documents: int, holders: int) -> int:
    """Of a term that ``holders`` of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def length_norm(terms: int, documents: int, all_terms: int) -> int:
    """Ten and ninety times the document's terms over the mean."""
    return 100 - 90 + 90 * terms * documents // max(1, all_terms)


def share(count: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + 8 * norm)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, least: int = 0, step: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the best ``k`` documents by falling score, then id; scores below ``least`` may be left out.

    A list has places of ``ids`` and positive impacts, which fall.
    """
    lower, given = np.zeros(len(ids), np.int64), np.zeros((len(lists), len(ids)), bool)
    depth = 0
    while True:
        for i, (places, impacts) in enumerate(lists):  # a place stands once in a list
            lower[places[depth : depth + step]] += impacts[depth : depth + step]
            given[i, places[depth : depth + step]] = True
        depth, step = depth + step, 2 * step
        now = np.array([impacts[depth - 1] if depth < len(impacts) else 0 for _, impacts in lists], np.int64)
        unseen = int(now.sum())
        seen = np.flatnonzero(lower)
        upper = lower[seen] + unseen
        for i in np.flatnonzero(now):
            upper -= np.where(given[i, seen], now[i], 0)
        alive = upper >= least
        seen, upper = seen[alive], upper[alive]
        order = np.lexsort((ids[seen], -lower[seen]))
        seen, upper = seen[order], upper[order]
        best, rest = seen[:k], slice(k, None)
        if not unseen:
            return best, lower[best]
        full = len(best) == k
        last = int(lower[best[-1]]) if full else 0
        settled = bool((upper[:k] == lower[best]).all())
        out = (upper[rest] < last) | ((upper[rest] == last) & (ids[seen[rest]] > ids[best[-1:]])) if full else upper[rest] < 0
        if settled and out.all() and unseen < max(last, least):
            return best, lower[best]


def _index(docs: DataFrame, vocabulary: dict[bytes, int], block_bytes: int) -> DataFrame:
    """A row of INDEX per block of documents (key, text); numbers of terms start at 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        room = block_bytes

        def block() -> pa.RecordBatch:
            nonlocal ids, sizes, held, room
            many = np.fromiter(map(len, held), np.int64, len(held))
            code = np.concatenate([*held, np.zeros(0, np.int64)]) * max(1, len(ids)) + np.repeat(np.arange(len(ids)), many)
            code, count = np.unique(code, return_counts=True)
            term, holders = np.unique(code // max(1, len(ids)), return_counts=True)
            arrays = (term.astype("<i4"), holders.astype("<i4"), (code % max(1, len(ids))).astype("<i4"), count.astype("<i8"))
            columns = [
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.array([sum(n > 0 for n in sizes)], pa.int64()),
                pa.array([sum(sizes)], pa.int64()),
                *(pa.array([a.tobytes()], pa.binary()) for a in arrays),
            ]
            ids, sizes, held, room = [], [], [], block_bytes
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in INDEX.split(", ")])

        for batch in slices(batches, "text", min(block_bytes, 8 << 20)):
            for key, text in zip(batch.column("key").to_pylist(), byte_texts(batch.column("text")), strict=True):
                words = text.translate(PLAIN).split()
                ids.append(key)
                sizes.append(len(words))
                held.append(np.array(list(filter(None, map(vocabulary.get, words))), np.int64))
                room -= len(text)
            if room <= 0:
                yield block()
        if ids:
            yield block()

    return docs.mapInArrow(run, INDEX)


def _holders(index: DataFrame) -> dict[int, int]:
    """How many documents hold each of the asked terms."""

    def run(batches):
        for batch in batches:
            raw = [b"".join(batch.column(c).to_pylist()) for c in ("term", "holders")]
            term, holders = (np.frombuffer(r, "<i4").astype(np.int64) for r in raw)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(holders)], ["term", "holders"])

    rows = index.select("term", "holders").mapInArrow(run, "term long, holders long").groupBy("term").agg(F.sum("holders"))
    return {term: n for term, n in rows.collect()}  # a row per asked term


def _search(index: DataFrame, items: list[list[int]], weights: dict[int, int], documents: int, all_terms: int, k: int) -> DataFrame:
    """(item, doc, score): the best k of each task for each of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}  # by falling score as (-score, id)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values.fill_null(NO_ID).to_numpy()
                norm = np.array([length_norm(n, documents, all_terms) for n in batch.column("terms_of")[row].as_py()], np.int64)
                term, holders, place = (np.frombuffer(batch.column(c)[row].as_py(), "<i4") for c in ("term", "holders", "place"))
                shares = share(np.frombuffer(batch.column("count")[row].as_py(), "<i8"), norm[place])
                order = np.lexsort((-shares, np.repeat(term, holders)))
                place, shares, ends = place[order], shares[order], np.cumsum(holders)
                lists = {}
                for t, lo, hi in zip(term.tolist(), (ends - holders).tolist(), ends.tolist(), strict=True):
                    if weights[t]:
                        lists[t] = (place[lo:hi], shares[lo:hi] * weights[t])
                for item, terms in enumerate(items):
                    own = [lists[t] for t in terms if t in lists]
                    if own:
                        had = best.get(item, [])
                        at, scores = nra(own, ids, k, -had[-1][0] if len(had) == k else 0)
                        new = zip((-scores).tolist(), ids[at].tolist(), strict=True)
                        best[item] = sorted([*had, *(x for x in new if x[0])])[:k]
        rows = [(item, doc if doc != NO_ID else None, -score) for item, found in best.items() for score, doc in found]
        for lo in range(0, len(rows), 10_000):
            columns = zip(*rows[lo : lo + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc", "score"])

    return index.mapInArrow(run, "item long, doc long, score long")


def _blocks(items: DataFrame, most_terms: int) -> Iterator[list[tuple]]:
    """The items (item, terms) in blocks of about ``most_terms`` distinct terms."""
    block, known = [], set()
    for r in items.toLocalIterator():
        block.append((r["item"], r["terms"]))
        known.update(r["terms"])
        if len(known) >= most_terms:
            yield block
            block, known = [], set()
    if block:
        yield block


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    most_terms: int = 100_000,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """(item key, rank, key, score) of the ``k`` best documents of each item, scores above 0; ``key`` is an integer."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    terms = F.regexp_extract_all(F.translate(F.col(item_text), UPPER, LOWER), F.lit(TERM), F.lit(0))
    asked = items.select(F.col(item_key).alias("item"), F.explode(terms).alias("term"))
    asked = asked.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    kind = items.schema[item_key].dataType.simpleString()
    result = None
    for block in _blocks(asked, most_terms):
        numbers = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}), 1)}
        index = stored(_index(rows, {t.encode(): i for t, i in numbers.items()}, block_bytes), "lexical-index")
        documents, all_terms = (x or 0 for x in index.agg(F.sum("documents"), F.sum("terms")).first())
        weights = {t: weight(documents, n) for t, n in _holders(index).items()}
        found = _search(index, [[numbers[t] for t in own] for _, own in block], weights, documents, all_terms, k)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(block)], f"item long, name {kind}")
        part = found.join(F.broadcast(names), "item").select(
            F.col("name").alias(item_key), "rank", F.col("doc").alias(key), "score"
        )
        result = part if result is None else result.unionByName(part)
    if result is None:
        result = spark.createDataFrame([], f"{item_key} {kind}, rank int, {key} long, score long")
    return result
