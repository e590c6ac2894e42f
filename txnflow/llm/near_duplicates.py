"""Near duplicates by a multi-index Hamming join of MinHash signatures.

A document's set are its distinct shingles of ``width`` words, A-Z lower-cased; with fewer words the whole sequence is
the one shingle; without words it is empty and linked with nothing.  Documents are linked if their sets have a
similarity (intersection by union) of ``similar`` per cent or more; the result are the connected components.

1. Documents with equal sets form a class.  Classes, not ids, are what is indexed, compared and linked, so rows with one
   id and different texts have the links of each.
2. A class has a signature of POSITIONS minima, 16 bits each.  The first CHUNKS x CHUNK of them are the index:
   each chunk is entered under every key that leaves one position out, so two signatures that differ in at most one
   position of some chunk meet.  By the pigeonhole principle that is every pair that differs in at most
   2 * CHUNKS - 1 = 19 of the 50 positions.  At a similarity of 0.8 the expected number is 10, and a pair misses all
   keys with probability 2e-6.
3. Keys that only one class has are dropped.  Every other member of a key is compared with its smallest one,
   and links give components.
4. Keys whose members still belong to several components are settled: members outside the largest component are
   compared with all members of other components, in blocks.  This is done twice: first under one
   key for each member, and only with the nearest partner in each block, which is enough to join most members of a
   dense group to its component; then every pair that is still between components.  A pair is taken up under its first common key only, and
   only if its signatures differ in at most FAR positions, and finer signatures of 1024 minima, made for the members of
   such keys alone, in at most FINE_FAR (both five standard deviations from what 0.8 gives; the finer ones let pass
   what is nearly as similar as 0.74).  Pairs within a component are never formed.
5. All links are confirmed on the full sets.

A class, key or document that a third of all rows share is combined before the shuffle, or joined with a table of one
row per key, which Spark splits.  Rows with a null id take no part and keep a null component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import WordHashes, arrow_rows, byte_texts, gram_hashes, mix, possible_members, slices
from txnflow.llm.components import components
from txnflow.session import stored

CHUNKS, CHUNK, POSITIONS, FAR = 10, 5, 128, 48
FINE, FINE_FAR = 1024, 255
BLOCK, CELL = 256, 1024

_n = np.arange(FINE, dtype=np.uint64)[:, None]
MULTIPLIERS = (mix(_n * np.uint64(2) + np.uint64(1)) | np.uint64(1)).astype(np.uint32)
SHIFTS = mix(_n * np.uint64(2) + np.uint64(12345)).astype(np.uint32)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a document's word hashes."""
    return np.unique(gram_hashes(words, min(width, len(words)))) if len(words) else words


def signature(own: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """Minima over the shingles, 16 bits of each."""
    low = np.full((positions, 1), 0xFFFFFFFF, np.uint32)
    mixed = (own >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(mixed), 1024):
        low = np.minimum(low, (MULTIPLIERS[:positions] * mixed[at : at + 1024] + SHIFTS[:positions]).min(1, keepdims=True))
    return (mix(low[:, 0].astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def fine_signature(own: np.ndarray) -> np.ndarray:
    """FINE minima, 4 bits of each, two in a byte."""
    bits = (signature(own, FINE) & 15).astype(np.uint8)
    return bits[::2] | bits[1::2] << 4


def fine_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many positions each fine signature of b differs from a."""
    differ = a ^ b
    return ((differ & 15) != 0).sum(1) + ((differ >> 4) != 0).sum(1)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """The CHUNKS * CHUNK keys of each signature: a chunk without one of its positions."""
    codes = signatures[:, : CHUNKS * CHUNK].astype(np.uint64).reshape(len(signatures), CHUNKS, CHUNK)
    keys = np.zeros((len(signatures), CHUNKS, CHUNK), np.uint64)
    for out in range(CHUNK):
        packed = np.zeros((len(signatures), CHUNKS), np.uint64)
        for i in range(CHUNK):
            if i != out:
                packed = packed << np.uint64(16) | codes[:, :, i]
        numbers = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(out + 1)
        keys[:, :, out] = mix(packed ^ mix(numbers))
    return keys.reshape(len(signatures), CHUNKS * CHUNK)


def first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of signatures, the number of the first key they have in common; CHUNKS * CHUNK without any."""
    differ = (a != b)[:, : CHUNKS * CHUNK].reshape(len(a), CHUNKS, CHUNK)
    errors = differ.sum(2)
    chunk = np.argmax(errors <= 1, axis=1)
    rows = np.arange(len(a))
    number = chunk * CHUNK + np.where(errors[rows, chunk] == 1, differ[rows, chunk].argmax(1), 0)
    return np.where(errors[rows, chunk] <= 1, number, CHUNKS * CHUNK)


def _lowered(batch: pa.RecordBatch, hashes: WordHashes) -> Iterator[np.ndarray]:
    for t in byte_texts(batch.column("text")):
        yield hashes.of(t.lower().split())  # bytes.lower() changes A-Z alone


def _describe(rows: DataFrame, width: int) -> DataFrame:
    """(key, content, n, digest of the set, signature)."""

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            sets = [shingles(w, width) for w in _lowered(batch, hashes)]
            columns = [
                batch.column("key"),
                batch.column("content"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) for s in sets], pa.binary()),
                pa.array([signature(s).astype("<u2").tobytes() if len(s) else None for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "content", "n", "digest", "signature"])

    return rows.mapInArrow(run, "key long, content long, n long, digest binary, signature binary")


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """(key, members): the whole set of each document."""

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            sets = [shingles(w, width).astype("<u8").tobytes() for w in _lowered(batch, hashes)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], ["key", "members"])

    return rows.mapInArrow(run, "key long, members binary")


def _fine(sets: DataFrame) -> DataFrame:
    """(key, fine): the fine signature of each set."""

    def run(batches):
        for batch in batches:
            fine = [fine_signature(np.frombuffer(m, "<u8")).tobytes() for m in batch.column("members").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(fine, pa.binary())], ["key", "fine"])

    return sets.select("key", "members").mapInArrow(run, "key long, fine binary")


def _enter(representatives: DataFrame) -> DataFrame:
    """(bucket, number, key) of every index key of every signature."""

    def run(batches):
        for batch in batches:
            raw = b"".join(batch.column("signature").to_pylist())
            signatures = np.frombuffer(raw, "<u2").reshape(batch.num_rows, POSITIONS)
            for lo in range(0, batch.num_rows, 1000):
                keys = index_keys(signatures[lo : lo + 1000])
                own = batch.column("key").to_numpy()[lo : lo + 1000]
                number = np.tile(np.arange(keys.shape[1], dtype=np.int8), len(own))
                columns = [pa.array(keys.reshape(-1).view(np.int64)), pa.array(number), pa.array(np.repeat(own, keys.shape[1]))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "number", "key"])

    return representatives.select("key", "signature").mapInArrow(run, "bucket long, number byte, key long")


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    Pairs are dealt to the cells of a square by a and b, about CELL pairs in each, so that a set goes to a row or a
    column of cells at most and pairs of a dense group share their sets; a cell with many more pairs (a document with
    very many partners) is divided by b.
    """
    side = max(1, math.isqrt(pairs.count() // CELL))
    at = [F.pmod(F.xxhash64(c), F.lit(side)).alias(f"{c}_cell") for c in ("a", "b")]
    pairs = pairs.select("a", "b", *at)
    full = pairs.groupBy("a_cell", "b_cell").agg(F.ceil(F.count("*") / CELL).alias("parts"))
    full = stored(full.filter("parts > 4"), "full-cells")
    pairs = pairs.join(full, ["a_cell", "b_cell"], "left")
    part = F.pmod(F.xxhash64("b", F.lit(1)), F.coalesce("parts", F.lit(1)))
    pairs = pairs.select("a", "b", F.struct("a_cell", "b_cell", part.alias("part")).alias("cell"))
    cell = F.col("cell").alias("home")
    needed = pairs.select(cell, F.col("a").alias("key")).union(pairs.select(cell, "b")).distinct()
    needed = needed.join(sets, "key")

    def check(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        members = {k: np.frombuffer(m, "<u8") for k, m in zip(sets.column("key").to_pylist(), sets.column("members").to_pylist(), strict=True)}
        a, b = pairs.column("a").to_pylist(), pairs.column("b").to_pylist()
        linked = []
        for x, y in zip(a, b, strict=True):
            s, t = sorted((members[x], members[y]), key=len)
            common = 0
            if 100 * len(s) >= similar * len(t):
                at = np.searchsorted(t, s)
                at[at == len(t)] = 0
                common = int((t[at] == s).sum())
            linked.append(100 * common >= similar * (len(s) + len(t) - common))
        return pairs.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return pairs.groupBy("cell").cogroup(needed.groupBy("home")).applyInArrow(check, "a long, b long")


def _across(buckets: DataFrame, labels: DataFrame, signatures: DataFrame, sets: DataFrame, nearest: bool) -> DataFrame:
    """The pairs (a, b) that share a key, belong to different components and have near signatures; each pair once.

    With ``nearest``, for each member under one key alone, and only the nearest of its partners in a block.
    """
    tagged = buckets.join(labels.withColumnRenamed("node", "key"), "key", "left")
    tagged = stored(tagged.select("bucket", "number", "key", F.coalesce("label", "key").alias("label")), "tagged")
    counts = tagged.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max_by("label", "n").alias("top"))
    mixed = stored(mixed.filter("labels > 1").select("bucket", "n", "top"), "mixed-buckets")
    rows = tagged.join(mixed, "bucket").withColumn("block", F.expr(f"pmod(xxhash64(key), ceil(n / {BLOCK}))"))
    rows = stored(rows, "mixed-rows")
    known = rows.select("key").distinct().join(signatures, "key")
    known = known.join(_fine(sets.join(rows.select("key").distinct(), "key")), "key")
    rows = rows.join(stored(known, "fine-signatures"), "key").withColumn("outside", F.expr("label <> top"))
    member = F.struct("key", "label", "outside", "signature", "fine")
    asks = F.col("outside")
    if nearest:
        here = F.when(asks, F.struct("number", "bucket"))
        asks = asks & (here == F.min(here).over(Window.partitionBy("key")))  # CHUNKS * CHUNK rows at most
    rows = stored(rows.select("bucket", "number", "block", asks.alias("asks"), member.alias("member")), "mixed-members")
    block = lambda r, name: r.groupBy("bucket", "number", "block").agg(F.collect_list("member").alias(name)).drop("block")
    joined = block(rows.filter("asks"), "one").join(block(rows, "other"), ["bucket", "number"])

    def unpack(members: pa.Array) -> tuple:
        raw = np.frombuffer(b"".join(members.field("signature").to_pylist()), "<u2").reshape(len(members), POSITIONS)
        fine = np.frombuffer(b"".join(members.field("fine").to_pylist()), np.uint8).reshape(len(members), FINE // 2)
        return (*(members.field(c).to_numpy(zero_copy_only=False) for c in ("key", "label", "outside")), raw, fine)

    def compare(batches):
        for batch in batches:
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            ones, others = batch.column("one"), batch.column("other")
            for i, number in enumerate(batch.column("number").to_pylist()):
                a, a_label, _, a_own, a_fine = unpack(ones[i].values)
                b, b_label, b_outside, b_own, b_fine = unpack(others[i].values)
                for j in range(len(a)):
                    fit = (b_label != a_label[j]) & (~b_outside.astype(bool) | (a[j] < b))
                    fit[fit] = (b_own[fit] != a_own[j]).sum(1) <= FAR
                    far = fine_distance(a_fine[j], b_fine[fit])
                    if nearest:
                        fit[fit] = far <= far.min(initial=FINE_FAR)
                        found_a.append(np.full(int(fit.any()), a[j]))
                        found_b.append(b[fit][:1])
                        continue
                    fit[fit] = far <= FINE_FAR
                    fit[fit] = first_common(np.broadcast_to(a_own[j], (int(fit.sum()), POSITIONS)), b_own[fit]) == number
                    found_a.append(np.full(int(fit.sum()), a[j]))
                    found_b.append(b[fit])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], ["a", "b"])

    return joined.select("number", "one", "other").mapInArrow(compare, "a long, b long")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (node, label) with the components joined that the links (a, b) join."""
    of = lambda c: F.coalesce(f"{c}_label", c).alias(c)
    for c in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")), c, "left")
    joined = components(links.select(of("a"), of("b")))
    last = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("last")), "label", "left")
    lone = joined.join(labels, "node", "left_anti")
    return stored(last.select("node", F.coalesce("last", "label").alias("label")).unionByName(lone), "components")


def content(text: Column) -> Column:
    """With the id, names a row's text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, similar: int = 80) -> DataFrame:
    """(key, content, n, group, component_id) of every row.

    Rows of one group are near duplicates; ``component_id`` is its smallest id.  The group is null where a row takes no
    part: it has no id or no words.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), content(F.col(text)).alias("content"), F.col(text).alias("text"))
    described = stored(_describe(rows, width), "signatures")
    known = described.filter("key is not null and n > 0")
    best = F.min(F.struct("key", "content")).alias("best")
    classes = known.groupBy("digest").agg(best, F.first("signature").alias("signature"))
    classes = stored(classes.select("digest", "best.*", "signature"), "classes")
    # Numbered by their smallest ids, so that the first of a key is the oldest text, of which others are often copies.
    classes = classes.repartitionByRange("key", "digest").sortWithinPartitions("key", "digest")
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "numbered-classes")
    signatures = classes.select(F.col("node").alias("key"), "signature")

    entered = _enter(signatures)
    shared = entered.groupBy("bucket", "number").agg(F.min("key").alias("pivot"), F.count("*").alias("n"))
    shared = stored(shared.filter("n > 1").select("bucket", "number", "pivot"), "shared-keys")
    buckets = stored(entered.join(shared, ["bucket", "number"]), "buckets")
    wanted = buckets.select(F.col("key").alias("node")).distinct().join(classes, "node")
    wanted = stored(wanted.select(F.xxhash64("key", "content").alias("mark"), "key", "content", "node"), "bucket-members")
    texts = possible_members(rows, F.xxhash64("key", "content"), wanted.select("mark")).filter("_possible")
    texts = texts.join(wanted, ["key", "content"]).select(F.col("node").alias("key"), "text").dropDuplicates(["key"])
    sets = stored(_sets(texts, width), "sets")

    star = buckets.filter("key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    links = stored(_confirmed(stored(star, "pairs"), sets, similar), "links")
    labels = components(links)
    for nearest in (True, False):
        across = _across(buckets, labels, signatures, sets, nearest)
        with arrow_rows(docs.sparkSession, 32):  # a row holds two blocks of members
            across = stored(across, "pairs")
        labels = _merged(labels, _confirmed(across, sets, similar))
    grouped = classes.select("digest", "node", "key").join(labels, "node", "left")
    grouped = stored(grouped.select("digest", "key", F.coalesce("label", "node").alias("group")), "groups")
    smallest = grouped.groupBy("group").agg(F.min("key").alias("component_id"))
    known = stored(grouped.select("digest", "group").join(smallest, "group"), "class-groups")
    result = described.select("key", "content", "n", "digest").join(known, "digest", "left")
    own = F.col("key").isNotNull()
    return result.select(
        "key",
        "content",
        "n",
        F.when(own, F.col("group")).alias("group"),
        F.when(own, F.coalesce("component_id", "key")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, similar: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; kept is the smallest id of a component, or a null id."""
    found = groups(docs, text, key, width, similar)
    kept = F.coalesce(F.col("key") == F.col("component_id"), F.lit(True))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
