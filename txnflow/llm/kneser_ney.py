"""Language-model scores: an interpolated modified Kneser-Ney model of word pairs.

Tokens are words, A-Z lower-cased, and an end after each text; the first token follows a start.  With c(vw) the count
of a pair, C(v) the count of v before a token, N1+(.w) the number of words before w, and D the discount of a count
(three each for counts and for numbers of words before, estimated from how many are 1, 2, 3 and 4):

    p(w|v) = max(c(vw) - D, 0) / C(v) + g(v) p(w),       g(v) = (D1 n1(v) + D2 n2(v) + D3 n3+(v)) / C(v)
    p(w)   = max(N1+(.w) - D, 0) / N1+(..) + g / (V + 1)

where n1(v), n2(v), n3+(v) count the words that follow v once, twice, more often, and the last term gives each of the V
tokens and an unknown one the same share.  After a word that was never seen p(w|v) = p(w).  The shares of all tokens
and the unknown one sum to 1.

1. A task counts the pairs of a slice of texts; these counts are dealt to shards by a hash of the pair, so a pair or a
   word that makes up a third of all tokens is a row per slice, and its pairs are in all shards.
2. A shard adds up its counts and stores them as a sorted array of 64-bit pair hashes with the counts beside.  What it
   knows of each word (count, words before, followers seen once, twice, more) goes to shards of words.
3. A shard of words adds up and stores sorted arrays too.  The driver gets sums and file names of each shard.
4. Tasks memory-map the arrays, look up the distinct pairs and words of a slice in order, and score its texts.

Equality of words and of pairs is that of 64-bit hashes.  Counts cover all training rows.  A null text is empty: its
only token is the end.  Repeated rows count, and are scored, each.  Without training rows every token has 1 / (V + 1),
which is 1.  Discounts that cannot be estimated, as a small corpus has none of a count, are 0.5, 1 and 1.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm import mapped
from txnflow.llm.common import SHINGLE_BASE, byte_texts, mix, process_memory, slices
from txnflow.session import scratch_table, stored

START, END = xxhash.xxh64_intdigest(b"start of a text"), xxhash.xxh64_intdigest(b"end of a text")  # no words: they hold spaces
FALLBACK = (0.5, 1.0, 1.5)
SLICE = 12 << 20
ESCAPE = 255


class LocalIds(dict):
    """Numbers of words in the order met, from 2."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) + 2
        return value


@dataclass
class Slice:
    """The tokens of some texts: ``right`` and the token before it, as places in ``words`` (64-bit hashes)."""

    words: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sizes: np.ndarray  # tokens of each text

    @classmethod
    def of(cls, texts: list[bytes]) -> Slice:
        ids = LocalIds()
        number = ids.__getitem__
        own = [np.fromiter(map(number, w), np.int32, len(w)) for w in (t.lower().split() for t in texts)]  # A-Z alone
        sizes = np.array([len(o) for o in own], np.int64)
        flat, ends = np.concatenate([*own, np.zeros(0, np.int32)]), np.cumsum(sizes)
        words = np.fromiter((START, END, *map(xxhash.xxh64_intdigest, ids)), np.uint64, len(ids) + 2)
        return cls(words, np.insert(flat, ends - sizes, 0), np.insert(flat, ends, 1), sizes + 1)

    def pairs(self, inverse: bool = False) -> tuple:
        """The distinct pairs as places (left, right), and how often each occurs or which one each token ends."""
        n = len(self.words)
        found = np.unique(self.left.astype(np.int64) * n + self.right, return_counts=not inverse, return_inverse=inverse)
        return found[0] // n, found[0] % n, found[1]


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(SHINGLE_BASE) + right)


def by_shard(keys: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of the shards that have keys; a shard is the first bits of a key."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(shard[order[lo]]), order[lo:hi]


def packed(a: np.ndarray, rises: bool = False) -> bytes:
    """Compressed, all first bytes first, then all second ones; of numbers that rise the differences."""
    a = np.ascontiguousarray(np.diff(a, prepend=a.dtype.type(0)) if rises else a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unpacked(block: bytes, kind: str, rises: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    a = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(a, dtype=kind) if rises else a


def pair_blocks(part: Slice, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """(shard, words, left, right, n) of the distinct pairs of a slice.

    A block has each of its words once, in order of the hashes; left and right are places there.
    """
    left, right, n = part.pairs()
    keys = pair_keys(part.words[left], part.words[right])
    order = np.argsort(part.words)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    left, right = rank[left], rank[right]
    in_order = np.lexsort((right, left))
    keys, left, right, n = keys[in_order], left[in_order], right[in_order], n[in_order]
    for shard, at in by_shard(keys, bits):
        own, places = np.unique(np.concatenate([left[at], right[at]]), return_inverse=True)
        v, w = places[: len(at)].astype("<u4"), places[len(at) :].astype("<u4")
        words = part.words[order[own]].astype("<u8")
        yield shard, packed(words, rises=True), packed(v, rises=True), packed(w), packed(n[at].astype("<u8"))


def read_pairs(words: bytes, left: bytes, right: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the left and right words of a block, and the counts."""
    own = unpacked(words, "<u8", rises=True)
    return own[unpacked(left, "<u4", rises=True)], own[unpacked(right, "<u4")], unpacked(n, "<u8")


def summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The distinct keys in order and the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *((np.add.reduceat(v[order], first) if len(first) else v[:0]) for v in values)]


def counts_of(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3 and 4."""
    return np.bincount(counts[counts <= 4].astype(np.int64), minlength=5)[1:5].tolist()


def discounts(n: list[int]) -> tuple[float, ...]:
    """Of counts of 1, 2 and 3 or more."""
    if not all(n):
        return FALLBACK
    y = n[0] / (n[0] + 2 * n[1])
    d = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return d if all(0 <= x <= k for k, x in enumerate(d, 1)) else FALLBACK


def discounted(counts: np.ndarray, d: tuple[float, ...]) -> np.ndarray:
    return counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


@dataclass
class Model:
    """Where the arrays are and what they add up to; tasks call :meth:`open`."""

    folder: str
    bits: int
    pair_files: dict[int, tuple[str, int, int]]
    word_files: dict[int, tuple[str, int]]
    tokens: int
    vocabulary: int
    pairs: int
    pair_discounts: tuple[float, ...]
    word_discounts: tuple[float, ...]
    word_share: float  # of the uniform part in p(w)

    def open(self) -> Model:
        self.pair_maps = {
            s: mapped.read(self.folder, file, [("<u8", n), ("u1", n), ("<u8", m), ("<u8", m)]) for s, (file, n, m) in self.pair_files.items()
        }
        self.word_maps = {s: mapped.read(self.folder, file, [("<u8", n)] * 6) for s, (file, n) in self.word_files.items()}
        return self

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for shard, at in by_shard(keys, self.bits):
            if shard in self.pair_maps:
                own, counts, large, large_counts = self.pair_maps[shard]
                at = at[np.argsort(keys[at])]  # in order, so that the pages of the file are read once
                place = np.minimum(np.searchsorted(own, keys[at]), len(own) - 1)
                out[at] = np.where(own[place] == keys[at], counts[place], 0)
                high = at[out[at] == ESCAPE]
                out[high] = large_counts[np.searchsorted(large, keys[high])]
        return out

    def word_stats(self, words: np.ndarray) -> np.ndarray:
        """Rows of count, words before, followers seen once, twice, more often."""
        out = np.zeros((5, len(words)), np.int64)
        for shard, at in by_shard(words, self.bits):
            if shard in self.word_maps:
                own, *stats = self.word_maps[shard]
                at = at[np.argsort(words[at])]
                place = np.minimum(np.searchsorted(own, words[at]), len(own) - 1)
                hit = own[place] == words[at]
                for row, stat in zip(out, stats, strict=True):
                    row[at] = np.where(hit, stat[place], 0)
        return out

    def score(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: number of known tokens, base score and the model's score, log10."""
        if not len(part.sizes):
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        count, before, *follow = self.word_stats(part.words)
        context = count.copy()
        context[0] = count[1]  # a text begins as often as it ends
        starts = np.cumsum(part.sizes) - part.sizes
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))
        lower = np.maximum(discounted(before, self.word_discounts), 0) / max(1, self.pairs) + self.word_share / (self.vocabulary + 1)
        with np.errstate(invalid="ignore", divide="ignore"):
            left_over = np.where(context > 0, sum(d * n for d, n in zip(self.pair_discounts, follow, strict=True)) / context, 1.0)
        v, w, which = part.pairs(inverse=True)
        counts = self.pair_counts(pair_keys(part.words[v], part.words[w]))
        own = np.maximum(discounted(counts, self.pair_discounts), 0) / np.maximum(context[v], 1)
        logs = np.log10(own + left_over[v] * lower[w])
        known = np.add.reduceat((count[part.right] > 0).astype(np.int64), starts)
        return known, np.add.reduceat(base[part.right], starts), np.add.reduceat(logs[which], starts)


def fit(docs: DataFrame, text: str = "text", shard_bytes: int = 256 << 20) -> Model:
    """Count all rows and store the model in the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // shard_bytes, 1)
    bits, folder = (shards - 1).bit_length(), scratch_table(spark, "kneser-ney")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            out = list(pair_blocks(Slice.of(byte_texts(batch.column("text"))), bits))
            kinds = (pa.int32(), *[pa.binary()] * 4)
            columns = zip(*out, strict=True) if out else [[]] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "words", "left", "right", "n"])

    kinds = [("shard", pa.int32()), ("file", pa.string()), ("size", pa.int64()), ("large", pa.int64()), ("counts", pa.list_(pa.int64()))]
    kinds += [("words", pa.binary()), ("stats", pa.binary())]
    names = "shard int, file string, size long, large long, counts array<long>, words binary, stats binary"

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blocks = zip(*(table.column(c) for c in ("words", "left", "right", "n")), strict=True)
        left, right, n = (np.concatenate(c) for c in zip(*(read_pairs(*(x.as_py() for x in b)) for b in blocks), strict=True))
        keys = pair_keys(left, right)
        order = np.argsort(keys)
        keys, left, right, n = keys[order], left[order], right[order], n[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, left, right, n = keys[first], left[first], right[first], np.add.reduceat(n, first)
        high = n >= ESCAPE
        arrays = [keys.astype("<u8"), np.minimum(n, ESCAPE).astype("u1"), keys[high].astype("<u8"), n[high].astype("<u8")]
        out = [(shard, mapped.write(folder, f"pairs-{shard}", arrays), len(keys), int(high.sum()), counts_of(n), None, None)]
        none, one = np.zeros(len(keys), np.uint64), np.ones(len(keys), np.uint64)
        follow = [(n == 1).astype(np.uint64), (n == 2).astype(np.uint64), (n > 2).astype(np.uint64)]
        both = [np.r_[a, b] for a, b in ((n, none), (one, none), *((none, f) for f in follow))]
        words, *stats = summed(np.r_[right, left], *both)
        for s, at in by_shard(words, bits):
            out.append((s, None, 0, 0, None, packed(words[at].astype("<u8"), rises=True), packed(np.concatenate([x[at] for x in stats]).astype("<u8"))))
        return pa.table([pa.array(c, k) for c, (_, k) in zip(zip(*out, strict=True), kinds, strict=True)], names=[k for k, _ in kinds])

    def merge_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        words = [unpacked(b, "<u8", rises=True) for b in table.column("words").to_pylist()]
        stats = [unpacked(b, "<u8").reshape(5, -1) for b in table.column("stats").to_pylist()]
        words, *stats = summed(np.concatenate(words), *np.concatenate(stats, 1))
        file = mapped.write(folder, f"words-{shard}", [a.astype("<u8") for a in (words, *stats)])
        sums = [int(stats[0].sum()), int((stats[0] > 0).sum()), int(stats[1].sum()), *counts_of(stats[1])]
        return pa.table([pa.array(c, k) for c, (_, k) in zip([[shard], [file], [len(words)], [0], [sums]], kinds, strict=False)], names=[k for k, _ in kinds[:5]])

    pairs = stored(rows.mapInArrow(count, "shard int, words binary, left binary, right binary, n binary").groupBy("shard").applyInArrow(merge, names), "pair-shards")
    of_words = pairs.filter("words is not null").groupBy("shard").applyInArrow(merge_words, names.split(", words")[0])
    pair_rows = pairs.filter("file is not null").select("shard", "file", "size", "large", "counts").collect()  # a row per shard
    word_rows = stored(of_words, "word-shards").collect()
    total = lambda rows, width: [sum(r["counts"][i] for r in rows) for i in range(width)]
    tokens, vocabulary, distinct, *word_counts = total(word_rows, 7)
    word_discounts = discounts(word_counts)
    once, twice = word_counts[:2]
    taken = np.dot(word_discounts, [once, twice, vocabulary - once - twice])
    return Model(
        folder,
        bits,
        {r["shard"]: (r["file"], r["size"], r["large"]) for r in pair_rows},
        {r["shard"]: (r["file"], r["size"]) for r in word_rows},
        tokens,
        vocabulary,
        distinct,
        discounts(total(pair_rows, 4)),
        word_discounts,
        float(taken) / distinct if distinct else 1.0,
    )


def scores(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", held_out: Column | None = None) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    out = held_out if held_out is not None else F.lit(None).cast("boolean")
    rows = docs.select(F.col(key).alias("key"), out.alias("held_out"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = process_memory(model.folder)
        if "opened" not in remembered:
            remembered["opened"] = model.open()
        opened = remembered["opened"]
        for batch in slices(batches, "text", SLICE, model.folder):
            part = Slice.of(byte_texts(batch.column("text")))
            known, base, score = opened.score(part)
            arrays = [batch.column("key"), batch.column("held_out"), part.sizes, known, np.full(len(known), model.tokens), base, score]
            arrays = [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays]
            names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    found = rows.mapInArrow(run, schema).withColumnRenamed("key", key)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
