"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A text holds an item if some run of its plain words (without case and marks) is within ``edits`` per cent of the item's
words of it, in insertions, deletions and substitutions of words.

* Windows of an item's length are taken a few words apart.  Of these only the ones go on that have enough word
  n-grams in common with the items of that length: every run within the allowed edits keeps that many, so this loses
  nothing (the n-gram lemma).
* A window is embedded by WALKS random walks (Chakraborty, Goldenberg, Koucky): at step t the walk writes the word it
  stands at, and a hash of the word and t says whether it moves on.  Few edits give few differing places.
* TABLES hash tables per walk sample SAMPLES places of the embedding.  A window meets the items that agree with it
  in all places of some table.
* An item of 2 * PIECE words or more is embedded in equal pieces of PIECE to 3/2 * PIECE words, and n-grams are counted
  for it alone.  The text is cut into windows of the piece's length, STRIDE words apart.  Some piece has no more than
  its share of the edits, so the recall does not fall with the length; one piece suffices, the whole item is verified.
  The recall is measured by tests, at the largest allowed distance, for items of 15 to 2000 words.
* What is retrieved is verified by exact edit distance (Myers' bit-parallel search), so nothing false is reported.

The items are a parameter of at most ``max_words`` words in all (more raise ValueError), and nothing is shuffled.  Items
that are null or have fewer than ``least_words`` words take no part; equal items are reported each.  A null or empty text
holds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from txnflow.llm.common import WordHashes, byte_texts, gram_hashes, members, mix, plain_words, process_memory, slices

WALKS, TABLES, SAMPLES = 16, 6, 2
PIECE, STRIDE, MOST_HITS = 50, 5, 1 << 22
EDITS, LEAST_WORDS, MAX_WORDS = 20, 5, 2_000_000


def embed(windows: np.ndarray, steps: int) -> np.ndarray:
    """CGK embeddings (window, walk, step) of rows of word hashes; 0 where a walk has left its window."""
    n, size = windows.shape
    padded = np.concatenate([windows, np.zeros((n, 1), np.uint64)], 1)
    at = np.zeros((n, WALKS), np.int64)
    rows = np.arange(n)[:, None]
    out = np.zeros((n, WALKS, steps), np.uint64)
    salts = mix(np.arange(1, WALKS * steps + 1, dtype=np.uint64)).reshape(WALKS, steps)
    for t in range(steps):
        words = padded[rows, at]
        out[:, :, t] = words
        move = ((words ^ salts[:, t]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)
        at = np.minimum(at + move.astype(np.int64), size)
    return out


def table_keys(windows: np.ndarray) -> np.ndarray:
    """The keys of each window in its WALKS * TABLES hash tables."""
    n, size = windows.shape
    steps = max(2, size + size // 2)  # later places are mostly behind the end
    embedded = embed(windows, steps)
    draws = mix(np.arange(WALKS * TABLES * SAMPLES, dtype=np.uint64) + np.uint64(size << 20))
    places = (draws % np.uint64(steps)).astype(np.int64).reshape(WALKS, TABLES, SAMPLES)
    keys = np.zeros((n, WALKS, TABLES), np.uint64)
    for s in range(SAMPLES):
        keys = mix(keys * np.uint64(3) + embedded[:, np.arange(WALKS)[:, None], places[:, :, s]])
    return mix(keys + np.arange(WALKS * TABLES, dtype=np.uint64).reshape(WALKS, TABLES)).reshape(n, -1)


def edit_search(item: list[int], words: list[int], anchored: bool = False) -> tuple[int, int]:
    """(distance, end) of the run of words nearest to the item that ends first; anchored runs begin at the first word."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, high = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best = (score, 0)
    for j, w in enumerate(words):
        equal = masks.get(w, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up, down = (minus | ~(horizontal | plus)) & full, plus & horizontal
        score += bool(up & high) - bool(down & high)
        up, down = (up << 1 | anchored) & full, down << 1 & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
        if score < best[0]:
            best = (score, j + 1)
    return best


class Lengths:
    """The items of one length, or one long item: what their windows must share with them, and the hash tables."""

    def __init__(self, size: int, edits: int, items: list[tuple[int, np.ndarray]]):
        self.size, self.allowed, self.items = size, size * edits // 100, items
        self.gram = next((q for q in (3, 2, 1) if size - q + 1 > q * self.allowed), 1)
        self.least = max(1, size - self.gram + 1 - self.gram * self.allowed)
        self.step = max(1, min(STRIDE, self.allowed // 2))
        self.pieces = max(1, size // PIECE)
        self.piece = size // self.pieces
        self.grams = np.unique(np.concatenate([gram_hashes(w, self.gram) for _, w in items]))
        keys = table_keys(np.concatenate([w[: self.pieces * self.piece].reshape(self.pieces, self.piece) for _, w in items]))
        self.table: dict[int, list[tuple[int, int]]] = {}  # (item, first word of the piece)
        for number, own in enumerate(keys.tolist()):
            for k in set(own):
                self.table.setdefault(k, []).append((number // self.pieces, number % self.pieces * self.piece))
        self.keys = np.unique(keys)

    def starts(self, hits: np.ndarray, n: int) -> np.ndarray:
        """Windows of n words whose surroundings have enough of the n-grams; hits are the places of n-grams."""
        if len(hits) < self.least:
            return hits[:0]
        low, high = hits[0] - self.size, hits[-1] + 1
        begin = np.arange(max(0, low), max(1, min(high, n - self.size + self.allowed) + 1), self.step)
        first = np.searchsorted(hits, begin - self.allowed)
        last = np.searchsorted(hits, begin + self.size + self.allowed - self.gram, side="right")
        return begin[last - first >= self.least]

    def embedded(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Windows of a piece's length to look up: those in the surroundings of the windows of a whole item."""
        if self.pieces == 1 or not len(starts):
            return starts
        low, high = np.maximum(0, starts - self.allowed), np.minimum(n, starts + self.size + self.allowed)
        new = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
        ends = high[np.r_[new[1:] - 1, len(high) - 1]]
        return np.concatenate([np.arange(a, b, self.step) for a, b in zip(low[new], ends, strict=True)])


class Index:
    """The items by length; long ones each by itself."""

    def __init__(self, items: list[tuple[int, str | None]], edits: int, least_words: int, max_words: int):
        hashes, by_size = WordHashes(), {}
        self.total = 0
        for item_id, text in items:
            words = hashes.of(plain_words((text or "").encode()))
            if len(words) >= max(1, least_words):
                alone = self.total if len(words) >= 2 * PIECE else -1
                by_size.setdefault((len(words), alone), []).append((item_id, words))
                self.total += len(words)
        if self.total > max_words:
            raise ValueError(f"the items have more than {max_words} words")
        self.lengths = [Lengths(size, edits, by_size[size, alone]) for size, alone in sorted(by_size)]
        self.known, self.owners = {}, {}
        for q in sorted({c.gram for c in self.lengths}):
            own = [(i, c.grams) for i, c in enumerate(self.lengths) if c.gram == q]
            grams = np.concatenate([g for _, g in own])
            owner = np.concatenate([np.full(len(g), i) for i, g in own])
            order = np.argsort(grams, kind="stable")
            self.known[q], self.owners[q] = grams[order], owner[order]
        self.fewest = min((c.least for c in self.lengths), default=1)

    def windows(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(number in ``lengths``, starts of windows to look up)."""
        for q, known in self.known.items():
            grams = gram_hashes(words, q)
            places = np.flatnonzero(members(known, grams))
            if len(places) < self.fewest:
                continue
            low = np.searchsorted(known, grams[places])
            many = np.searchsorted(known, grams[places], side="right") - low
            parts = np.flatnonzero(np.diff(np.cumsum(many) // MOST_HITS, prepend=0))  # n-grams that very many items share
            counts = np.zeros(len(self.lengths), np.int64)
            for lows, numbers in zip(np.split(low, parts), np.split(many, parts), strict=True):
                at = np.repeat(lows - np.cumsum(numbers) + numbers, numbers) + np.arange(numbers.sum())
                owner = self.owners[q][at]
                counts += np.bincount(owner, minlength=len(self.lengths))
            place = np.repeat(places, many) if not len(parts) else None
            for i in np.flatnonzero(counts):
                length = self.lengths[i]
                if counts[i] >= length.least:
                    hits = np.flatnonzero(members(length.grams, grams)) if place is None else place[owner == i]
                    starts = length.embedded(length.starts(hits, len(words)), len(words))
                    if len(starts):
                        yield int(i), starts

    def matches(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item id, distance, first word, word after the last) for the word hashes of some texts."""
        asked: dict[int, list[tuple[int, int]]] = {}
        for i, words in enumerate(texts):
            for number, starts in self.windows(words):
                asked.setdefault(number, []).extend((i, s) for s in starts.tolist())
        for number, windows in asked.items():
            length = self.lengths[number]
            found: dict[tuple[int, int], list[int]] = {}
            for lo in range(0, len(windows), 2000):
                part = windows[lo : lo + 2000]
                rows = np.zeros((len(part), length.piece), np.uint64)
                for row, (i, s) in zip(rows, part, strict=True):
                    own = texts[i][s : s + length.piece]
                    row[: len(own)] = own
                keys = table_keys(rows)
                at, column = np.nonzero(members(length.keys, keys.reshape(-1)).reshape(keys.shape))
                for row, key in zip(at.tolist(), keys[at, column].tolist(), strict=True):
                    for item, before in length.table[key]:
                        found.setdefault((part[row][0], item), []).append(part[row][1] - before)
            for (i, item), starts in found.items():
                yield from self.verified(length, i, item, texts[i], sorted(set(starts)))

    def verified(self, length: Lengths, i: int, item: int, words: np.ndarray, starts: list[int]) -> Iterator[tuple]:
        """The nearest run of each group of neighbouring windows, if it is near enough."""
        item_id, own = length.items[item]
        pattern, slack = own.tolist(), length.allowed + length.step
        groups: list[list[int]] = []
        for s in starts:
            if groups and s - groups[-1][1] <= length.size:
                groups[-1][1] = s
            else:
                groups.append([s, s])
        for first, last in groups:
            base = max(0, first - slack)
            run = words[base : last + length.size + slack].tolist()
            distance, end = edit_search(pattern, run)
            if distance <= length.allowed:
                _, back = edit_search(pattern[::-1], run[:end][::-1], anchored=True)
                yield i, item_id, distance, base + end - back, base + end


def build(benchmark: DataFrame, text: str = "text", key: str = "item_id", edits: int = EDITS, least_words: int = LEAST_WORDS, max_words: int = MAX_WORDS) -> Index:
    """The index of a benchmark table; its size is checked before it is fetched."""
    rows = benchmark.select(F.col(key).cast("long"), F.col(text)).dropna()
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if size > 40 * max_words:
        raise ValueError(f"the items have more than {max_words} words")
    return Index([tuple(r) for r in rows.collect()], edits, least_words, max_words)


def leaks(docs: DataFrame, index: Index, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, item_id, distance, start, end) of every item a document holds; start and end count plain words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            texts = [hashes.of(plain_words(t)) for t in byte_texts(batch.column("text"))]
            found = list(zip(*index.matches(texts), strict=True)) or [[]] * 5
            keys = batch.column("key").take(pa.array(found[0], pa.int64()))
            names = ["key", "item_id", "distance", "start", "end"]
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.int64()) for c in found[1:])], names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, item_id long, distance long, start long, end long").withColumnRenamed("key", key)


def contaminated(text: Column, index: Index) -> Column:
    """True if the text holds an item; for use in a filter."""
    hashes = WordHashes()

    @F.arrow_udf(BooleanType())
    def held(texts: pa.Array) -> pa.Array:
        process_memory("")
        flags = np.zeros(len(texts), bool)
        for lo in range(0, len(texts), 200):
            own = [hashes.of(plain_words(t)) for t in byte_texts(texts.slice(lo, 200))]
            for match in index.matches(own):
                flags[lo + match[0]] = True
        return pa.array(flags)

    return held(text)
