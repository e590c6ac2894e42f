"""URL filter: a sorted array of 64-bit digests, memory-mapped by the tasks.

An entry is ``host/path``: it fits its host and every subdomain if the url's path starts with the entry's path.
Entries are of two kinds: rules (allow or block) and a list of blocked places.  The longest rule decides; without a
rule the url is blocked if an entry of the list fits, else allowed.

The index is one file: the entries' xxhash64 digests in order, the offsets of their strings, their kinds, the strings.
Spark hands it to each executor (``addFile``), every task maps it, and a url is judged by searching the digests of its
(host suffix, path prefix) pairs; a hit counts only if the stored string is equal.  Urls are never shuffled.  The index
is a parameter of the job, not data: it may hold ``max_entries`` entries, more raise ValueError.

Null urls and urls without ``://`` have empty host and path, and no entry fits an empty host.  Null and empty entries
are ignored; an entry given twice counts once, and block wins over allow.  Repeated urls are judged each.
"""

from __future__ import annotations

import os
import string
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK, LISTED = 0, 1, 2
VERDICTS = ("allow", "block", "block")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


class UrlIndex:
    """The index as written by :func:`build_index`; tasks call :meth:`open`."""

    def __init__(self, name: str, size: int, path_lengths: list[int]):
        self.name, self.size, self.path_lengths = name, size, path_lengths

    def open(self) -> UrlIndex:
        data = np.memmap(SparkFiles.get(self.name), np.uint8, "r")
        n = self.size
        self.digests = data[: 8 * n].view(np.uint64)
        self.offsets = data[8 * n : 16 * n + 8].view(np.uint64)
        self.kinds = data[16 * n + 8 : 17 * n + 8]
        self.strings = data[17 * n + 8 :]
        return self

    def entry(self, at: int) -> bytes:
        return self.strings[int(self.offsets[at]) : int(self.offsets[at + 1])].tobytes()

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The place of each key in the index, or -1: binary search of all digests, then the strings."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, digests)
        found = np.full(len(keys), -1, np.int64)
        inside = np.flatnonzero(at < self.size)
        for i in inside[self.digests[at[inside]] == digests[inside]]:
            place = int(at[i])
            while place < self.size and self.digests[place] == digests[i]:  # several strings may share a digest
                if self.entry(place) == keys[i]:
                    found[i] = place
                    break
                place += 1
        return found


def build_index(
    spark: SparkSession, entries: Iterable[tuple[str | None, int]] | DataFrame, max_entries: int = 50_000_000
) -> UrlIndex:
    """Write the index of (entry, kind) rows and hand it to the executors."""
    if isinstance(entries, DataFrame):
        rows = entries.limit(max_entries + 1).toLocalIterator()
    else:
        rows = iter(entries)
    best: dict[bytes, int] = {}
    for entry, kind in rows:
        if entry:
            host, slash, path = entry.partition("/")
            key = (host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)) + slash + path).encode()
            best[key] = BLOCK if BLOCK in (kind, best.get(key)) else max(kind, best.get(key, ALLOW))
            if len(best) > max_entries:
                raise ValueError(f"more than {max_entries} entries")
    keys = sorted(best, key=lambda k: (xxhash.xxh64_intdigest(k), k))
    lengths = sorted({len(k.decode()) - len(k.decode().partition("/")[0]) for k in keys}, reverse=True)
    offsets = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum([len(k) for k in keys], out=offsets[1:]) if keys else None
    folder = tempfile.mkdtemp(prefix="url-index-")  # the driver's copy, which Spark's file service hands out
    path = os.path.join(folder, os.path.basename(folder) + ".bin")
    with open(path, "wb") as out:
        np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys)).tofile(out)
        offsets.tofile(out)
        np.array([best[k] for k in keys], np.uint8).tofile(out)
        out.writelines(keys)
    spark.sparkContext.addFile(path)
    return UrlIndex(os.path.basename(path), len(keys), lengths)


def candidates(host: str, path: str, path_lengths: list[int]) -> list[str]:
    """Entries that would fit, the longest first; of equally long ones the longer host first."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    found = [(len(h) + n, len(h), h + path[:n]) for h in hosts for n in path_lengths if n <= len(path)]
    return [c for _, _, c in sorted(found, reverse=True)]


def judge(pages: DataFrame, index: UrlIndex, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, listed) of every row; listed is the longest fitting entry of the list."""
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = index.open()
        for batch in batches:
            keys: list[bytes] = []
            rows: list[int] = []
            for i, (h, p) in enumerate(zip(batch["host"], batch["path"], strict=True)):
                own = candidates(h, p, opened.path_lengths)
                keys += [c.encode() for c in own]
                rows += [i] * len(own)
            rule, listed = [None] * len(batch), [None] * len(batch)
            verdict = ["allow"] * len(batch)
            found = opened.find(keys)
            for j in np.flatnonzero(found >= 0):
                i, kind = rows[j], opened.kinds[found[j]]
                if kind == LISTED:
                    listed[i] = listed[i] or keys[j].decode()
                elif rule[i] is None:
                    rule[i], verdict[i] = keys[j].decode(), VERDICTS[kind]
            for i in range(len(batch)):
                if rule[i] is None and listed[i]:
                    verdict[i] = "block"
            yield batch.assign(rule=rule, verdict=verdict, listed=listed)

    kind = pages.schema[key].dataType.simpleString()
    schema = f"key {kind}, host string, path string, rule string, verdict string, listed string"
    return parts.mapInPandas(probe, schema).withColumnRenamed("key", key)
