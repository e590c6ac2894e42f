"""Quality classifier: gradient-boosted trees over statistics of the text.

The statistics are computed for every whole text, in tasks.  Labels are learnt from at most ``sample`` labelled rows,
those with the smallest hash of the id: a bounded sample, fitted on the driver.  With labels of one kind alone, or none,
every score is their smoothed share (0.5 without any).  Scoring walks flattened trees, all rows of a batch
at once.

A null text counts as empty and has a score like every other.  Several labels of a document count with their mean;
null labels and labels of unknown documents are ignored.  Repeated documents are scored each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from txnflow.llm import boosting
from txnflow.llm.boosting import Trees
from txnflow.llm.common import process_memory

SAMPLE = 20_000
MOST_CODES = 2_000_000
FEATURES = (
    "characters words lines mean_word mean_line letters capitals digits spaces marks other_marks non_ascii "
    "distinct_words top_word repeated_lines repeated_line_characters repeated_grams upper_words long_words short_words "
    "words_with_marks line_ends sentence_words longest_word symbols_per_word distinct_characters short_lines"
).split()

CLASS = np.zeros(256, np.int64)  # 1 letter, 2 capital, 3 digit, 4 space, 5 punctuation of prose, 6 other marks, 7 the rest
CLASS[128:] = 7
for _kind, _characters in (
    (1, b"abcdefghijklmnopqrstuvwxyz"),
    (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (3, b"0123456789"),
    (4, b" \t\n\r\v\f"),
    (5, b".,;:!?'\"()-"),
    (6, b"#$%&*+/<=>@[\\]^_`{|}~"),
):
    CLASS[list(_characters)] = _kind
MARKED = re.compile(rb"[#$%&*+/<=>@\[\\\]^_`{|}~]")


def statistics(text: bytes) -> list[float]:
    """The numbers named in FEATURES; all zero for an empty text."""
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(text), len(words)
    raw = np.frombuffer(text, np.uint8)
    kinds = np.bincount(CLASS[raw], minlength=8) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    ids = {w: i for i, w in enumerate(counts)}
    codes = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    pairs = codes[:-1] * n + codes[1:]
    if n >= MOST_CODES:  # n ** 3 would overflow; numbers of distinct pairs are as good
        pairs = np.unique(pairs, return_inverse=True)[1]
    grams = pairs[:-1] * n + codes[2:]
    distinct_lines = set(lines)
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b'"') for x in lines)
    stops = text.count(b".") + text.count(b"!") + text.count(b"?")
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log1p(len(lines))),
        float(lengths.mean()),
        size / len(lines),
        float(kinds[1] + kinds[2] + kinds[7]),
        float(kinds[2]),
        float(kinds[3]),
        float(kinds[4]),
        float(kinds[5]),
        float(kinds[6]),
        float(kinds[7]),
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(distinct_lines) / len(lines),
        1 - sum(map(len, distinct_lines)) / sum(map(len, lines)),
        1 - len(np.unique(grams)) / max(1, len(grams)) if n > 2 else 0.0,
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        float((lengths > 15).mean()),
        float((lengths < 3).mean()),
        len(MARKED.findall(text)) / n,
        ends / len(lines),
        n / (stops + 1),
        float(np.log1p(lengths.max())),
        float(kinds[5] + kinds[6]) * size / n,
        float(np.log1p(np.count_nonzero(np.bincount(raw, minlength=256)))),
        sum(len(x) < 20 for x in lines) / len(lines),
    ]


@F.arrow_udf(ArrayType(FloatType()))
def _statistics(texts: pa.Array) -> pa.Array:
    rows = [statistics(t.as_py() or b"") for t in texts.cast(pa.binary())]
    return pa.array(rows, pa.list_(pa.float32()))


def features(text: Column) -> Column:
    """The statistics of a text as an array of FEATURES."""
    return _statistics(text)


def labelled(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """One row per document: key and the mean of its labels."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(key).alias("_key")).agg(F.avg(label).alias("_label"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, **options) -> Trees:
    """Fit to labelled documents (rows of :func:`labelled`): those ``sample`` labels with the smallest hash of the key.

    The sample's keys, a bounded number, are broadcast; statistics are computed for its documents only.
    """
    order = [F.xxhash64("_key"), "_key"]
    taken = labels.orderBy(*order).limit(sample)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = texts.join(F.broadcast(taken), "_key").select("_key", "_label", features(F.col("_text")).alias("_features"))
    rows = rows.orderBy(*order, "_features").limit(sample).toArrow()  # a key may have several rows
    x = np.array(rows.column("_features").to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return boosting.fit(x, np.array(rows.column("_label").to_pylist(), float), **options)


def score(text: Column, model: Trees) -> Column:
    """The probability of label 1 of a text; never null."""

    @F.arrow_udf(DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        process_memory("")
        rows = [statistics(t.as_py() or b"") for t in texts.cast(pa.binary())]
        x = np.array(rows, np.float32).reshape(-1, len(FEATURES))
        return pa.array(model.score(x), pa.float64())

    return scored(text)
