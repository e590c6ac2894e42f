"""Language identification by a multilingual mixture.

A language is a distribution over hashed character trigrams of lower-case words.  A document's trigrams come from a
mixture of languages; expectation-maximisation estimates the proportions.  The set of languages is chosen by penalised
likelihood: beginning with the single best one, languages join in the order of their proportion in the full mixture
as long as the log-likelihood rises by more than ``penalty * log(trigrams) / 2``.  The prediction is the language with
the largest proportion of the chosen set.

Trigrams are counted by Spark over all training rows: a task adds up its rows per language, a shuffle adds up tasks.
The model has a fixed width, ``BUCKETS`` numbers for each language, so its size depends on the number of languages
alone; more than ``MAX_LANGUAGES`` raise ValueError.

A text without a letter, or null, is ``und`` with score 0; so is every text if there is nothing to learn from.  Rows
without text or language are not learnt from.  Long texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import mix, slices

BUCKETS = 1 << 16
MAX_LANGUAGES = 500
LETTERS = re.compile(r"[^\W\d_]+")


def trigrams(text: str | None) -> np.ndarray:
    """The bucket of each trigram of the words, a space before and after each; empty without letters."""
    words = LETTERS.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    grams = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
    return (mix(grams) & np.uint64(BUCKETS - 1)).astype(np.int64)


class Model:
    """Probabilities of the buckets, one column for each language (in order of their names)."""

    def __init__(self, languages: list[str], probabilities: np.ndarray):
        self.languages, self.probabilities = languages, probabilities


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.2) -> Model:
    """Count the trigrams of all rows that have a text and a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            for t, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if name not in sums:
                    sums[name] = np.zeros(BUCKETS, np.int64)
                sums[name] += np.bincount(trigrams(t), minlength=BUCKETS)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(own[at])], ["lang", "bucket", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).toLocalIterator())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((BUCKETS, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    for part in sums.toArrow().to_batches():
        at = np.fromiter(map(place.__getitem__, part.column("lang").to_pylist()), np.int64, part.num_rows)
        counts[part.column("bucket").to_numpy(), at] = part.column("n").to_numpy()
    seen = max(1, int((counts.sum(1) > 0).sum()))  # the mass of what a language lacks is spread over all trigrams seen
    counts += smoothing
    return Model(languages, counts / (counts.sum(0) + smoothing * seen))


def mixture(p: np.ndarray, n: np.ndarray, steps: int = 40, tolerance: float = 1e-4) -> tuple[np.ndarray, float]:
    """Proportions of the columns of p (trigram, language) for trigrams seen n times, and the log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(steps if p.shape[1] > 1 else 0):
        step = share * (n / (p @ share) @ p) / n.sum()
        moved, share = np.abs(step - share).max(), step
        if moved < tolerance:
            break
    return share, float(n @ np.log(p @ share))


def identify(model: Model, text: str | None, penalty: float = 4.0) -> tuple[str, float, list[tuple[str, float]]]:
    """(language, its proportion in the full mixture, the chosen languages with their proportions)."""
    grams = trigrams(text)
    if not len(grams) or not model.languages:
        return "und", 0.0, []
    buckets, n = np.unique(grams, return_counts=True)
    p, n = model.probabilities[buckets], n.astype(float)
    share, _ = mixture(p, n)
    single = n @ np.log(p)
    chosen = [int(np.argmax(single))]
    best, own = float(single[chosen[0]]), np.ones(1)
    for other in np.argsort(-share, kind="stable"):
        if other in chosen:
            continue
        weights, likelihood = mixture(p[:, [*chosen, other]], n)
        if likelihood - best <= penalty * np.log(max(2.0, n.sum())) / 2:
            break
        chosen, best, own = [*chosen, int(other)], likelihood, weights
    first = chosen[int(np.argmax(own))]
    names = sorted(((model.languages[c], float(w)) for c, w in zip(chosen, own, strict=True)), key=lambda x: (-x[1], x[0]))
    return model.languages[first], float(min(1.0, max(0.0, share[first]))), names


def predict(docs: DataFrame, model: Model, text: str = "text", penalty: float = 4.0) -> DataFrame:
    """The rows with lang_pred, score and mixture (the chosen languages, largest first), in place of such columns."""
    docs = docs.drop("lang_pred", "score", "mixture")
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.probabilities))
    kind = "struct<lang_pred:string,score:double,mixture:array<struct<lang:string,share:double>>>"
    fields = pa.struct(
        [("lang_pred", pa.string()), ("score", pa.float64())]
        + [("mixture", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))]
    )

    @F.arrow_udf(kind)
    def found(texts: pa.Array) -> pa.Array:
        own = Model(*shared.value)
        rows = [identify(own, t.as_py(), penalty) for t in texts]
        return pa.array(
            [{"lang_pred": a, "score": b, "mixture": [{"lang": x, "share": y} for x, y in c]} for a, b, c in rows], fields
        )

    return docs.withColumn("_found", found(F.col(text))).select(*docs.columns, "_found.*")
