"""The corpus pipeline: documents through five operators, each stage written and read again.

Stages but the last return the columns of ``documents``; the last returns the packed pieces.  A null text counts as
empty, a null id as a document of its own; both pass where nothing speaks against them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm import decontaminate, near_duplicates, packing, quality, secrets
from txnflow.llm.common import held_out, possible_members, table
from txnflow.llm.queries import QUALITY_LEAST, TOKENIZER
from txnflow.session import scratch_table, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels that are not held out, does not reject."""
    labels = quality.labelled(table(spark, sf_dir, "labels"), "quality").filter(~held_out(F.col("_key"), 5, 0))
    model = quality.fit(docs, labels)
    return docs.filter(quality.score(F.col("text"), model) >= QUALITY_LEAST)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id, then content; all rows of no group."""
    grouped = near_duplicates.groups(docs).filter("group is not null")
    texts = stored(grouped.groupBy("group", "key", "content").agg(F.count("*").alias("n")), "near-duplicates")
    best = texts.groupBy("group").agg(F.min(F.struct("key", "content")).alias("best"))
    stays = F.struct("key", "content") == F.col("best")
    texts = texts.join(best, "group").select("key", "content", F.xxhash64("key", "content").alias("mark"), stays.alias("stays"), "n")
    some_go = stored(texts.filter("not stays or n > 1"), "texts-that-go")  # a row that occurs often stays once
    content = near_duplicates.content(F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"), content.alias("content"))
    rows = possible_members(rows, F.xxhash64("key", "content"), some_go.select("mark"))
    possible = rows.filter("_possible").drop("_possible")
    left = possible.join(some_go, ["key", "content"], "left_anti")
    once = possible.join(some_go.filter("stays"), ["key", "content"], "left_semi").dropDuplicates(["key", "content"])
    rest = rows.filter("not _possible").drop("_possible")  # these are not shuffled
    return left.unionByName(once).unionByName(rest).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    index = decontaminate.build(table(spark, sf_dir, "benchmark"))
    return docs.filter(~decontaminate.contaminated(F.col("text"), index))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    ledger = scratch_table(spark, "secret-ledger")
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    secrets.scan(rows, ledger)
    found = secrets.findings(rows, ledger)
    size = F.when(F.size("_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    found = found.withColumn("text", secrets.redacted(F.col("text"), F.col("_spans")))
    changed = {"text": F.col("text"), "n_chars": size}
    return found.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    # Earlier stages leave several worker processes an executor, and each in turn gets a dictionary of its own.
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER), memory=100_000)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: SQL cannot express the stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
