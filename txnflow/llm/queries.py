"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm import (
    decontaminate,
    kneser_ney,
    language,
    lexical,
    licenses,
    merkle,
    near_duplicates,
    packing,
    quality,
    repeats,
    secrets,
    top_k,
    url_filter,
)
from txnflow.llm.common import held_out, table
from txnflow.session import scratch_table

#: The rules of the url query, and the places its list blocks.
URL_RULES = (
    ("org/", url_filter.ALLOW),
    ("example.org/es/", url_filter.BLOCK),
    ("example.org/en/1", url_filter.BLOCK),
    ("com/fr/", url_filter.ALLOW),
    ("com/de/", url_filter.BLOCK),
)
URL_LIST = ("cheap-pills.example.com/", "spam-farm.example.org/")
TOKENIZER = "word_bpe_49k.json"
QUALITY_LEAST = 0.3


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = url_filter.build_index(spark, [*URL_RULES, *((e, url_filter.LISTED) for e in URL_LIST)])
    return url_filter.judge(table(spark, sf_dir, "pages"), index)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 3, 1)
    found = language.predict(docs.withColumn("held_out", out), language.fit(docs.filter(~out)))
    languages = F.concat_ws(",", "mixture.lang")
    return found.select("doc_id", "held_out", "lang_pred", "score", languages.alias("languages"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch_table(spark, "secret-ledger")
    secrets.scan(docs, ledger)
    found = secrets.findings(docs, ledger).select("doc_id", "_spans")
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    spans = F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.RULES],
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"),
        spans.alias("spans"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = quality.labelled(table(spark, sf_dir, "labels"), "quality").filter(~held_out(F.col("_key"), 5, 0))
    model = quality.fit(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_LEAST).cast("int"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build(table(spark, sf_dir, "benchmark"))
    return decontaminate.leaks(table(spark, sf_dir, "documents"), index)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shortened = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    doubt = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], claimed=shortened, doubt=doubt)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 10, 0)
    return kneser_ney.scores(docs, kneser_ney.fit(docs.filter(~out)), held_out=out)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_near_dedup": op2_near_dedup,
    "op3_top_k": op3_top_k,
    "op4_language_id": op4_language_id,
    "op5_secret_scan": op5_secret_scan,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_lexical_search": op13_lexical_search,
}
