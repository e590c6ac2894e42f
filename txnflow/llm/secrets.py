"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its content (sha256).  The ledger, a folder of two Parquet tables, records
which (blob, rule version) pairs have been scanned and the spans found.  A scan moves and reads the text of those blobs
only for which a pair is missing, once per blob however many paths hold it, and the findings are joined back to all
paths.  A rule whose pattern changes is a new one.

All of it is DataFrame functions.  Texts of one blob are combined before the shuffle, so a blob that a third of all
paths hold costs one row per task.  Positions come from the lengths of matches and of the text between them.
Findings are written before the marks: a scan that breaks off is repeated, and repeated findings are read once.

A null text is the empty blob.  Repeated paths give repeated rows.  An empty table leaves an empty ledger.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txnflow.llm.common import possible_members
from txnflow.session import stored


@dataclass(frozen=True)
class Rule:
    """A pattern; the match counts if the group ``measured`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int
    measured: int = 0
    version: int = 1

    @property
    def id(self) -> str:
        """Changes with everything that decides what is found."""
        own = f"{self.pattern}\0{self.least}\0{self.measured}"
        return f"{self.kind}@{self.version}:{hashlib.sha256(own.encode()).hexdigest()[:16]}"


#: Fixed patterns, in the order in which spans of one start are listed.
RULES = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),  # the runs of [0-9a-f]+ that are long enough
)

SCANNED = "blob string, rule string"
FOUND = "blob string, rule string, start long, end long"
SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def read_ledger(spark, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, start, end) of the matches that count, for rows (blob, text, todo: ids of the rules to apply)."""
    hits = [F.when(F.array_contains("todo", r.id), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))) for r in rules]
    found = blobs.select("blob", "text", *[h.alias(f"hits{i}") for i, h in enumerate(hits)])
    found = found.filter(" or ".join(f"size(hits{i}) > 0" for i in range(len(rules))))
    per_rule = [
        F.when(
            F.size(f"hits{i}") > 0,
            F.struct(
                F.lit(r.id).alias("rule"),
                F.lit(r.least).alias("least"),
                F.arrays_zip(
                    F.transform(f"hits{i}", F.length).alias("size"),
                    F.transform(F.split("text", r.pattern, -1), F.length).alias("gap"),
                    F.transform(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.measured)), F.length).alias("own"),
                ).alias("parts"),
            ),
        )
        for i, r in enumerate(rules)
    ]
    rows = found.select("blob", F.explode(F.array(*per_rule)).alias("r")).filter("r is not null")
    rows = rows.select("blob", "r.rule", "r.least", F.posexplode("r.parts").alias("i", "p"))
    before = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p.size").cast("long") + F.col("p.gap")).over(before)
    rows = rows.withColumn("end", end).filter("p.size is not null and p.own >= least")
    return rows.select("blob", "rule", (F.col("end") - F.col("p.size")).alias("start"), "end")


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Bring the ledger up to date: scan every (blob, rule version) pair of ``versions`` that it does not hold."""
    spark = versions.sparkSession
    marks, findings = f"{ledger}/scanned", f"{ledger}/findings"
    ids = F.array(*[F.lit(r.id) for r in rules])
    blobs = versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = read_ledger(spark, marks, SCANNED).filter(F.array_contains(ids, F.col("rule")))
    done = known.groupBy("blob").agg(F.collect_set("rule").alias("done"))
    left = F.array_except(ids, F.coalesce("done", F.array().cast("array<string>")))
    todo = blobs.select("blob").distinct().join(done, "blob", "left").select("blob", left.alias("todo"))
    todo = stored(todo.filter("size(todo) > 0"), "blobs-to-scan")
    unseen = possible_members(blobs, F.col("blob"), todo.select("blob")).filter("_possible")  # texts of others do not move
    unseen = unseen.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")
    find_spans(unseen, rules).write.mode("append").parquet(findings)
    todo.select("blob", F.explode("todo").alias("rule")).write.mode("append").parquet(marks)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``versions`` with ``_blob`` and ``_spans``, all spans of their text by start and rule; columns of
    these names, and ``_possible``, are replaced."""
    versions = versions.drop("_blob", "_spans", "_possible")
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.id, i)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.id, r.kind)])
    found = read_ledger(versions.sparkSession, f"{ledger}/findings", FOUND)
    found = found.filter(F.col("rule").isin([r.id for r in rules])).distinct()
    span = F.struct("start", rank[F.col("rule")].alias("rank"), kind[F.col("rule")].alias("kind"), "end")
    found = found.groupBy(F.col("blob").alias("_blob")).agg(F.sort_array(F.collect_list(span)).alias("_spans"))
    found = stored(found, "spans-by-blob")
    rows = possible_members(versions.withColumn("_blob", blob_id(F.col(text))), F.col("_blob"), found.select("_blob"))
    joined = rows.filter("_possible").join(found, "_blob", "left")  # the others are not shuffled
    rest = rows.filter("not _possible").withColumn("_spans", F.lit(None).cast(SPANS))
    both = joined.unionByName(rest).drop("_possible")
    return both.withColumn("_spans", F.coalesce("_spans", F.array().cast(SPANS)))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span replaced; spans that overlap are replaced together."""
    end = lambda x: x["end"].cast("bigint")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    step = lambda acc, x: F.struct(
        F.when(
            x["start"] >= acc["at"],
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")), F.lit(mark)),
        )
        .otherwise(acc["out"])
        .alias("out"),
        F.greatest(acc["at"], end(x)).alias("at"),
    )
    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
