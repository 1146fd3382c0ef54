"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every version of every file is addressed by its content's SHA-256. The ledger holds which blob was scanned under
which rule version, and what was found. A run scans only blob and rule-version pairs that the ledger lacks, each
blob once however many paths and versions carry it, appends to the ledger, and joins findings back to all paths.

Positions come from built-in functions alone: ``split`` gives the text between matches, ``regexp_extract_all`` the
matches, and running sums of their lengths the spans, in code points.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if the given group has at least ``least`` characters.

    ``hint`` is a cheap pattern that every kept match's text contains; texts without it are not searched.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str = ""

    @property
    def version(self) -> str:
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


#: The base rules first, in the order in which their spans are listed.
RULES = (
    Rule(
        "assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
        r"(?i)(?:password|passwd|secret|token|api_?key)",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA"),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40, r"gh[oprsu]_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, r"xox[abprs]-"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", 0, 28, r"eyJ"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, r"PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _matches(text: Column, rule: Rule) -> Column:
    """Per match, and once for the end: the text before it and the match."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(F.split(text, rule.pattern, -1).alias("before"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    return F.when(text.rlike(rule.hint or rule.pattern), found)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(blob, rule_version, kind, start, stop)`` of ``(blob, text, todo)``; ``todo`` lists the rule versions to run."""
    each = F.array(*[
        F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"), F.lit(r.pattern).alias("pattern"),
            F.lit(r.group).alias("group"), F.lit(r.least).alias("least"),
            F.when(F.array_contains("todo", r.version), _matches(F.col("text"), r)).alias("found"),
        )
        for r in rules
    ])
    runs = blobs.select("blob", F.inline(each)).filter("found is not null")
    parts = runs.select("blob", "kind", "rule_version", "group", "least", "pattern", F.posexplode("found").alias("i", "f")).select(
        "blob", "kind", "rule_version", "group", "least", "pattern", "i", F.length("f.before").alias("before"), F.col("f.match").alias("match")
    ).filter("match is not null")
    order = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    value = F.call_function("regexp_extract", F.col("match"), F.col("pattern"), F.col("group"))
    spans = parts.select("blob", "kind", "rule_version", "least", "i", "before", F.length("match").alias("size"), F.length(value).alias("value"))
    stop = F.sum(F.col("before") + F.col("size")).over(order)
    return spans.withColumn("stop", stop).filter(F.col("value") >= F.col("least")).select(
        "blob", "rule_version", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop"
    )


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger table, empty before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


FINDINGS = "blob string, rule_version string, kind string, start bigint, stop bigint"
SCANS = "blob string, rule_version string"


def update_ledger(texts: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger in folder ``ledger`` lacks, and append it. Returns the number of blobs that were scanned.

    Findings are written before the scans that vouch for them; a run that dies in between leaves findings that the
    next run finds and writes again, so readers take distinct rows.
    """
    spark = texts.sparkSession
    done = _read(spark, os.path.join(ledger, "scans"), SCANS).distinct()
    versions = F.array(*[F.lit(r.version) for r in rules])
    contents = texts.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")).dropDuplicates(["blob"])
    seen = done.groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
    unseen = contents.join(seen, "blob", "left").withColumn("todo", F.array_except(versions, F.coalesce("seen", F.array().cast("array<string>"))))
    unseen = unseen.filter(F.size("todo") > 0).select("blob", "text", "todo")
    scan(unseen, rules).write.mode("append").parquet(os.path.join(ledger, "findings"))
    blobs = texts.select(blob_of(F.col(text)).alias("blob")).distinct()
    new = blobs.select("blob", F.explode(versions).alias("rule_version")).join(done, ["blob", "rule_version"], "left_anti")
    new.write.mode("append").parquet(os.path.join(ledger, "scans"))
    return new.select("blob").distinct().count()


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Distinct findings of the present rule versions."""
    wanted = [r.version for r in rules]
    return _read(spark, os.path.join(ledger, "findings"), FINDINGS).filter(F.col("rule_version").isin(wanted)).distinct()


def secrets_by_row(docs: DataFrame, ledger: str, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: ``doc_id``, counts of the base kinds, the digest of the base spans and all spans as text.

    Every row is a version of a path. A null text is the empty blob, without findings; repeated rows and copies
    share a blob and each get its findings; a null key stays null; an empty table gives no rows; other columns are
    ignored. Spans are ``kind:start:stop`` by start, then by the order of the rules.
    """
    spark = docs.sparkSession
    update_ledger(docs, ledger, text, rules)
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    listed = findings(spark, ledger, rules).groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "stop"))).alias("spans"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
    )

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    per_blob = listed.select(
        "blob", *[f"n_{k}" for k in BASE],
        joined(F.filter("spans", lambda s: s["kind"].isin(*BASE))).alias("base"), joined(F.col("spans")).alias("spans"),
    )
    rows = docs.select(F.col(key).alias("doc_id"), blob_of(F.col(text)).alias("blob"))
    return rows.join(per_blob, "blob", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
