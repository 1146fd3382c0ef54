"""Cross-site boilerplate lines, found by their spread over distinct sites, in DataFrame functions only.

Each line's sites go into a HyperLogLog sketch per line hash; sketches merge by aggregation, so a line that a third
of all rows share costs one sketch per task. Lines whose estimate is clear of the threshold are decided by it;
those near it get an exact distinct count. A line on enough sites is removed everywhere but in the document of the
smallest id that has it, so that no content is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct sites from which a line is boilerplate, and the shortest line (code points, trimmed) that can be: any that is not blank.
SITES, SHORTEST = 10, 1
#: Sketch size (log2 of the buckets; relative error 1.04 / sqrt(4096) = 1.6 %), and the band that is counted exactly.
BUCKETS, BAND = 12, 0.25
#: Columns that exist only between a join and the next selection.
DROP, DROPPED, KEPT = "__souk_drop", "__souk_dropped", "__souk_kept"


def _hashes(line: Column) -> list[Column]:
    trimmed = F.trim(line)
    return [F.xxhash64(trimmed).alias("h1"), F.xxhash64(F.lit("second"), trimmed).alias("h2")]


def _counts(line: Column, shortest: int) -> Column:
    """Whether a line can be boilerplate: long enough, and not blank (white space of any kind, as the CR of a CRLF file)."""
    return (F.length(F.trim(line)) >= shortest) & (F.length(F.btrim(line, F.lit(" \t\r\f\x0b"))) > 0)


def _lines(docs: DataFrame, key: str, text: str, site: str, shortest: int) -> DataFrame:
    split = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.explode(F.split(text, "\n")).alias("line")
    )
    return split.filter(_counts(F.col("line"), shortest)).select("doc_id", "site", *_hashes(F.col("line")))


def boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES, shortest: int = SHORTEST) -> DataFrame:
    """``(h1, h2, first)`` of the lines on at least ``sites`` sites, with the smallest id that has each."""
    lines = _lines(docs, key, text, site, shortest)
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(BUCKETS)).alias("sketch"), F.min("doc_id").alias("first")).select(
        "h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("estimate")
    ).filter(F.col("estimate") >= sites * (1 - BAND))
    clear = F.col("estimate") > sites * (1 + BAND)
    near = spread.filter(~clear).select("h1", "h2")
    exact = lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count_distinct("site").alias("exact"))
    return spread.join(exact, ["h1", "h2"], "left").filter(clear | (F.col("exact") >= sites)).select("h1", "h2", "first")


def remove_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with ``text`` less its boilerplate lines, and two columns more: ``souk_lines`` and ``souk_removed``, their numbers.

    A null text stays null and an empty one empty, both without lines; blank lines always stay, and so do those under ``shortest``; a null
    site counts as one site. Rows of the smallest id keep their lines, all of them if the id repeats; rows with a
    null id lose every boilerplate line that another row keeps. Repeated rows give repeated rows, an empty table
    gives none, and columns of any other name pass through.
    """
    found = boilerplate(docs, key, text, site, sites, shortest)
    lines = _lines(docs, key, text, site, shortest)
    drops = lines.join(found, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("doc_id").agg(
        F.collect_set(F.struct("h1", "h2")).alias(DROP)
    ).withColumnRenamed("doc_id", DROPPED)
    joined = docs.join(drops, F.col(key).eqNullSafe(F.col(DROPPED)), "left")
    split = F.split(text, "\n")
    kept = F.filter(split, lambda x: ~_counts(x, shortest) | ~F.array_contains(DROP, F.struct(*_hashes(x))))
    shrunk = joined.withColumn(KEPT, F.when(F.col(DROP).isNotNull(), kept))
    n = F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(F.size(split)).cast("bigint")
    return shrunk.select(
        *[F.coalesce(F.array_join(KEPT, "\n"), F.col(text)).alias(text) if c == text else F.col(c) for c in docs.columns],
        n.alias("souk_lines"), F.coalesce(n - F.size(KEPT), F.lit(0)).cast("bigint").alias("souk_removed"),
    )


def without_boilerplate(docs: DataFrame, text: str = "text", size: str = "n_chars", **names) -> DataFrame:
    """``docs`` less boilerplate lines and less the rows that had text and have none left; ``size`` follows the text, if there is such a
    column. Nulls, repeats and empty tables are as in ``remove_boilerplate``."""
    left = remove_boilerplate(docs, text=text, **names).filter((F.col("souk_removed") == 0) | (F.length(F.trim(text)) > 0))
    if size not in docs.columns:
        return left.select(*docs.columns)
    return left.withColumn(size, F.when(F.col("souk_removed") > 0, F.length(text).cast("bigint")).otherwise(F.col(size))).select(*docs.columns)


def line_digests(docs: DataFrame, **names) -> DataFrame:
    """Per row: ``doc_id``, ``n_lines``, ``n_removed`` and ``kept_sha256`` of the text that is left (null: empty)."""
    text, key = names.get("text", "text"), names.get("key", "doc_id")
    left = remove_boilerplate(docs.select(key, text, names.get("site", "source")), **names)
    return left.select(
        F.col(key).alias("doc_id"), F.col("souk_lines").alias("n_lines"), F.col("souk_removed").alias("n_removed"),
        F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
