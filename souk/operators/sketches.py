"""Stored day sketches: quantiles and distinct counts of any span of days without reading its rows again.

A day's rows are read once into a KLL sketch of a value per key and a theta sketch of each id column. Both merge, so a span
of days is the union of a few small rows. A day that is written again replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Accuracy of the quantile sketch and log2 of the entries of the distinct sketch, and the errors that follow, with a margin: of
#: a quantile's rank, and of a count relative to it (three standard errors).
KLL_K, THETA_LG = 400, 12
RANK_ERROR, COUNT_ERROR = 0.015, 3 / 2 ** (THETA_LG / 2)


def write_quantile_days(rows: DataFrame, path: str, day: Column, keys: Sequence[str], value: str) -> None:
    """``(day, keys, sketch)`` of a value, a folder per day; rows without a value count for nothing."""
    sketches = rows.filter(F.col(value).isNotNull()).groupBy(day.alias("day"), *keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias("sketch"))
    _write_days(sketches, path)


def write_count_days(rows: DataFrame, path: str, day: Column, entities: Sequence[str]) -> None:
    """``(day, entity, sketch)`` of the ids in each column, a folder per day; null ids count for nothing."""
    wide = rows.groupBy(day.alias("day")).agg(*[F.theta_sketch_agg(F.col(e), F.lit(THETA_LG)).alias(e) for e in entities])
    _write_days(wide.select("day", F.inline(F.array(*[F.struct(F.lit(e).alias("entity"), F.col(e).alias("sketch")) for e in entities]))), path)


def _write_days(sketches: DataFrame, path: str) -> None:
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """The stored sketches of the days from ``first`` to ``last``; other folders are not opened."""
    stored = spark.read.parquet(path)
    if first is not None:
        stored = stored.filter(F.col("day") >= F.lit(first))
    return stored if last is None else stored.filter(F.col("day") <= F.lit(last))


def merged_quantile(stored: DataFrame, keys: Sequence[str], prob: float) -> DataFrame:
    """``(keys, n, quantile)`` over the days given; the quantile's rank is within ``RANK_ERROR`` of ``prob``."""
    whole = stored.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return whole.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(prob)).alias("quantile"))


def merged_counts(stored: DataFrame) -> DataFrame:
    """``(entity, distinct)`` over the days given, within ``COUNT_ERROR`` of the exact count."""
    return stored.groupBy("entity").agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", F.lit(THETA_LG))).alias("distinct"))
