"""Scoring and ordering of candidate lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.scalars import ctr_cvr_score, ltr_linear_score
from souk.operators.ordered import global_rank


def rank_rows(df: DataFrame, score: str, query: str = "user_id", item: str = "item_id", bounded: bool = False) -> DataFrame:
    """Adds ``rank`` by falling score, null scores last; equal scores go to the smaller item id.

    If lists are ``bounded`` in length, each is ranked in one window. Otherwise a list may be of any length and is
    ranked across tasks.
    """
    if bounded:
        order = Window.partitionBy(query).orderBy(F.desc_nulls_last(score), F.asc(item))
        return df.withColumn("rank", F.row_number().over(order).cast("bigint"))
    keyed = df.withColumns({"_missing": F.col(score).isNull(), "_falling": -F.col(score)})
    return global_rank(keyed, [query], ["_missing", "_falling", item]).drop("_missing", "_falling")


def score_ctr(candidates: DataFrame) -> DataFrame:
    """Adds ``ctr`` and ``cvr``."""
    ctr, cvr = ctr_cvr_score(F.col("popularity"), F.col("base_price"), F.col("user_conversion_rate"))
    return candidates.withColumns({"ctr": ctr, "cvr": cvr})


def score_ltr(candidates: DataFrame) -> DataFrame:
    """Adds ``ltr_score``."""
    return candidates.withColumn(
        "ltr_score", ltr_linear_score(F.col("popularity"), F.col("user_conversion_rate"), F.col("base_price"))
    )


def rank_by_ctr(candidates: DataFrame, query: str = "user_id", item: str = "item_id", bounded: bool = False) -> DataFrame:
    return rank_rows(score_ctr(candidates), "ctr", query, item, bounded)


def rank_by_ltr(candidates: DataFrame, query: str = "user_id", item: str = "item_id", bounded: bool = False) -> DataFrame:
    return rank_rows(score_ltr(candidates), "ltr_score", query, item, bounded)


def cap_per_category(rows: DataFrame, cap: int, *order: Column, query: str = "user_id", category: str = "category") -> DataFrame:
    """At most ``cap`` items of a category per query, then ranked in ``order``; the cap is the diversity rule itself.

    The cap is applied before the shuffle of a long list, which leaves ``cap`` rows per category to rank.
    """
    inside = Window.partitionBy(query, category).orderBy(*order)
    kept = rows.withColumn("_place", F.row_number().over(inside)).filter(F.col("_place") <= cap).drop("_place")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*order)))


def dedup_first(lists: DataFrame, query: str, item: str, position: str) -> DataFrame:
    """Each item of a list once, at its first position. The rest of the first row comes with it."""
    rest = [c for c in lists.columns if c not in (query, item)]
    first = F.min_by(F.struct(*rest), F.col(position)).alias("first")
    return lists.groupBy(query, item).agg(first).select(query, item, *[F.col(f"first.{c}").alias(c) for c in rest])
