"""Batch forms of the two serving requests: recommend and search, for all users in one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.lookups import user_item_features
from souk.operators.ranking import rank_rows, score_ctr, score_ltr
from souk.operators.retrieval import knn_cosine

# Accepted request sizes.
RECOMMEND_DEFAULT, RECOMMEND_MAX = 20, 100
SEARCH_DEFAULT, SEARCH_MAX = 10, 50


def _check(k: int, largest: int) -> None:
    if not 1 <= k <= largest:
        raise ValueError(f"k must be between 1 and {largest}, got {k}")


def _candidates(user_vectors: DataFrame, item_vectors: DataFrame, k: int, nearest: Callable[..., DataFrame]) -> DataFrame:
    found = nearest(user_vectors, item_vectors, k, query_id="user_id")
    return found.select(F.col("query_id").alias("user_id"), "item_id", F.col("score").alias("similarity"))


def batch_recommend(user_vectors: DataFrame, item_vectors: DataFrame, users: DataFrame, items: DataFrame,
                    k: int = RECOMMEND_DEFAULT, score: Callable[[DataFrame], DataFrame] = score_ctr,
                    nearest: Callable[..., DataFrame] = knn_cosine) -> DataFrame:
    """``(user_id, rank, item_id, ctr, cvr)``: the k nearest items of every user, ordered by click probability.

    ``score`` adds ``ctr`` and ``cvr``, for instance one that ``models.fit_ctr_cvr`` returns. ``nearest`` finds the
    candidates: exactly, which compares all users with all items, or for large catalogues ``knn_lists``.
    """
    _check(k, RECOMMEND_MAX)
    candidates = user_item_features(_candidates(user_vectors, item_vectors, k, nearest), users, items)
    return rank_rows(score(candidates), "ctr", bounded=True).select("user_id", "rank", "item_id", "ctr", "cvr")


def batch_search(user_vectors: DataFrame, item_vectors: DataFrame, users: DataFrame, items: DataFrame,
                 k: int = SEARCH_DEFAULT, score: Callable[[DataFrame], DataFrame] = score_ltr,
                 nearest: Callable[..., DataFrame] = knn_cosine) -> DataFrame:
    """``(user_id, rank, item_id, ltr_score)``: 2k nearest items rescored, best k kept. The query text plays no part.

    ``score`` adds ``ltr_score``; see ``batch_recommend`` for it and ``nearest``.
    """
    _check(k, SEARCH_MAX)
    candidates = user_item_features(_candidates(user_vectors, item_vectors, 2 * k, nearest), users, items)
    return rank_rows(score(candidates), "ltr_score", bounded=True).filter(F.col("rank") <= k).select("user_id", "rank", "item_id", "ltr_score")


def as_response(ranked: DataFrame, *fields: str) -> DataFrame:
    """One row per user with the ranked fields as arrays, the shape of a response body."""
    rows = F.sort_array(F.collect_list(F.struct("rank", *fields)))
    return ranked.groupBy("user_id").agg(rows.alias("r")).select("user_id", *[F.col(f"r.{f}").alias(f) for f in fields])
