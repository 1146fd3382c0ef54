"""Model evaluation over scored tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.operators.blocks import LEFT_ROWS, RIGHT_ROWS, reduce_block_pairs
from souk.operators.ordered import running_totals, value_counts

# Fixed values.
MAPE_OFFSET = 1e-5
TEMPERATURE = 0.07
CVR_LOSS_WEIGHT = 0.5
LOG_FLOOR = -100.0


def forecast_error(df: DataFrame, actual: str = "y", predicted: str = "y_hat", keys: Sequence[str] = ()) -> DataFrame:
    """Mean squared error and mean absolute percentage error."""
    miss = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(
        F.avg(miss * miss).alias("mse"),
        (F.avg(F.abs(miss / F.nullif(F.col(actual) + MAPE_OFFSET, F.lit(0.0)))) * 100).alias("mape"),
    )


def _safe_log(p: Column) -> Column:
    """Logarithm limited from below, so that a certain but wrong prediction has a finite loss."""
    return F.when(p > 0, F.greatest(F.ln(p), F.lit(LOG_FLOOR))).otherwise(F.lit(LOG_FLOOR))


def _cross_entropy(label: Column, probability: Column) -> Column:
    return -(label * _safe_log(probability) + (F.lit(1.0) - label) * _safe_log(F.lit(1.0) - probability))


def bce_joint_loss(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Cross-entropy of the click and the conversion head, and their weighted sum."""
    losses = df.groupBy(*keys).agg(
        F.avg(_cross_entropy(F.col("ctr_label"), F.col("ctr_pred"))).alias("ctr_loss"),
        F.avg(_cross_entropy(F.col("cvr_label"), F.col("cvr_pred"))).alias("cvr_loss"),
    )
    return losses.withColumn("joint_loss", F.col("ctr_loss") + F.col("cvr_loss") * CVR_LOSS_WEIGHT)


def info_nce(pairs: DataFrame, batch: str = "batch_id", row_id: str = "pair_id", user_vec: str = "user_vec",
             item_vec: str = "item_vec", temperature: float = TEMPERATURE,
             left_rows: int = LEFT_ROWS, right_rows: int = RIGHT_ROWS) -> DataFrame:
    """Mean in-batch contrastive loss per batch: each user's own item against all items of the batch.

    Blocks of users meet blocks of items; a task returns one (maximum, scaled sum) per user, and those are
    merged with a shift by the largest maximum.
    """
    users = pairs.select(batch, F.col(row_id).alias("pair_id"), F.col(user_vec).alias("vec"))
    items = pairs.select(batch, F.col(row_id).alias("pair_id"), F.col(item_vec).alias("vec"))

    def reduce(left: pa.Table, right: pa.Table) -> pa.Table:
        peak, total = np.empty(0), np.empty(0)
        if left.num_rows and right.num_rows:
            u, v = (np.stack(t["vec"].combine_chunks().to_numpy(zero_copy_only=False)).astype(float) for t in (left, right))
            scores = u @ v.T / temperature
            peak = scores.max(axis=1)
            total = np.exp(scores - peak[:, None]).sum(axis=1)
        kept = left.slice(0, len(peak))
        return pa.table({batch: kept[batch], "pair_id": kept["pair_id"], "peak": pa.array(peak), "total": pa.array(total)})

    types = {f.name: f.dataType.simpleString() for f in users.schema}
    partial = reduce_block_pairs(
        users, items, [batch], "pair_id", "pair_id", reduce,
        f"{batch} {types[batch]}, pair_id {types['pair_id']}, peak double, total double", left_rows, right_rows,
    )
    parts = partial.groupBy(batch, "pair_id").agg(F.collect_list(F.struct("peak", "total")).alias("parts"))
    top = F.array_max(F.transform("parts", lambda p: p["peak"]))
    spread = F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["total"] * F.exp(p["peak"] - F.col("top")))
    merged = parts.withColumn("top", top).select(batch, "pair_id", (F.col("top") + F.ln(spread)).alias("log_total"))
    own = F.aggregate(
        F.zip_with(user_vec, item_vec, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, x: s + x
    ) / temperature
    scored = merged.join(pairs.select(batch, F.col(row_id).alias("pair_id"), own.alias("own")), [batch, "pair_id"])
    return scored.groupBy(batch).agg(
        F.count(F.lit(1)).alias("pairs"), F.avg(F.col("log_total") - F.col("own")).alias("info_nce")
    )


def auc(df: DataFrame, score: str = "score", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per key; equal scores count half. Null when a class is missing."""
    keys = list(keys)
    counts = value_counts(
        df, keys, score, pos=F.count_if(F.col(label) == 1), neg=F.count_if(F.col(label) == 0)
    )
    running = running_totals(counts, keys, [score], ["pos", "neg"])
    below = F.col("neg_run") - F.col("neg")
    won = F.col("pos") * (below + F.col("neg") / 2)
    sums = running.groupBy(*keys).agg(
        F.sum(won.cast("double")).alias("won"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    area = F.col("won") / F.nullif(F.col("n_pos").cast("double") * F.col("n_neg"), F.lit(0.0))
    return sums.select(*keys, area.alias("auc"), "n_pos", "n_neg")


def champion_challenger(scored: DataFrame, champion: str, challenger: str, model: str = "model") -> DataFrame:
    """Promote the challenger iff its AUC on the same labels is strictly higher."""
    areas = auc(scored.filter(F.col(model).isin(champion, challenger)), keys=[model])
    row = areas.agg(
        F.max(F.when(F.col(model) == champion, F.col("auc"))).alias("champion_auc"),
        F.max(F.when(F.col(model) == challenger, F.col("auc"))).alias("challenger_auc"),
    )
    return row.withColumn("promote", F.coalesce(F.col("challenger_auc") > F.col("champion_auc"), F.lit(False)))


def ranking_metrics(ranked: DataFrame, truth: DataFrame, k: int, query: str = "query_id", item: str = "item_id",
                    grade: str = "relevance") -> DataFrame:
    """Mean recall@k and graded NDCG@k over the queries that have relevant items.

    ``ranked`` holds ``(query, item, rank)`` with rank from 1; ``truth`` holds one grade per (query, item).
    The ideal order needs only the k best grades of a query, which the rank filter trims before shuffling.
    """
    relevant = truth.filter(F.col(grade) > 0)
    shown = ranked.filter(F.col("rank") <= k).select(query, item, "rank")

    def gain(rank: Column) -> Column:
        return (F.pow(F.lit(2.0), F.col(grade)) - 1) / F.log2(rank + 1)

    got = shown.join(relevant, [query, item]).groupBy(query).agg(
        F.sum(gain(F.col("rank"))).alias("dcg"), F.count(F.lit(1)).alias("hits")
    )
    best_first = Window.partitionBy(query).orderBy(F.desc(grade), F.asc(item))
    ideal = (
        relevant.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= k)
        .groupBy(query).agg(F.sum(gain(F.col("place"))).alias("idcg"))
    )
    sizes = relevant.groupBy(query).agg(F.count(F.lit(1)).alias("n_relevant"))
    per_query = sizes.join(ideal, query).join(got, query, "left").na.fill({"dcg": 0.0, "hits": 0})
    return per_query.agg(
        F.count(F.lit(1)).alias("queries"),
        F.avg(F.col("hits") / F.col("n_relevant")).alias("recall"),
        F.avg(F.col("dcg") / F.col("idcg")).alias("ndcg"),
    )
