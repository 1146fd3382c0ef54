"""Team-draft interleaving of two ranked lists per request, and click credit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.scalars import md5_int

MODEL_A, MODEL_B = "model_A", "model_B"  # fixed values: credit labels


def ranked_list(rows: DataFrame, request: str, item: str, position: str, name: str) -> DataFrame:
    """One array per request, in position order, without null or empty items. Lists are top-k sized."""
    kept = rows.filter(F.col(item).isNotNull() & (F.col(item).cast("string") != ""))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col(item).alias("i"))))
    return kept.groupBy(request).agg(F.transform(ordered, lambda s: s["i"]).alias(name))


def _drawn_from_a(request: Column, steps: Column, n_a: Column, n_b: Column) -> Column:
    """After each step, how many items have been taken from A.

    The coin of a step is a hash bit. A's share is the number of A coins so far, limited by what A has
    and by what B can supply for the remaining steps, which covers the case of a list running out.
    """
    coins = F.transform(
        steps, lambda s: F.pmod(md5_int(F.concat_ws("-", request.cast("string"), s.cast("string"))), F.lit(2))
    )
    so_far = F.aggregate(
        coins, F.array().cast("array<int>"),
        lambda sums, coin: F.concat(sums, F.array((F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0)) + coin).cast("int"))),
    )
    return F.zip_with(steps, so_far, lambda s, heads: F.greatest(F.least(heads, n_a), s - n_b))


def team_draft_interleave(list_a: DataFrame, list_b: DataFrame, request: str = "request_id", max_size: int = 10) -> DataFrame:
    """``(request, rank, item_id, model)`` of the blended list.

    Every step takes the head of the list its coin names, or of the other one when that is exhausted; an
    item already shown uses up its step. Inputs hold one array column per request: ``list_a``, ``list_b``.
    """
    both = list_a.join(list_b, request, "full")
    empty = F.array().cast(list_a.schema["list_a"].dataType)
    both = both.select(
        request, F.coalesce("list_a", empty).alias("a"), F.coalesce("list_b", empty).alias("b")
    ).withColumn("n", F.size("a") + F.size("b")).filter(F.col("n") > 0)
    steps = F.sequence(F.lit(1), F.col("n"))
    drawn = both.withColumn("taken", _drawn_from_a(F.col(request), steps, F.size("a"), F.size("b")))

    def step(taken: Column, i: Column) -> Column:
        before = F.coalesce(F.try_element_at(F.col("taken"), F.when(i > 0, i)), F.lit(0))
        from_a = taken > before
        return F.struct(
            F.when(from_a, F.try_element_at(F.col("a"), F.greatest(taken, F.lit(1))))
            .otherwise(F.try_element_at(F.col("b"), F.greatest(i + 1 - taken, F.lit(1)))).alias("item_id"),
            F.when(from_a, F.lit(MODEL_A)).otherwise(F.lit(MODEL_B)).alias("model"),
        )

    shown = drawn.withColumn("draft", F.transform("taken", step))
    items = F.transform("draft", lambda s: s["item_id"])
    feed = F.slice(F.array_distinct(items), 1, max_size)
    credit = F.transform(feed, lambda x: F.element_at(F.col("draft"), F.array_position(items, x).cast("int")))
    return shown.select(request, F.posexplode(credit).alias("pos", "s")).select(
        request, (F.col("pos") + 1).alias("rank"), F.col("s.item_id").alias("item_id"), F.col("s.model").alias("model")
    )


def click_attribution(clicks: DataFrame, assignment: DataFrame, request: str = "request_id", item: str = "item_id") -> DataFrame:
    """Clicks credited to the model that supplied the item, per model.

    Clicks are counted per (request, item) before the join, so a heavily clicked item is one row.
    """
    counted = clicks.groupBy(request, item).agg(F.count(F.lit(1)).alias("clicks"))
    credited = counted.join(assignment.select(request, item, "model"), [request, item])
    return credited.groupBy("model").agg(
        F.sum("clicks").alias("clicks"), F.count(F.lit(1)).alias("clicked_items")
    )
