"""Entity aggregates of the interaction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.scalars import safe_ratio


def user_behavior_aggregates(events: DataFrame) -> DataFrame:
    """Per user: views, purchases and conversion rate. Reads two columns; one partial + final aggregation."""
    counts = events.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("user_view_count"),
        F.count_if(F.col("event_type") == "purchase").alias("user_purchase_count"),
    )
    return counts.withColumn(
        "user_conversion_rate", safe_ratio(F.col("user_purchase_count"), F.col("user_view_count"))
    )


def item_aggregates(events: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Per item: category and price of its first event in ``order``, and its number of views."""
    first = F.min_by(F.struct("category", "price"), F.struct(*order))
    return (
        events.filter(F.col("item_id").isNotNull()).groupBy("item_id")
        .agg(first.alias("first"), F.count_if(F.col("event_type") == "view").alias("popularity"))
        .select("item_id", "first.category", F.col("first.price").alias("base_price"), "popularity")
    )


def entity_counts(events: DataFrame, *entities: str, relative_error: float | None = None) -> DataFrame:
    """Distinct ids per entity column: exact, or by sketch when an error is allowed.

    Each exact count is its own two-step aggregation: ids are reduced per task, then counted per partition.
    """
    if relative_error is not None:
        return events.agg(*[F.approx_count_distinct(e, relative_error).alias(f"n_{e}") for e in entities])
    totals = [events.select(e).na.drop().distinct().agg(F.count(F.lit(1)).alias("n")) for e in entities]
    head = totals[0].withColumnRenamed("n", f"n_{entities[0]}")
    return head.select("*", *[t.scalar().alias(f"n_{e}") for e, t in zip(entities[1:], totals[1:])])


def query_group_sizes(events: DataFrame, query: str = "user_id") -> DataFrame:
    """Rows per query, in query order."""
    return events.groupBy(query).agg(F.count(F.lit(1)).alias("group_size")).orderBy(query)


def sort_by_query(events: DataFrame, query: str = "user_id", *within: str) -> DataFrame:
    """The log in query order. Range-partitioned on all columns, so one long query spans many tasks."""
    return events.orderBy(query, *within)


def hier_rollup(df: DataFrame, levels: tuple[str, ...], **measures) -> DataFrame:
    """Totals at every prefix of a hierarchy; ``level`` counts the levels rolled up."""
    depth = sum((F.grouping(c).cast("int") for c in levels), F.lit(0))
    return df.rollup(*levels).agg(depth.alias("level"), *[m.alias(name) for name, m in measures.items()])


def lambda_merge(snapshot: DataFrame, increments: DataFrame, key: str = "user_id") -> DataFrame:
    """Batch totals plus later increments per key, with the rate recomputed from the merged counts.

    The snapshot must hold events up to a cutoff and the increments only events after it.
    """
    counters = ("user_view_count", "user_purchase_count")
    both = snapshot.select(key, *counters).unionByName(increments.select(key, *counters))
    merged = both.groupBy(key).agg(*[F.sum(c).alias(c) for c in counters])
    return merged.withColumn("user_conversion_rate", safe_ratio(F.col(counters[1]), F.col(counters[0])))
