"""Streaming feature counters and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.scalars import entity_key, safe_ratio, valid_event

EVENT = "user_id string, event_type string, timestamp string"


def parse_events(raw: DataFrame, value: str = "value", schema: str = EVENT) -> DataFrame:
    """JSON payloads to columns. A malformed payload keeps its text and gets nulls."""
    return raw.withColumn("_e", F.from_json(value, schema, {"mode": "PERMISSIVE"})).select(*raw.columns, "_e.*")


def valid_events(parsed: DataFrame) -> DataFrame:
    """Rows that carry both a user and an event type."""
    return parsed.filter(valid_event(F.col("user_id"), F.col("event_type")))


def stream_user_counts(raw: DataFrame) -> DataFrame:
    """Running views, purchases and conversion rate per user, from a stream of JSON payloads.

    Other event types are ignored. State is one pair of counters per user, in Spark's state store.
    """
    events = valid_events(parse_events(raw)).filter(F.col("event_type").isin("view", "purchase"))
    counts = events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("user_view_count"),
        F.count_if(F.col("event_type") == "purchase").alias("user_purchase_count"),
    )
    return counts.withColumn("user_conversion_rate", safe_ratio(F.col("user_purchase_count"), F.col("user_view_count")))


def counter_deltas(raw: DataFrame) -> DataFrame:
    """Per micro-batch increments ``(key, field, delta)`` of the online counters.

    Works on the micro-batch a ``foreachBatch`` sink receives; events of a user are summed before writing.
    """
    events = valid_events(parse_events(raw))
    field = F.when(F.col("event_type") == "view", "user_view_count").when(
        F.col("event_type") == "purchase", "user_purchase_count"
    )
    counted = events.select(entity_key("user_aggregates", "user", F.col("user_id")).alias("key"), field.alias("field"))
    return counted.filter(F.col("field").isNotNull()).groupBy("key", "field").agg(F.count(F.lit(1)).alias("delta"))


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as a zoned timestamp, which watermarks require."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_window_counts(events: DataFrame, keys: tuple[str, ...] = ("event_type",), width: str = "24 hours",
                         slide: str | None = None, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Counts per key and event-time window; rows later than ``late`` behind the watermark are left out."""
    slot = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = with_event_time(events, ts).withWatermark(ts, late).groupBy(slot, *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")


def stream_window_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], within: str = "1 hour",
                       late: str = "10 minutes", left_ts: str = "left_ts", right_ts: str = "right_ts") -> DataFrame:
    """Pairs of equal keys whose right row follows its left row within an interval.

    Watermarks on both sides let Spark drop state that can no longer match.
    """
    a = with_event_time(left, left_ts).withWatermark(left_ts, late).alias("a")
    b = with_event_time(right, right_ts).withWatermark(right_ts, late).alias("b")
    near = F.expr(f"b.{right_ts} >= a.{left_ts} AND b.{right_ts} <= a.{left_ts} + INTERVAL {within}")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    condition = near
    for equal in same:
        condition = condition & equal
    rest = [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return a.join(b, condition, "inner").select("a.*", *rest)
