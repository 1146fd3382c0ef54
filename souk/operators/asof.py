"""Point-in-time join: the latest feature row at or before each label."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def wall_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp with or without zone."""
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def pit_join(
    labels: DataFrame,
    features: DataFrame,
    key: str,
    label_ts: str,
    feature_ts: str,
    values: Sequence[str],
    tiebreak: str,
    ttl: timedelta | None = None,
    slot: timedelta = timedelta(minutes=10),
) -> DataFrame:
    """``labels`` plus, per row, ``matched_ts`` and ``values`` of its key's latest feature row.

    Feature rows at the label's own time count; a match older than ``ttl`` is dropped to nulls; equal
    feature times are decided by the largest ``tiebreak``.

    Time is cut into slots. Inside a (key, slot) a window finds the latest row; a label whose slot holds
    no earlier feature takes the last feature of the nearest earlier slot of its key. So the largest sort
    holds one slot of one key, and the scan across slots sees one row per slot.
    """
    width = int(slot.total_seconds())
    match = F.struct(F.col(feature_ts).alias("ts"), F.col(tiebreak).alias("tie"), *[F.col(v).alias(v) for v in values])
    right = features.filter(F.col(key).isNotNull() & F.col(feature_ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(feature_ts).alias("_ts"), F.lit(0).alias("_side"), match.alias("_match")
    )
    left = labels.select(
        F.col(key).alias("_key"), F.col(label_ts).alias("_ts"), F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in labels.columns]).alias("_label"),
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn(
        "_slot", F.floor(wall_seconds(F.col("_ts")) / width)
    )
    inside = Window.partitionBy("_key", "_slot").orderBy("_ts", "_side", F.col("_match.tie")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    found = both.withColumn("_here", F.last("_match", ignorenulls=True).over(inside)).filter(F.col("_side") == 1)

    per_slot = both.groupBy("_key", "_slot").agg(
        F.max_by("_match", F.struct(F.col("_match.ts"), F.col("_match.tie"))).alias("_last")
    )
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slot.select("_key", "_slot", F.last("_last", ignorenulls=True).over(before).alias("_carry"))

    joined = found.join(carried, ["_key", "_slot"], "left").withColumn("_hit", F.coalesce("_here", "_carry"))
    fresh = F.col("_hit.ts").isNotNull()
    if ttl is not None:
        fresh = fresh & (F.col("_hit.ts") >= F.col("_ts") - F.expr(f"INTERVAL {int(ttl.total_seconds())} SECONDS"))
    return joined.select(
        *[F.col(f"_label.{c}").alias(c) for c in labels.columns],
        F.when(fresh, F.col("_hit.ts")).alias("matched_ts"),
        *[F.when(fresh, F.col(f"_hit.{v}")).alias(v) for v in values],
    )
