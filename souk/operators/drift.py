"""Distribution drift: population stability index and the Kolmogorov-Smirnov statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.operators.ordered import place, quantiles_of, running_totals, value_counts

# Bins, widening of the outer edges, smallest share, and the retraining threshold.
PSI_BINS = 10
EDGE_MARGIN = 0.0001
SHARE_FLOOR = 0.0001
RETRAIN_AT = 0.2
KS_TERMS, KS_FLOOR = 50, 0.2


def melt(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per input row and column: ``(keep, column_name, value)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(pairs))


def psi(df: DataFrame, is_expected: str, columns: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """Stability index of each column between baseline rows (``is_expected``) and recent rows.

    Edges are the baseline's exact quantiles. Recent values beyond the widened outer edges are in no bin
    but stay in the denominator. The edges that are broadcast are ``bins + 1`` numbers per column.
    """
    flag = F.col(is_expected)
    counts = value_counts(
        melt(df, [is_expected], columns), ["column_name"], "value",
        expected=F.count_if(flag), actual=F.count_if(~flag),
    )
    placed = place(counts, ["column_name"], ["value"], ["expected"])
    probs = [i / bins for i in range(bins + 1)]
    edges = quantiles_of(placed, ["column_name"], "value", "expected", probs)
    margin = F.lit(EDGE_MARGIN)
    widened = edges.select(
        "column_name",
        F.transform(
            "quantiles", lambda e, i: F.when(i == 0, e - margin).when(i == bins, e + margin).otherwise(e)
        ).alias("edges"),
    )
    value = F.col("value")
    slot = sum(((F.col("edges")[i] <= value).cast("int") for i in range(bins + 1)), F.lit(-1))
    inside = (slot >= 0) & (value <= F.element_at("edges", -1))
    binned = (
        placed.join(F.broadcast(widened), "column_name")
        .withColumn("bin", F.when(inside, F.least(slot, F.lit(bins - 1))))
        .groupBy("column_name", "bin").agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
    )
    per_column = binned.groupBy("column_name").agg(
        F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("expected", "actual"))).alias("counts"),
        F.sum("expected").alias("n_expected"), F.sum("actual").alias("n_actual"),
    )

    def share(part: Column, whole: str) -> Column:
        return F.least(F.greatest(part / F.nullif(F.col(whole), F.lit(0)), F.lit(SHARE_FLOOR)), F.lit(1.0))

    def term(counts: Column) -> Column:
        e, a = share(counts["expected"], "n_expected"), share(counts["actual"], "n_actual")
        return (a - e) * F.ln(a / e)

    # an empty bin on both sides would contribute zero, so absent bins need no rows
    total = F.aggregate("counts", F.lit(0.0), lambda s, c: s + term(c))
    return per_column.select("column_name", total.alias("psi")).withColumn("retrain", F.col("psi") >= RETRAIN_AT)


def ks_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Kolmogorov's limit for the chance of at least this distance between samples of one distribution."""
    size = n.cast("double") * m.cast("double") / (n.cast("double") + m.cast("double"))
    scaled = distance * F.sqrt(size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    # below the floor the chance is 1 to eleven digits, and the series would need ever more terms
    return F.when(scaled < KS_FLOOR, 1.0).when(scaled.isNotNull(), F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(df: DataFrame, is_expected: str, value: str) -> DataFrame:
    """Largest distance between the two empirical distributions, its asymptotic p-value, and both sample sizes."""
    flag = F.col(is_expected)
    counts = value_counts(df, [], value, expected=F.count_if(flag), actual=F.count_if(~flag))
    running = running_totals(counts, [], [value], ["expected", "actual"], whole=True)
    gap = F.abs(
        F.col("expected_run") / F.nullif(F.col("expected_all"), F.lit(0))
        - F.col("actual_run") / F.nullif(F.col("actual_all"), F.lit(0))
    )
    found = running.agg(
        F.max(gap).alias("ks_statistic"), F.max("expected_all").alias("n_expected"), F.max("actual_all").alias("n_actual")
    )
    return found.withColumn("p_value", ks_p_value(F.col("ks_statistic"), F.col("n_expected"), F.col("n_actual")))
