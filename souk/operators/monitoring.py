"""Request metrics: counts, latency histograms, exact tail latency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.ordered import exact_quantiles

# Bucket bounds and the endpoint that is not measured.
MILLISECOND_BUCKETS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)
SECOND_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
UNMEASURED = "/metrics"


def _measured(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("endpoint") != UNMEASURED)


def red_metrics(requests: DataFrame) -> DataFrame:
    """Requests by method, endpoint and status."""
    return _measured(requests).groupBy("method", "endpoint", "http_status").agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(requests: DataFrame, keys: Sequence[str] = ("endpoint",), latency: str = "latency",
                      buckets: Sequence[float] = MILLISECOND_BUCKETS) -> DataFrame:
    """Cumulative buckets per key: ``(keys, le, requests, total_latency, total_requests)``, the last ``le`` is +Inf."""
    value = F.col(latency)
    wide = _measured(requests).groupBy(*keys).agg(
        *[F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(buckets)],
        F.sum(value).alias("total_latency"), F.count(value).alias("total_requests"),
    )
    lines = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("requests")) for i, b in enumerate(buckets)]
    lines.append(F.struct(F.lit("+Inf").alias("le"), F.col("total_requests").alias("requests")))
    return wide.select(*keys, F.inline(F.array(*lines)), "total_latency", "total_requests")


def latency_quantiles(requests: DataFrame, probs: Sequence[float] = (0.99,), keys: Sequence[str] = ("endpoint",),
                      latency: str = "latency") -> DataFrame:
    """Exact latency quantiles per key: ``(keys, quantiles)``; a hot endpoint spreads over many tasks."""
    return exact_quantiles(_measured(requests), keys, latency, probs)


def latency_p99(requests: DataFrame, keys: Sequence[str] = ("endpoint",), latency: str = "latency") -> DataFrame:
    return latency_quantiles(requests, (0.99,), keys, latency).select(*keys, F.col("quantiles")[0].alias("p99"))
