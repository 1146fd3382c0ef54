"""Append-only table of training-run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_METRICS = "experiment string, run_id string, metric string, value double, step int"
RUN_PARAMS = "experiment string, run_id string, param string, value string"


def append_metrics(rows: DataFrame, path: str) -> None:
    """Add ``(experiment, run_id, metric, value, step)`` rows."""
    rows.select(
        F.col("experiment").cast("string"), F.col("run_id").cast("string"), F.col("metric").cast("string"),
        F.col("value").cast("double"), F.col("step").cast("int"),
    ).write.mode("append").parquet(path)


def append_params(rows: DataFrame, path: str) -> None:
    rows.select(*[F.col(c).cast("string") for c in ("experiment", "run_id", "param", "value")]).write.mode(
        "append"
    ).parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_METRICS).parquet(path)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_PARAMS).parquet(path)


def best_run(metrics: DataFrame, metric: str) -> DataFrame:
    """Per experiment, the run whose last logged value of ``metric`` is highest; ties go to the smaller id."""
    last = metrics.filter((F.col("metric") == metric) & F.col("value").isNotNull() & ~F.isnan("value")).groupBy(
        "experiment", "run_id"
    ).agg(F.max_by("value", "step").alias("value"))
    top = last.groupBy("experiment").agg(F.min_by(F.struct("run_id", "value"), F.struct(-F.col("value"), "run_id")).alias("best"))
    return top.select("experiment", "best.run_id", F.col("best.value").alias("value"))
