"""Batch readers and writers, and the source descriptors feature views name."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schema of the interaction log. Prices and categories are absent from the live stream, hence nullable.
INTERACTIONS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


@dataclass(frozen=True)
class BatchSource:
    """Where a batch feature view reads from."""

    type: str = "parquet"
    path: str | None = None
    connection_string: str | None = None
    table_name: str | None = None
    timestamp_field: str = "timestamp"
    options: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class StreamSource:
    """Where a streaming feature view reads from; ``path`` serves the file-based types."""

    topic: str = ""
    type: str = "kafka"
    bootstrap_servers: str = "localhost:9092"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict, hash=False)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a given schema replaces footer inference."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line."""
    df.write.mode(mode).json(path)


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_event_log(events: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    """The event log in one folder per day.

    Rows are rebalanced by day before writing: small days share a task, and a very large day is split, so
    files come out at a useful size either way.
    """
    dated = events.withColumn("event_date", F.to_date(ts))
    dated.hint("rebalance", "event_date").write.mode(mode).partitionBy("event_date").parquet(path)


def read_event_log(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Days ``first`` to ``last`` of an event log; other folders are not opened."""
    log = spark.read.parquet(path)
    if first is not None:
        log = log.filter(F.col("event_date") >= F.lit(first))
    if last is not None:
        log = log.filter(F.col("event_date") <= F.lit(last))
    return log


def resolve_source(spark: SparkSession, source: BatchSource, schema: T.StructType | None = None) -> DataFrame:
    """The DataFrame behind a batch source.

    A database source reads in parallel when its options name ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``; without them Spark reads through a single connection.
    """
    if source.type in ("jdbc", "postgres"):
        if not (source.connection_string and source.table_name):
            raise ValueError("a database source needs connection_string and table_name")
        url = source.connection_string
        url = url if url.startswith("jdbc:") else f"jdbc:{url}"
        return (
            spark.read.format("jdbc").option("url", url).option("dbtable", source.table_name)
            .options(**source.options).load()
        )
    if source.type == "table":
        return spark.read.table(source.table_name)
    if not source.path:
        raise ValueError(f"a {source.type} source needs a path")
    reader = spark.read.format(source.type).options(**source.options)
    return (reader.schema(schema) if schema is not None else reader).load(source.path)
