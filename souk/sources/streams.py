"""Streaming readers and the trigger used to drain what is available."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from souk.session import scratch_path
from souk.sources.files import StreamSource


def stream_source(spark: SparkSession, source: StreamSource, schema: T.StructType | None = None) -> DataFrame:
    """A streaming DataFrame: Kafka values as text, or files of a folder."""
    if source.type == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source.bootstrap_servers)
            .option("subscribe", source.topic)
            .options(**source.options)
            .load()
        )
        return raw.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format(source.type).options(**source.options)
    if source.type != "text":
        if schema is None:
            raise ValueError("a file stream needs an explicit schema")
        reader = reader.schema(schema)
    return reader.load(source.path)


def table_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """A stored table ``<folder>/<table>.parquet`` (one file or a folder of files) as a stream."""
    path = f"{folder}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{table}.parquet*")


def drain(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    output_mode: str = "update",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Run a stream over everything available now, handing each micro-batch to ``write_batch``."""
    query = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drain_whole(rows: DataFrame, operator: Callable[[DataFrame], DataFrame], last: DataFrame, name: str) -> DataFrame:
    """What ``operator`` appends for all of a finite stream, the rows that wait for the watermark too.

    Once everything available is through, the stream goes on from its checkpoint with one more file, which holds ``last``: rows
    whose only part is to move the watermark past all others. They wait in the state for ever and are not in the result.
    """
    spark = rows.sparkSession
    end, path, progress = (scratch_path(spark, name + part) for part in ("-end", "", "-progress"))
    last.limit(0).write.parquet(end)
    stream = operator(rows.unionByName(spark.readStream.schema(last.schema).parquet(end)))
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", progress).trigger(availableNow=True)
    writer.start().awaitTermination()
    last.write.mode("append").parquet(end)
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def drain_to_table(stream: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a stream over everything available now into a Parquet table, and read that table back."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    if output_mode == "append":
        query = (
            stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", scratch_path(spark, name + "-progress"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    else:
        # every micro-batch replaces its own folder, so a replayed batch changes nothing
        drain(stream, lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"),
              output_mode)
    return spark.read.schema(stream.schema).parquet(path)
