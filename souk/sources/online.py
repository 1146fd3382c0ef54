"""Keyed online feature tables: bulk overwrite, idempotent increments, key lookups by prefix."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.session import scratch_path

TABLE = "key string, features map<string,string>"
FLUSH_ROWS = 1000  # fixed value: rows per flush of a partition writer


class KeyValueWriter(Protocol):
    """A connection to an online store, opened once per partition."""

    def put(self, rows: list[tuple[str, Mapping[str, str]]]) -> None: ...

    def close(self) -> None: ...


def online_rows(df: DataFrame, key, features) -> DataFrame:
    """``(key, features)`` rows, the layout of an online table."""
    return df.select(key.alias("key"), features.alias("features"))


def namespace(key: Column) -> Column:
    """The part of a key that a table is split by: ``fv:<view>:<entity>``, or the first two parts of other keys."""
    return F.when(key.startswith("fv:"), F.substring_index(key, ":", 3)).otherwise(F.substring_index(key, ":", 2))


def online_sink(rows: DataFrame, path: str) -> None:
    """Write ``(key, features)`` rows as a Parquet table with a folder per namespace, in one pass over their plan.

    Every namespace that ``rows`` hold is replaced and the others stay, so writing twice leaves one row per key.
    How many entities were written is a count of the table, which reads only file footers.
    """
    split = rows.select("key", "features", namespace(F.col("key")).alias("namespace"))
    split.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("namespace").parquet(path)


def online_upsert(rows: DataFrame, path: str) -> None:
    """Replace only the keys that ``rows`` hold; other keys of their namespaces keep their features.

    The new state is written to the shared scratch folder first, since a table can't be replaced while it is read.
    """
    spark = rows.sparkSession
    rows = rows.select("key", "features")
    spaces = rows.select(namespace(F.col("key")).alias("namespace")).distinct()
    kept = read_online(spark, path).join(spaces, "namespace", "left_semi").join(rows.select("key"), "key", "left_anti")
    state = scratch_path(spark, "upsert")
    kept.select("key", "features").unionByName(rows).write.parquet(state)
    online_sink(spark.read.schema(TABLE).parquet(state), path)


def partition_writer(rows: DataFrame, connect: Callable[[], KeyValueWriter], flush_rows: int = FLUSH_ROWS) -> None:
    """Push ``(key, features)`` rows to an external store: one connection per partition, batched puts.

    A put is a keyed overwrite, so a task that runs twice leaves the same state.
    """

    def write(partition: Iterable) -> None:
        store, pending = connect(), []
        try:
            for row in partition:
                pending.append((row["key"], row["features"]))
                if len(pending) >= flush_rows:
                    store.put(pending)
                    pending = []
            if pending:
                store.put(pending)
        finally:
            store.close()

    rows.foreachPartition(write)


def read_online(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{TABLE}, namespace string").parquet(path)


def under(table: DataFrame, prefix: str) -> DataFrame:
    """Rows whose key starts with ``prefix``; a stored table reads only the folders that may hold some."""
    rows = table.filter(F.col("key").startswith(prefix))
    if "namespace" not in table.columns:
        return rows
    space = F.col("namespace")
    return rows.filter(space.startswith(prefix) | F.lit(prefix).startswith(F.concat(space, F.lit(":"))))


def key_scan(table: DataFrame, prefix: str) -> DataFrame:
    """Keys that start with ``prefix``, with their last ``:`` part as the id."""
    return under(table, prefix).select("key", F.element_at(F.split("key", ":"), -1).alias("id"))


def drop_prefix(table: DataFrame, prefix: str) -> DataFrame:
    """The table without the keys that start with ``prefix``."""
    return table.filter(~F.col("key").startswith(prefix))


def write_increments(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink of ``(key, field, delta)`` rows; each batch owns and replaces its folder.

    A replayed micro-batch rewrites the same folder, so increments are never counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return write


def read_increments(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """Current counter values: the sum of the deltas per key and field over the batches after number ``after``."""
    return (
        spark.read.schema("key string, field string, delta bigint, batch_id bigint").parquet(path)
        .filter(F.col("batch_id") > after).groupBy("key", "field").agg(F.sum("delta").alias("value"))
    )


def with_increments(snapshot: DataFrame, increments: DataFrame) -> DataFrame:
    """The serving view ``(key, features)``: a snapshot plus what the stream counted since it was taken.

    ``increments`` are those after the last batch that the snapshot covers. Counters are added up, other fields stay,
    and keys of either side appear once. A key has one row per counter, so the map built from them is small.
    """
    counted = increments.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_more"))
    both = snapshot.select("key", "features").join(counted, "key", "full")
    empty = F.create_map().cast("map<string,string>"), F.create_map().cast("map<string,bigint>")
    total = F.map_zip_with(
        F.coalesce("features", empty[0]), F.coalesce("_more", empty[1]),
        lambda k, old, more: F.when(more.isNull(), old).otherwise((F.coalesce(old.try_cast("bigint"), F.lit(0)) + more).cast("string")),
    )
    return both.select("key", total.alias("features"))
