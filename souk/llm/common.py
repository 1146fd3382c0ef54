"""Helpers shared by the text operators: reading tables, batch maps and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.session import cut_lineage, scratch_path

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release() -> None:
    """Give back to the system what a finished task no longer uses; a reused worker would keep it beside the next task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` that ends with ``release``."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """Apply a function to Arrow batches; ``start`` runs once per task and returns it, so it may hold state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            step = step or start()
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(released(run), schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later readers recompute nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id on an edge: the smallest id it can reach.

    Rounds of hooking and pointer jumping: every id adopts the smallest label among its neighbours and itself,
    then follows that label's own label. A label halves its distance to the root each round, so the number of
    rounds grows with the logarithm of the longest path. Each round is written by ``checkpoint()``, and the
    driver sees one count. Hot ids cost one row per edge; their labels are pre-aggregated by ``min``.
    """
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct()
    both = cut_lineage(pairs.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))))
    labels = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("label").alias("near")
        )
        # the smallest label heard for an id is offered to the id's present root as well
        told = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("near"))
        roots = told.groupBy(F.col("label").alias("id")).agg(F.min("near").alias("root"))
        hooked = told.select("id", "label", "near").join(roots, "id", "left").select(
            "id", "label", F.least("near", F.coalesce("root", "near")).alias("new")
        )
        jump = hooked.select(F.col("id").alias("new"), F.col("new").alias("far"))
        moved = cut_lineage(hooked.join(jump, "new").select("id", F.col("label").alias("old"), F.least("new", "far").alias("label")))
        labels = moved.select("id", "label")
        if moved.filter("label <> old").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
