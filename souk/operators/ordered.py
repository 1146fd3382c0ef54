"""Running totals and exact quantiles over a globally ordered table, without a single-task sort.

Rows are range-partitioned on ``keys + order``, so a key that holds most of the data still spreads over
many partitions. Each partition is sorted and summed up in one pass and written; the sums of the partitions before
it (one row per partition and key) become its offset. The rows themselves are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.session import scratch_path


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **weights) -> DataFrame:
    """One row per key and distinct value, with aggregated weights; heavy values collapse before any sort."""
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return present.groupBy(*keys, value).agg(*[w.alias(name) for name, w in weights.items()])


class _Sums:
    """Running sums per key over the sorted batches of one partition."""

    def __init__(self, keys: list[str], totals: list[str]):
        self._keys, self._totals = keys, totals
        self._last, self._carry = None, {}

    def _groups(self, batch: pa.RecordBatch) -> np.ndarray:
        """Number of each row's key within the batch, from 0; nulls are a key."""
        new = np.zeros(batch.num_rows, bool)
        for key in self._keys:
            codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(new)

    def add(self, batch: pa.RecordBatch) -> list[pa.Array]:
        groups = self._groups(batch)
        first, last = (tuple(batch.column(k)[at].as_py() for k in self._keys) for at in (0, batch.num_rows - 1))
        goes_on = first == self._last
        runs = {}
        for name in self._totals:
            column = batch.column(name)
            kind = pa.int64() if pa.types.is_integer(column.type) else pa.float64()
            run = pd.Series(column.cast(kind).fill_null(0).to_numpy()).groupby(groups).cumsum().to_numpy()
            if goes_on:
                run = run + np.where(groups == 0, self._carry[name], 0).astype(run.dtype)
            runs[name] = run
        self._last, self._carry = last, {name: run[-1] for name, run in runs.items()}
        return [pa.array(run) for run in runs.values()]


def place(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Sequence[str] = ()) -> DataFrame:
    """``df`` range-partitioned, sorted and written, with its partition number in ``_part``.

    ``_run_<c>`` is the running sum of each total within the key and partition; nulls add nothing, whole numbers sum
    to bigint and others to double. Range bounds come from a sample, so the placement is fixed by writing it once.
    """
    keys, totals = list(keys), list(totals)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    kinds = {c: T.LongType() if isinstance(df.schema[c].dataType, whole) else T.DoubleType() for c in totals}
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), *[T.StructField(f"_run_{c}", k) for c, k in kinds.items()]])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = TaskContext.get().partitionId(), _Sums(keys, totals)
        for batch in batches:
            if batch.num_rows:
                columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), *sums.add(batch)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    path = scratch_path(df.sparkSession, "placed")
    df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).mapInArrow(number, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _offsets(placed: DataFrame, keys: list[str], totals: list[str]) -> DataFrame:
    """Per key and partition: the sums of the partitions before it, and over the whole key."""
    parts = placed.groupBy(*keys, "_part").agg(*[F.sum(c).alias(c) for c in totals])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    return parts.select(
        *keys, "_part", F.count(F.lit(1)).over(whole).alias("_parts"),
        *[F.col(c).alias(f"{c}_here") for c in totals],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in totals],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in totals],
    )


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Sequence[str], whole: bool = False) -> DataFrame:
    """Adds ``<c>_run`` (inclusive running sum) for each total ``c``; with ``whole`` also ``<c>_all`` (sum over the key).

    ``keys + order`` must identify a row; aggregate ties first, for instance with ``value_counts``. Null keys are a key.
    Only keys on several partitions need an offset. Neighbouring partitions share at most one key, so these are at
    most two rows per partition, whatever the number of keys, and may be broadcast.
    """
    keys, totals = list(keys), list(totals)
    placed = place(df, keys, order, totals)
    offsets = _offsets(placed, keys, totals)
    added = [c for t in totals for c in ((f"{t}_before", f"{t}_all") if whole else (f"{t}_before",))]
    offsets = offsets.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_part").alias("_of_part"), "_parts", *added)
    same = F.col("_part") == F.col("_of_part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    joined = placed.join(offsets if whole else F.broadcast(offsets.filter("_parts > 1")), same, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"_run_{c}") + F.coalesce(f"{c}_before", F.lit(0))).alias(f"{c}_run") for c in totals],
        *[F.col(f"{c}_all") for c in totals if whole],
    )


def quantiles_of(placed: DataFrame, keys: Sequence[str], value: str, count: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(keys, quantiles array)``.

    ``placed`` holds one row per key and distinct value with its ``count``, placed with that total. Partition sums
    tell which partitions hold a wanted rank; only those, at most two per quantile and key, are looked into.
    """
    keys = list(keys)
    n = F.col(f"{count}_all")

    def mark(i: int, p: float, side: int) -> Column:
        rank = (n - 1).cast("double") * F.lit(float(p))
        return F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), (F.ceil(rank) if side else F.floor(rank)).alias("rank"),
                        (rank - F.floor(rank)).alias("share"))

    marks = F.array(*[mark(i, p, side) for i, p in enumerate(probs) for side in (0, 1)])
    start, stop = F.col(f"{count}_before"), F.col(f"{count}_before") + F.col(f"{count}_here")
    holding = _offsets(placed, keys, [count]).select(
        *keys, "_part", start.alias("_start"),
        F.filter(marks, lambda m: (m["rank"] >= start) & (m["rank"] < stop)).alias("_marks"),
    ).filter(F.size("_marks") > 0)
    near = placed.filter(F.col(count) > 0).join(holding, [*keys, "_part"]).withColumn("_stop", F.col(f"_run_{count}") + F.col("_start"))
    first, last = F.col("_stop") - F.col(count), F.col("_stop")
    hits = near.select(
        *keys, F.col(value).cast("double").alias("_v"),
        F.inline(F.filter("_marks", lambda m: (m["rank"] >= first) & (m["rank"] < last))),
    )
    low, high = (F.max(F.when(F.col("side") == side, F.col("_v"))) for side in (0, 1))
    points = hits.groupBy(*keys, "i").agg((low + (high - low) * F.max("share")).alias("q"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "q")))
    return points.groupBy(*keys).agg(F.transform(ordered, lambda s: s["q"]).alias("quantiles"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    counts = value_counts(df, keys, value, n=F.count(F.lit(1)))
    return quantiles_of(place(counts, keys, [value], ["n"]), keys, value, "n", probs)


def global_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Adds the 1-based position of each row within its key, for keys of any size.

    ``keys + order`` must identify a row; order is ascending, so negate a score to rank it downwards.
    """
    placed = running_totals(df.withColumn("_one", F.lit(1)), keys, order, ["_one"])
    return placed.withColumn(name, F.col("_one_run")).drop("_one", "_one_run")
