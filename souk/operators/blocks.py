"""Pairwise work in bounded blocks: each task sees one block of each side and returns only its reduction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEFT_ROWS = 2048
RIGHT_ROWS = 8192


def _block_counts(left: DataFrame, right: DataFrame, keys: list[str], left_rows: int, right_rows: int) -> DataFrame:
    """Per key present on both sides, the number of blocks each side is cut into."""
    sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl")).join(
        right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr")), keys
    )
    return sizes.select(
        *keys, F.ceil(F.col("_nl") / left_rows).cast("int").alias("_lbs"), F.ceil(F.col("_nr") / right_rows).cast("int").alias("_rbs")
    )


def reduce_block_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    reduce: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    left_rows: int = LEFT_ROWS,
    right_rows: int = RIGHT_ROWS,
) -> DataFrame:
    """Apply ``reduce(left block, right block)`` to every pair of blocks within each key.

    Rows go to blocks by a hash of their id, so a hot key becomes many equal tasks. Every left row meets
    every right row of its key exactly once; pairs exist only inside a task and never as rows.
    """
    keys = list(keys)
    # fresh column identities, since both sides may come from the same table
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    if keys:
        counts = _block_counts(left, right, keys, left_rows, right_rows)
        left, right = left.join(counts, keys), right.join(counts, keys)
    else:
        left_blocks = max(1, -(-left.count() // left_rows))
        right_blocks = max(1, -(-right.count() // right_rows))
        left = left.withColumn("_lbs", F.lit(left_blocks)).withColumn("_rbs", F.lit(right_blocks))
        right = right.withColumn("_lbs", F.lit(left_blocks)).withColumn("_rbs", F.lit(right_blocks))
    left = left.withColumn("_lb", F.pmod(F.xxhash64(left_id), "_lbs").cast("int")).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0), F.col("_rbs") - 1))
    )
    right = right.withColumn("_rb", F.pmod(F.xxhash64(right_id), "_rbs").cast("int")).withColumn(
        "_lb", F.explode(F.sequence(F.lit(0), F.col("_lbs") - 1))
    )
    cells = [*keys, "_lb", "_rb"]
    return (
        left.drop("_lbs", "_rbs").groupBy(*cells)
        .cogroup(right.drop("_lbs", "_rbs").groupBy(*cells))
        .applyInArrow(reduce, schema)
    )
