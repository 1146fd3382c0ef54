"""User and item vectors from the in-batch contrastive loss, by block-wise stochastic gradient descent.

Users and items are dealt into equal numbers of blocks by a hash of their id. In one turn each user block meets one item
block, no block twice, so updates of one turn touch disjoint vectors; after as many turns as there are blocks every pair has been
seen once, and a hot user or item has at most one pair per id of the other block. A user block meets item blocks in rising and
an item block meets user blocks in falling order, so a task may hold a group of neighbouring blocks of each side and make all
turns between them: groups are written and dealt anew once per pair of groups, not once per turn, with the same vectors in the
end. The number of groups grows with ids and pairs, so a task is bounded; vectors of past rounds are deleted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.vectors import l2_normalize
from souk.operators.evaluation import TEMPERATURE
from souk.session import drop_path, scratch_path, shuffles_dropped

#: Ids of a block, fewest blocks, and pairs of a batch, whose items are each other's negatives.
BLOCK_ROWS, LEAST_BLOCKS, BATCH = 4096, 2, 256
RATE, EPOCHS = 0.2, 6
#: Blocks of a group at most, and pairs that a task sees at a time, on average.
GROUP_BLOCKS, TASK_PAIRS = 16, 1 << 20


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit("block")), F.lit(blocks)).cast("int")


def first_vectors(ids: DataFrame, key: str, dim: int, seed: int) -> DataFrame:
    """``(key, vec)``: unit vectors that depend on the id and the seed alone."""
    spread = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: F.xxhash64(F.col(key), F.lit(seed), i).cast("double") / float(1 << 63))
    return ids.select(key, l2_normalize(spread).alias("vec"))


def gradients(u: np.ndarray, v: np.ndarray, items: np.ndarray, weight: np.ndarray, temperature: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss of a batch of pairs, each user against all items of the batch, and its gradients by both sides.

    An item that stands in the batch twice is no negative of itself.
    """
    z = u @ v.T / temperature
    z[(items[:, None] == items[None, :]) & ~np.eye(len(items), dtype=bool)] = -np.inf
    top = z.max(axis=1, keepdims=True)
    p = np.exp(z - top)
    total = p.sum(axis=1, keepdims=True)
    loss = float((weight * (np.log(total[:, 0]) + top[:, 0] - np.diag(z))).sum())
    off = (p / total - np.eye(len(items))) * weight[:, None] / temperature
    return loss, off @ v, off.T @ u


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _rows_of(ids: pa.ChunkedArray, known: pa.ChunkedArray) -> np.ndarray:
    """Where each id stands in ``known``."""
    try:
        return pc.index_in(ids, known.combine_chunks()).to_numpy().astype(np.int64)
    except (pa.ArrowNotImplementedError, pa.ArrowTypeError):  # nested ids
        row = {str(x): i for i, x in enumerate(known.to_pylist())}
        return np.array([row[str(x)] for x in ids.to_pylist()], np.int64)


def _turns(rate: float, epochs: int, temperature: float, batch: int, dim: int):
    """A group of user blocks and one of item blocks: their vectors after all turns between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        users, items, pairs = (table.filter(pc.equal(table["kind"], k)) for k in range(3))
        del table

        def vectors(side: pa.Table) -> np.ndarray:
            return side["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).copy()

        u, v = vectors(users), vectors(items)
        if pairs.num_rows:
            epoch, ub, ib, at = (pairs[c].to_numpy() for c in ("epoch", "ub", "ib", "at"))
            order = np.lexsort((at, ib, -ub, epoch))
            a, b = (_rows_of(pairs[c], side[c])[order] for c, side in (("user_id", users), ("item_id", items)))
            weight, epoch, ub, ib = pairs["weight"].to_numpy()[order], epoch[order], ub[order], ib[order]
            new = (epoch[1:] != epoch[:-1]) | (ub[1:] != ub[:-1]) | (ib[1:] != ib[:-1])
            cells = np.concatenate([[0], np.flatnonzero(new) + 1, [len(a)]])
            for first, last in zip(cells[:-1], cells[1:]):
                pace = rate * (1 - int(epoch[first]) / epochs)
                for start in range(first, last, batch):
                    end = min(start + batch, last)
                    i, j, w = a[start:end], b[start:end], weight[start:end]
                    _, du, dv = gradients(u[i], v[j], j, w / w.mean(), temperature)
                    np.add.at(u, i, -pace * temperature * du)
                    np.add.at(v, j, -pace * temperature * dv)
                    u[i], v[j] = _unit(u[i]), _unit(v[j])
        for side, x in ((users, u), (items, v)):
            for start in range(0, len(x), 8192):
                some, flat = side.slice(start, 8192).combine_chunks(), pa.array(x[start : start + 8192].ravel())
                vec = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim, dtype=np.int32)), flat)
                out = pa.table({"kind": some["kind"], "user_id": some["user_id"], "item_id": some["item_id"], "vec": vec})
                yield from out.to_batches()

    return run


def fit(pairs: DataFrame, dim: int, epochs: int = EPOCHS, rate: float = RATE, seed: int = 42, temperature: float = TEMPERATURE,
        block_rows: int = BLOCK_ROWS, batch: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """``(user_id, vec)`` and ``(item_id, vec)`` of weighted pairs, one row per pair, without nulls: pass a written table."""
    spark = pairs.sparkSession
    types = dict(pairs.dtypes)
    sides = {c: pairs.select(c).distinct() for c in ("user_id", "item_id")}
    blocks = max(LEAST_BLOCKS, -(-max(s.count() for s in sides.values()) // block_rows))
    groups = min(blocks, max(-(-blocks // GROUP_BLOCKS), math.ceil(math.sqrt(pairs.count() / TASK_PAIRS)), spark.sparkContext.defaultParallelism))
    none = {c: F.lit(None).cast(types[c]).alias(c) for c in sides}

    def stored(df: DataFrame, *by: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "contrastive")
        with shuffles_dropped(spark):
            df.write.partitionBy(*by).parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    def group(block: Column) -> Column:
        """Neighbouring blocks, about as many in each group."""
        return F.floor(block.cast("bigint") * groups / blocks).cast("int")

    starts = {c: first_vectors(s, c, dim, seed) for c, s in sides.items()}
    state, path = stored(starts["user_id"].select(F.lit(0).alias("kind"), "user_id", none["item_id"], "vec").union(
        starts["item_id"].select(F.lit(1).alias("kind"), none["user_id"], "item_id", "vec")
    ))
    ub, ib = _block("user_id", blocks), _block("item_id", blocks)
    dealt, dealt_path = stored(pairs.select(
        "user_id", "item_id", F.col("weight").cast("double").alias("weight"), ub.alias("ub"), ib.alias("ib"), F.pmod(group(ib) - group(ub), F.lit(groups)).alias("shift")
    ), "shift")
    # A group's own items come first, from the user's block on, and last, up to it; the end of an epoch is one round with the start of the next.
    for turn in range(epochs * groups + 1):
        epoch, shift = divmod(turn, groups)
        now = dealt.filter(F.col("shift") == shift).withColumn("epoch", F.lit(epoch) if shift else F.when(F.col("ib") < F.col("ub"), epoch - 1).otherwise(epoch))
        between = now.filter(F.col("epoch").between(0, epochs - 1)).select(
            group(F.col("ub")).alias("cell"), F.lit(2).alias("kind"), "user_id", "item_id", F.lit(None).cast("array<double>").alias("vec"), "weight",
            F.xxhash64("user_id", "item_id", F.col("epoch").cast("int")).alias("at"), "epoch", "ub", "ib",
        )
        cell = F.when(F.col("kind") == 0, group(ub)).otherwise(F.pmod(group(ib) - shift, F.lit(groups)))
        no = F.lit(0)
        ends = state.select(cell.alias("cell"), "kind", "user_id", "item_id", "vec", F.lit(0.0).alias("weight"), no.cast("bigint").alias("at"), no.alias("epoch"), no.alias("ub"), no.alias("ib"))
        last = path
        state, path = stored(ends.union(between).repartitionById(groups, "cell").mapInArrow(
            _turns(rate, epochs, temperature, batch, dim), f"kind int, user_id {types['user_id']}, item_id {types['item_id']}, vec array<double>"
        ))
        drop_path(spark, last)
    drop_path(spark, dealt_path)
    return state.filter("kind = 0").select("user_id", "vec"), state.filter("kind = 1").select("item_id", "vec")
