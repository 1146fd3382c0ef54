"""Hard negatives of anchor rows, from exact integer scores of anchor and candidate tiles.

Vectors become int64 components. Anchors and candidates are dealt by hash into tiles; a task holds one tile of each side,
multiplies them by Strassen's recursion and returns heaps, so scores never exist as rows.

1. **Positive heaps.** Per anchor, the best rows of its own label in a tile; heaps of tiles merge by keeping the best.
   Tiles are cut within each label, so a hot label is more tiles and not a larger task.
2. **Window heaps.** Per anchor and positive, the best rows of other labels within the positive's score window.

All work is exact: sums and differences of tiles are int64 additions, and products are whole numbers below 2^63.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import written
from souk.operators.blocks import reduce_block_pairs

#: Rows of an anchor tile and of a candidate tile.
ANCHORS, CANDIDATES = 2048, 2048
#: Smallest side of a product that is split further.
LEAF = 32
#: Squared lengths stay below this, so that a hundred times any score is an int64.
LONGEST = 1 << 56


@dataclass(frozen=True)
class Mining:
    """How many positives an anchor has and negatives a positive, and the window of negative scores in percent of its score."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The plain product; in floats where every sum is a whole number below 2^53, and so the same."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for int64 tiles of any shape: seven half-size products instead of eight, odd sides padded with zeros.

    Sums wrap at 2^64 like all int64 arithmetic, so the result is exact whenever the true product fits in int64.
    """
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return _product(a, b)
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j], out[:i, j:] = m1 + m4 - m5 + m7, m3 + m5
    out[i:, :j], out[i:, j:] = m2 + m4, m1 - m2 + m3 + m6
    return out[:rows, :columns]


def quantised(rows: DataFrame, key: str, label: Column, vector: str, scale: int) -> DataFrame:
    """``(id, label, v, row)``: whole components as long arrays; ``row`` tells rows of one id apart that differ.

    Rows with a null id, label or vector, or a component that is null or not finite, are left out.
    """
    given = rows.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    whole = given.filter(
        "id is not null and label is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    ).withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))
    size = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    fits = F.when(size < LONGEST, F.col("v")).otherwise(F.raise_error(F.lit("a vector is too long for 64-bit scores")))
    return whole.withColumn("v", fits).withColumn("row", F.xxhash64("id", "label", "v"))


def _tile(table: pa.Table, order: str, width: int | None = None) -> tuple[pa.Table, np.ndarray]:
    """The rows in ascending order of a column, and their vectors as one matrix; shorter ones are padded with zeros."""
    table = table.sort_by(order).combine_chunks()
    vectors = table.column("v").combine_chunks()
    sizes = vectors.value_lengths().to_numpy().astype(np.int64)
    values = vectors.flatten().to_numpy()
    out = np.zeros((table.num_rows, max(width or 0, int(sizes.max(initial=0)))), np.int64)
    inside = np.arange(out.shape[1])[None, :] < sizes[:, None]
    out[inside] = values
    return table, out


def _scores(anchors: pa.Table, candidates: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Both tiles, candidates by ascending id, and the score of every pair."""
    left, a = _tile(anchors, "row")
    right, b = _tile(candidates, "id")
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    return left, right, strassen(a, np.ascontiguousarray(b.T))


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, earlier places first among equal ones."""
    if len(scores) > n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:n]


_POSITIVES = "row bigint, positive_id bigint, positive_score bigint"
_WINDOWS = "row bigint, id bigint, positive int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def _positive_heaps(mining: Mining) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def reduce(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = ([], [], [])
        if anchors.num_rows and candidates.num_rows:
            left, right, scores = _scores(anchors, candidates)
            ids = right.column("id").to_numpy()
            for row, own, line in zip(left.column("row").to_pylist(), left.column("id").to_pylist(), scores):
                others = np.flatnonzero(ids != own)
                best = others[_best(line[others], mining.positives)]
                for column, values in zip(out, (np.full(len(best), row), ids[best], line[best])):
                    column.append(values)
        return pa.table({n: np.concatenate(c) if c else np.empty(0, np.int64) for n, c in zip(("row", "positive_id", "positive_score"), out)})

    return reduce


def _window_heaps(mining: Mining) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def reduce(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ("row", "id", "positive", "positive_id", "positive_score", "negative_id", "negative_score")
        out = {n: [] for n in names}
        if anchors.num_rows and candidates.num_rows:
            left, right, scores = _scores(anchors, candidates)
            ids, labels = right.column("id").to_numpy(), right.column("label").to_numpy()
            for anchor, line in zip(left.select(["row", "id", "label", "positives"]).to_pylist(), scores):
                positives = [(p["rank"], p["positive_id"], p["positive_score"]) for p in anchor["positives"]]
                most = max(s for _, _, s in positives) * mining.high
                least = min(s for _, _, s in positives) * mining.low
                near = np.flatnonzero((labels != anchor["label"]) & (line * 100 <= most) & (line * 100 >= least))
                near = near[np.argsort(-line[near], kind="stable")]
                falling = -100 * line[near]
                for rank, positive, score in positives:
                    first = np.searchsorted(falling, -mining.high * score, "left")
                    stop = np.searchsorted(falling, -mining.low * score, "right")
                    found = near[first : max(first, min(stop, first + mining.negatives))]
                    for name, value in zip(names, (anchor["row"], anchor["id"], rank, positive, score)):
                        out[name].append(np.full(len(found), value))
                    out["negative_id"].append(ids[found])
                    out["negative_score"].append(line[found])
        columns = {n: np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for n, c in out.items()}
        return pa.table({n: pa.array(c.astype(np.int32)) if n == "positive" else pa.array(c) for n, c in columns.items()})

    return reduce


def hard_negatives(
    rows: DataFrame, is_anchor: Column, key: str = "vec_id", label: Column | str = "label", vector: str = "embedding",
    scale: int = 256, mining: Mining = Mining(), anchors: int = ANCHORS, candidates: int = CANDIDATES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for every anchor and positive.

    ``is_anchor`` is a condition on the column ``id``. A score is the inner product of ``floor(scale * x)``. An anchor's positives
    are the rows of its label with the highest scores, and a positive's negatives the rows of other labels with the highest
    scores of ``low`` to ``high`` percent of the positive's; ties go to the smaller id.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part. Shorter vectors count as
    padded with zeros; one whose squared length reaches 2^56 is an error. Rows of an anchor's id are never its positives;
    repeated rows are candidates as often as they come, equal anchors count once, and different rows of one anchor id are
    anchors of their own. An empty table gives no rows, and other columns are not read.
    """
    label = F.col(label) if isinstance(label, str) else label
    table = written(quantised(rows, key, label, vector, scale), "vectors")
    asked = written(table.filter(is_anchor).dropDuplicates(["row"]), "anchors")
    heaps = reduce_block_pairs(asked, table, ["label"], "row", "id", _positive_heaps(mining), _POSITIVES, anchors, candidates)
    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    positives = heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= mining.positives)
    lists = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    windows = reduce_block_pairs(
        written(asked.join(lists, "row"), "positives"), table, [], "row", "id", _window_heaps(mining), _WINDOWS, anchors, candidates
    )
    first = Window.partitionBy("row", "positive").orderBy(F.desc("negative_score"), "negative_id")
    return windows.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= mining.negatives).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
