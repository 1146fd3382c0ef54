"""Vector retrieval: exact nearest neighbours by cosine, and approximate ones from inverted lists."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from souk.operators.blocks import LEFT_ROWS, RIGHT_ROWS, reduce_block_pairs

# Inverted lists: rows that train the quantiser at most, of those per list, rounds of k-means, and the share of lists that a query
# probes. Vectors without any clusters, the worst case, need that many for a recall of 0.9; `tuned` finds fewer where fewer do.
SAMPLE_ROWS, LIST_ROWS, ROUNDS, PROBE_SHARE = 16_384, 40, 5, 0.65
RESCORED = 4  # times k: code scores of a block that are compared in full
# Rows of the index and queries that a task of the approximate search holds, queries that it scores at a time, and tasks per core.
TASK_INDEX, TASK_QUERIES, SCORED_QUERIES, TASKS = 131_072, 65_536, 512, 4
CENTROID_DIGITS = 6
SCORE_DIGITS = 9  # scores are rounded here, so that the order of a sum cannot change a rank


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _block_topk(k: int):
    """A reducer: the k best items of one index block for each query of one query block."""

    def reduce(queries: pa.Table, items: pa.Table) -> pa.Table:
        items = items.take(pc.sort_indices(items["item_id"]))
        rows, picks, scores = [], [], []
        if queries.num_rows and items.num_rows:
            index = _unit_rows(_matrix(items["item_vec"]))
            sims = np.round(_unit_rows(_matrix(queries["query_vec"])) @ index.T, SCORE_DIGITS)
            best = min(k, sims.shape[1])
            floors = np.partition(sims, sims.shape[1] - best, axis=1)[:, sims.shape[1] - best]
            for row, (line, floor) in enumerate(zip(sims, floors)):
                tied = np.flatnonzero(line >= floor)
                kept = tied[np.argsort(-line[tied], kind="stable")][:best]
                rows.append(np.full(len(kept), row))
                picks.append(kept)
                scores.append(line[kept])
        at = np.concatenate(rows) if rows else np.empty(0, int)
        of = np.concatenate(picks) if picks else np.empty(0, int)
        return pa.table(
            {
                "query_id": queries["query_id"].take(pa.array(at)),
                "item_id": items["item_id"].take(pa.array(of)),
                "score": pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64()),
            }
        )

    return reduce


def topk_per_query(scored: DataFrame, k: int, query: str = "query_id", item: str = "item_id", score: str = "score") -> DataFrame:
    """The k best rows per query with their ``rank``; equal scores go to the smaller item id.

    The rank filter is pushed below the shuffle, so a query with very many rows sends only k per task.
    """
    order = Window.partitionBy(query).orderBy(F.desc(score), F.asc(item))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _sides(queries: DataFrame, index: DataFrame, query_id: str, query_vec: str, item_id: str, item_vec: str):
    """Both tables under common names; a row without a vector has no neighbours and is nobody's."""
    left = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("query_vec"))
    right = index.select(F.col(item_id).alias("item_id"), F.col(item_vec).alias("item_vec"))
    return left.filter(F.col("query_vec").isNotNull()), right.filter(F.col("item_vec").isNotNull())


def _result_schema(queries: DataFrame, index: DataFrame) -> str:
    return (
        f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
        f"item_id {index.schema['item_id'].dataType.simpleString()}, score double"
    )


def knn_cosine(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    item_id: str = "item_id",
    item_vec: str = "embedding",
    query_rows: int = LEFT_ROWS,
    index_rows: int = RIGHT_ROWS,
) -> DataFrame:
    """Exact k nearest items per query by cosine: ``(query_id, item_id, score, rank)``.

    Both sides are cut into blocks; a task multiplies one query block with one index block and keeps k
    rows per query. An empty index gives no rows; a zero vector scores 0.
    """
    left, right = _sides(queries, index, query_id, query_vec, item_id, item_vec)
    partial = reduce_block_pairs(
        left, right, [], "query_id", "item_id", _block_topk(k), _result_schema(left, right), query_rows, index_rows
    )
    return topk_per_query(partial, k)


@dataclass(frozen=True)
class ListIndex:
    """A trained coarse quantiser: unit centroids, the group that each list's rows go to, and the lists a query probes."""

    centroids: np.ndarray
    groups: np.ndarray
    probes: int

    def rebuilt(self, unit: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Unit rows as four-bit codes tell them: the centroid and sevenths of the largest difference from it."""
        near = self.centroids[lists]
        off = unit - near
        step = np.abs(off).max(axis=1, keepdims=True) / 7
        return near + step * np.floor(np.divide(off, step, out=np.zeros_like(off), where=step > 0) + 0.5)


def _train_centroids(sample: np.ndarray, lists: int, rounds: int) -> np.ndarray:
    """Spherical k-means from the first rows; an empty list keeps its centroid. Rounded, so that the order of a sum is no matter."""
    centroids = np.round(sample[:lists], CENTROID_DIGITS)
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        filled = np.bincount(nearest, minlength=lists) > 0
        centroids[filled] = np.round(_unit_rows(sums[filled]), CENTROID_DIGITS)
    return centroids


def train_lists(index: DataFrame, item_id: str = "item_id", item_vec: str = "embedding", probe_share: float = PROBE_SHARE,
                rounds: int = ROUNDS, sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS, group_rows: int = RIGHT_ROWS) -> ListIndex:
    """Fits the quantiser on at most ``sample_rows`` rows, those of smallest md5 of their id; every row is indexed later.

    There is a list per ``list_rows`` sampled rows, so the model on the driver is bounded by the sample. Lists are put
    together into groups of about ``group_rows`` rows, the unit in which queries and rows meet.
    """
    rows = index.filter(F.col(item_vec).isNotNull())
    n = rows.count()
    picked = rows.orderBy(F.md5(F.col(item_id).cast("string")), item_id).limit(sample_rows).select(item_vec).toArrow()
    sample = _unit_rows(_matrix(picked[item_vec])) if picked.num_rows else np.zeros((1, 1))
    lists = max(1, len(sample) // list_rows)
    centroids = _train_centroids(sample, lists, rounds)
    expected = np.bincount((sample @ centroids.T).argmax(axis=1), minlength=lists) * (n / len(sample))
    groups = ((np.cumsum(expected) - expected / 2) // group_rows).astype(np.int64)
    return ListIndex(centroids, groups, max(1, math.ceil(probe_share * lists)))


def tuned(lists: ListIndex, queries: DataFrame, index: DataFrame, k: int, recall: float, sample_rows: int = 200,
          query_id: str = "query_id", query_vec: str = "embedding", item_id: str = "item_id", item_vec: str = "embedding") -> ListIndex:
    """``lists`` with the fewest probes that find ``recall`` of the true neighbours of at most ``sample_rows`` queries."""
    some = queries.orderBy(F.md5(F.col(query_id).cast("string")), query_id).limit(sample_rows)
    truth = knn_cosine(some, index, k, query_id, query_vec, item_id, item_vec).select("query_id", "item_id")
    items = index.select(F.col(item_id).alias("item_id"), F.col(item_vec).alias("item_vec")).filter("item_vec is not null")
    asked = some.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("query_vec"))
    near = truth.join(items, "item_id").join(asked, "query_id").select("query_vec", "item_vec").toArrow()  # at most sample_rows * k rows
    if not near.num_rows:
        return lists
    order = np.argsort(-(_unit_rows(_matrix(near["query_vec"])) @ lists.centroids.T), axis=1, kind="stable")
    own = (_unit_rows(_matrix(near["item_vec"])) @ lists.centroids.T).argmax(axis=1)
    needed = np.sort((order == own[:, None]).argmax(axis=1) + 1)
    return replace(lists, probes=int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]))


def _in_lists(df: DataFrame, vector: str, lists: ListIndex, probes: int) -> DataFrame:
    """A row per group that the ``probes`` nearest lists of a row belong to, with those lists."""
    columns = df.schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(_unit_rows(_matrix(pa.chunked_array([batch.column(vector)]))) @ lists.centroids.T), axis=1, kind="stable")[:, :probes]
            keys = np.stack([np.repeat(np.arange(len(near)), near.shape[1]), lists.groups[near].ravel(), near.ravel()])
            keys = keys[:, np.lexsort(keys[::-1])]
            starts = np.flatnonzero(np.append(True, (keys[:2, 1:] != keys[:2, :-1]).any(axis=0)))
            held = pa.ListArray.from_arrays(pa.array(np.append(starts, keys.shape[1]).astype(np.int32)), pa.array(keys[2].astype(np.int32)))
            rows = batch.take(pa.array(keys[0, starts]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys[1, starts]), held], [*columns, "list_group", "lists"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("list_group", LongType()), StructField("lists", ArrayType(IntegerType()))]))


@dataclass(frozen=True)
class _Layout:
    """Where rows of the index go: blocks per group of lists, numbered through, and the part of the index that a block belongs to."""

    blocks: np.ndarray
    parts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.blocks) - self.blocks

    def reach(self, lists: ListIndex) -> np.ndarray:
        """Which parts a list has rows in, a line per list."""
        out = np.zeros((len(lists.centroids), int(self.parts.max()) + 1), bool)
        for at, group in enumerate(lists.groups):
            out[at, self.parts[self.first[group] : self.first[group] + self.blocks[group]]] = True
        return out


def _layout(sizes: np.ndarray, index_rows: int, task_rows: int) -> _Layout:
    """Blocks of about ``index_rows`` within a group, and parts of as many neighbouring blocks as have ``task_rows``."""
    blocks = -(-sizes // index_rows)
    rows = np.repeat(sizes / np.maximum(blocks, 1), blocks)
    return _Layout(blocks, ((np.cumsum(rows) - rows / 2) // task_rows).astype(np.int64))


def _own_lists(column: pa.Array, lists: ListIndex) -> np.ndarray:
    return (_unit_rows(_matrix(pa.chunked_array([column]))) @ lists.centroids.T).argmax(axis=1)


def _group_sizes(index: DataFrame, lists: ListIndex) -> np.ndarray:
    """Rows of the index per group of lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(int(lists.groups.max()) + 1, np.int64)
        for batch in batches:
            if batch.num_rows:
                n += np.bincount(lists.groups[_own_lists(batch.column(0), lists)], minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], ["g", "n"])

    out = np.zeros(int(lists.groups.max()) + 1, np.int64)
    for r in index.select("item_vec").mapInArrow(run, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n")).collect():
        out[r.g] = r.n
    return out


def _filed(index: DataFrame, lists: ListIndex, layout: _Layout) -> DataFrame:
    """The index with each row's ``list``, ``block`` and ``part``."""
    hashed = index.withColumn("hash", F.xxhash64("item_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _own_lists(batch.column("item_vec"), lists)
                group = lists.groups[own]
                block = layout.first[group] + batch.column("hash").to_numpy() % layout.blocks[group]
                new = [pa.array(x.astype(np.int32)) for x in (own, block, layout.parts[block])]
                yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item_vec"), *new], ["item_id", "item_vec", "list", "block", "part"])

    return hashed.mapInArrow(run, StructType([*index.schema.fields, *[StructField(c, IntegerType()) for c in ("list", "block", "part")]]))


def _asking(queries: DataFrame, lists: ListIndex, layout: _Layout) -> DataFrame:
    """A row per query and ``part`` with any list that it probes; ``probed`` has a bit per list."""
    reach = layout.reach(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(_unit_rows(_matrix(pa.chunked_array([batch.column("query_vec")]))) @ lists.centroids.T), axis=1, kind="stable")[:, : lists.probes]
            probed = np.zeros((len(near), len(lists.centroids)), bool)
            np.put_along_axis(probed, near, True, axis=1)
            bits = pa.array([x.tobytes() for x in np.packbits(probed, axis=1)], pa.binary())
            for part in range(reach.shape[1]):
                rows = pa.array(np.flatnonzero(probed[:, reach[:, part]].any(axis=1)))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [*batch.take(rows).columns, bits.take(rows), pa.array(np.full(len(rows), part, np.int32))], [*batch.schema.names, "probed", "part"]
                    )

    return queries.mapInArrow(run, StructType([*queries.schema.fields, StructField("probed", BinaryType()), StructField("part", IntegerType())]))


def _merged(best: np.ndarray, places: np.ndarray, rows: np.ndarray, scores: np.ndarray, items: np.ndarray) -> None:
    """Puts scored items among the best of their rows; equal scores go to the item that stands first."""
    k, some = best.shape[1], np.unique(rows)
    row = np.concatenate([rows, np.repeat(some, k)])
    score, item = np.concatenate([scores, best[some].ravel()]), np.concatenate([items, places[some].ravel()])
    order = np.lexsort((item, -score, row))
    row, score, item = row[order], score[order], item[order]
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    kept = rank < k
    best[row[kept], rank[kept]], places[row[kept], rank[kept]] = score[kept], item[kept]


def _best_of_block(asked: np.ndarray, unit: np.ndarray, rebuilt: np.ndarray, probed: np.ndarray, lists: np.ndarray, depth: int,
                   floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, item, score)`` of what can be among the best by full score, of each row's ``depth`` best by code in its probed lists.

    ``floor`` is the score that a row has to reach. A code score is off by no more than what the code differs by from its vector, so
    single precision tells what cannot reach it; of the rest that does, an item counts if fewer than ``depth`` codes are above its own.
    Rows without a floor, or whose codes are too near to tell, rank all their codes.
    """
    blur = 1e-6 * unit.shape[1]  # of a score in single precision
    known = np.flatnonzero(floor > -np.inf)
    ranked = np.ones(len(asked), bool)
    row = item = np.empty(0, np.int64)
    if len(known):
        ranked[known] = False
        codes = asked[known].astype(np.float32) @ rebuilt.astype(np.float32).T
        off = (np.linalg.norm(unit - rebuilt, axis=1) + blur).astype(np.float32)
        at, item = np.divmod(np.flatnonzero(codes + off >= (floor[known] - blur).astype(np.float32)[:, None]), len(off))
        kept = probed[known[at], lists[item]]
        at, item = at[kept], item[kept]
        kept = np.einsum("ij,ij->i", unit[item], asked[known[at]]) >= floor[known[at]] - 10.0**-SCORE_DIGITS
        at, item = at[kept], item[kept]
        lowest = np.full(len(known), np.inf, np.float32)
        np.minimum.at(lowest, at, codes[at, item])
        crowded = np.count_nonzero(codes > (lowest - blur).astype(np.float32)[:, None], axis=1) > depth
        counts, asking = np.ones(len(at), bool), np.flatnonzero(crowded[at])
        for start in range(0, len(asking), 256):
            one = asking[start : start + 256]
            own, open_ = codes[at[one], item[one]][:, None], probed[known[at[one]]][:, lists]
            counts[one] = np.count_nonzero((codes[at[one]] > own - blur) & open_, axis=1) <= depth  # its own is one of them
            unsure = ~counts[one] & (np.count_nonzero((codes[at[one]] > own + blur) & open_, axis=1) < depth)
            ranked[known[at[one[unsure]]]] = True
        row = known[at]
        kept = counts & ~ranked[row]
        row, item = row[kept], item[kept]
    rows, items = [row], [item]
    ranked = np.flatnonzero(ranked)
    codes = asked[ranked] @ rebuilt.T
    np.copyto(codes, -np.inf, where=~probed[ranked][:, lists])
    best = min(depth, codes.shape[1])
    for row, line in zip(ranked, codes):
        lowest = np.partition(line, len(line) - best)[len(line) - best]
        tied = np.flatnonzero((line >= lowest) & (line > -np.inf))
        kept = tied[np.argsort(-line[tied], kind="stable")][:best]
        rows.append(np.full(len(kept), row))
        items.append(kept)
    row, item = np.concatenate(rows), np.concatenate(items)
    return row, item, np.round(np.einsum("ij,ij->i", unit[item], asked[row]), SCORE_DIGITS)


def _searched(k: int, depth: int, known: ListIndex):
    """One part of the index and some queries that probe it: per query, the ``k`` best of what each block's codes leave to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        index = table.filter(pc.is_valid(table["block"])).select(["item_id", "item_vec", "list", "block"])
        asking = table.filter(pc.is_null(table["block"])).select(["query_id", "query_vec", "probed"])
        del table
        if not index.num_rows or not asking.num_rows:
            return
        index = index.take(pc.sort_indices(index["item_id"], null_placement="at_start")).combine_chunks()
        asked, block, own = _unit_rows(_matrix(asking["query_vec"])), index["block"].to_numpy(), index["list"].to_numpy()
        bits = np.frombuffer(b"".join(asking["probed"].to_pylist()), np.uint8).reshape(len(asked), -1)
        best, places = np.full((len(asked), k), -np.inf), np.full((len(asked), k), -1)
        for of in np.unique(block):
            at = np.flatnonzero(block == of)
            unit, lists = _unit_rows(_matrix(index["item_vec"].take(pa.array(at)))), own[at]
            rebuilt = known.rebuilt(unit, lists)
            here, lists = np.unique(lists, return_inverse=True)
            for start in range(0, len(asked), SCORED_QUERIES):
                probed = np.unpackbits(bits[start : start + SCORED_QUERIES], axis=1)[:, here].astype(bool)
                some = start + np.flatnonzero(probed.any(axis=1))
                if not len(some):
                    continue
                row, item, score = _best_of_block(asked[some], unit, rebuilt, probed[some - start], lists, depth, best[some, k - 1])
                if len(row):
                    _merged(best, places, some[row], score, at[item])
        row, rank = np.nonzero(places >= 0)
        found = pa.table({"query_id": asking["query_id"].take(pa.array(row)), "item_id": index["item_id"].take(pa.array(places[row, rank])), "score": pa.array(best[row, rank])})
        yield from found.combine_chunks().to_batches(max_chunksize=65_536)

    return run


def knn_lists(
    queries: DataFrame, index: DataFrame, k: int, lists: ListIndex | None = None, depth: int | None = None,
    query_id: str = "query_id", query_vec: str = "embedding", item_id: str = "item_id", item_vec: str = "embedding",
    query_rows: int = LEFT_ROWS, index_rows: int = RIGHT_ROWS,
) -> DataFrame:
    """Approximate neighbours from inverted lists: ``(query_id, item_id, score, rank)``.

    A row is filed in the list of its nearest centroid, and a query probes its nearest lists. There four-bit codes are
    scored, and only the ``depth`` best of a query (four times ``k``) are compared in full, per block of the index: a group
    of lists, or a share of a crowded one. A task holds a part of the index, many blocks, and as many queries as it can (at least
    ``query_rows``), so that a query is sent once to a part and the index not often.
    ``lists`` is fitted on the index unless given. A null vector has no neighbours and is none.
    """
    spark = queries.sparkSession
    lists = lists or train_lists(index, item_id, item_vec, group_rows=index_rows)
    left, right = _sides(queries, index, query_id, query_vec, item_id, item_vec)
    schema = _result_schema(left, right)
    asking, sizes = left.count(), _group_sizes(right, lists) if not right.isEmpty() else np.zeros(1, np.int64)
    if not (asking and sizes.any()):
        return topk_per_query(spark.createDataFrame([], schema), k)
    layout = _layout(sizes, index_rows, max(index_rows, TASK_INDEX))
    parts = int(layout.parts.max()) + 1
    slices = max(-(-asking // TASK_QUERIES), min(-(-asking // query_rows), -(-TASKS * spark.sparkContext.defaultParallelism // parts)))

    def none(df: DataFrame, *names: str) -> list[Column]:
        return [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]

    asked, held = _asking(left, lists, layout), _filed(right, lists, layout)
    cells = held.select(
        F.explode(F.sequence(F.col("part") * slices, (F.col("part") + 1) * slices - 1)).alias("cell"), *none(asked, "query_id", "query_vec", "probed"),
        "item_id", "item_vec", "list", "block",
    ).union(asked.select(
        (F.col("part") * slices + F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int")).alias("cell"), "query_id", "query_vec", "probed",
        *none(held, "item_id", "item_vec", "list", "block"),
    ))
    partial = cells.repartitionById(parts * slices, "cell").mapInArrow(_searched(k, depth or RESCORED * k, lists), schema)
    return topk_per_query(partial, k)


def comparisons(queries: DataFrame, index: DataFrame, k: int, lists: ListIndex, depth: int | None = None, query_vec: str = "embedding",
                item_vec: str = "embedding") -> DataFrame:
    """One row: ``pairs``, those ``scored`` by code, and at most how many the codes leave to compare in ``full``."""
    def filed(df: DataFrame, vector: str, probes: int) -> DataFrame:
        return _in_lists(df.select(vector).filter(F.col(vector).isNotNull()), vector, lists, probes).select("list_group", F.explode("lists").alias("list"))

    asked = filed(queries, query_vec, lists.probes).groupBy("list").agg(F.count(F.lit(1)).alias("q"))
    held = filed(index, item_vec, 1).groupBy("list_group", "list").agg(F.count(F.lit(1)).alias("n"))
    both = held.join(asked, "list", "left").agg(
        F.sum(F.col("q") * F.col("n")).alias("scored"), F.sum("n").alias("n"), F.count_distinct("list_group").alias("groups")
    )
    n = queries.filter(F.col(query_vec).isNotNull()).count()
    return both.select(
        (F.col("n") * n).alias("pairs"), F.coalesce("scored", F.lit(0)).alias("scored"), (F.col("groups") * n * (depth or RESCORED * k)).alias("full")
    )


def recall_at_k(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of the true neighbours that were found, over all queries."""
    hits = truth.select("query_id", "item_id").join(
        found.select("query_id", "item_id", F.lit(1).alias("hit")), ["query_id", "item_id"], "left"
    )
    return hits.agg(F.avg(F.coalesce(F.col("hit"), F.lit(0)).cast("double")).alias("recall"))
