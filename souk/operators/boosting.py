"""Listwise boosting: trees on lambda gradients, whose pairs are weighted by the NDCG that their exchange would change.

NDCG is cut at ``k``, so a pair counts only if one of its rows is among the query's ``k`` best by the present score. A row
therefore needs no more of its query than those ``k`` rows: gradients are a join with a short list per query and a sum per
query (``lambdas``). The fit packs rows into chunks once, whole queries together and features as bin numbers, so that a round
is one pass over them without a shuffle. A query larger than a chunk stands in several, which exchange its ``k`` best rows and
its sums; no task holds its rows. Trees grow level by level from histograms that tasks add up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import drop_path, scratch_path

# Rows of a query that NDCG looks at, histogram bins per feature, and what keeps a leaf from growing without bound.
CUT, BINS, SMOOTHING = 10, 32, 1.0
#: Fewest rows of a leaf.
LEAF_ROWS = 20
#: Rows that a chunk holds at most, up to a query of that size.
CHUNK_ROWS = 65_536


def _gain(relevance: Column) -> Column:
    return F.pow(F.lit(2.0), relevance.cast("double")) - 1


def _discount(rank: Column) -> Column:
    return 1 / F.log2(rank.cast("double") + 1)


def ideal(examples: DataFrame, query: str, k: int = CUT) -> DataFrame:
    """``(query, ideal)``: the DCG at ``k`` of each query's rows in the order of their relevance."""
    best = Window.partitionBy(query).orderBy(F.desc("relevance"))
    top = examples.select(query, "relevance").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return top.groupBy(query).agg(F.sum(_gain(F.col("relevance")) * _discount(F.col("rank"))).alias("ideal"))


def lambdas(scored: DataFrame, ideals: DataFrame, query: str = "user_id", item: str = "item_id", k: int = CUT) -> DataFrame:
    """``scored`` rows (with ``relevance`` and ``score``) and their ``gradient`` and ``curvature`` of the NDCG-weighted pair loss.

    Equal scores rank by item. A pair of unequal relevance one of whose rows is in the top ``k`` costs the logistic loss of
    its score difference times the change of NDCG at ``k`` if the two changed places. Queries without any relevant row have none.
    """
    best = Window.partitionBy(query).orderBy(F.desc("score"), item)
    top = scored.select(query, item, "relevance", "score").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    lists = top.groupBy(query).agg(F.sort_array(F.collect_list(F.struct("rank", "score", _gain(F.col("relevance")).alias("gain"), F.col(item).alias("_item")))).alias("_top"))
    known = lists.join(ideals, query)
    mine = F.transform(F.filter("_top", lambda t: t["_item"] == F.col(item)), lambda t: t["rank"])
    rows = scored.join(known, query).withColumns({"_gain": _gain(F.col("relevance")), "_rank": F.try_element_at(mine, F.lit(1))})
    own_discount = F.when(F.col("_rank").isNotNull(), _discount(F.col("_rank"))).otherwise(0.0)

    def pair(t: Column) -> Column:
        """The row's gradient and curvature by one row of the top; the other row's gradient is its negative."""
        swap = F.abs(F.col("_gain") - t["gain"]) * F.abs(F.col("_discount") - _discount(t["rank"])) / F.col("ideal")
        sign = F.signum(F.col("_gain") - t["gain"])
        rho = 1 / (1 + F.exp(sign * (F.col("score") - t["score"])))
        return F.struct((-sign * swap * rho).alias("g"), (F.abs(sign) * swap * rho * (1 - rho)).alias("h"))

    valid = F.col("ideal") > 0
    paired = rows.withColumn("_discount", own_discount).withColumn(
        "_pairs", F.when(valid, F.transform("_top", pair)).otherwise(F.transform("_top", lambda t: F.struct(F.lit(0.0).alias("g"), F.lit(0.0).alias("h"))))
    )
    # what rows outside the top do to each row of it
    outside = paired.filter(F.col("_rank").isNull()).groupBy(query).agg(
        F.array(*[F.sum(F.coalesce(-F.try_element_at(F.col("_pairs.g"), F.lit(i)), F.lit(0.0))) for i in range(1, k + 1)]).alias("_g"),
        F.array(*[F.sum(F.coalesce(F.try_element_at(F.col("_pairs.h"), F.lit(i)), F.lit(0.0))) for i in range(1, k + 1)]).alias("_h"),
    )

    def total(part: str, more: str) -> Column:
        own = F.aggregate(f"_pairs.{part}", F.lit(0.0), lambda s, x: s + x)
        return own + F.when(F.col("_rank").isNotNull(), F.coalesce(F.try_element_at(F.col(more), F.col("_rank")), F.lit(0.0))).otherwise(0.0)

    return paired.join(outside, query, "left").select(
        *scored.columns, total("g", "_g").alias("gradient"), total("h", "_h").alias("curvature")
    )


@dataclass
class Tree:
    """A binary tree in arrays: a node's feature (-1 in a leaf), threshold (left if not above) and value; children of i are 2i+1, 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        at = np.zeros(len(x), np.int64)
        while True:
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = 2 * node + 1 + (x[inner, feature[inner]] > self.threshold[node])


@dataclass
class Ranker:
    """A sum of trees."""

    rate: float
    trees: list[Tree] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.rate * sum((t.value[t.leaves(x)] for t in self.trees), np.zeros(len(x)))

    def score(self, features: str | Column) -> Column:
        """The model as a column over an array column of features."""

        @F.pandas_udf("double")
        def scores(vectors: pd.Series) -> pd.Series:
            return pd.Series(self.predict(np.stack(vectors.to_numpy())) if len(vectors) else [], dtype=float)

        return scores(features)


def bin_edges(examples: DataFrame, dim: int, bins: int = BINS) -> list[np.ndarray]:
    """Distinct quantiles per feature, at most ``bins - 1`` of them."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = examples.agg(*[F.percentile_approx(F.col("features")[i], shares, F.lit(10_000)).alias(f"q{i}") for i in range(dim)]).first()
    return [np.unique(np.array(found[i] or [], float)) for i in range(dim)]


def _histograms(rows: DataFrame, tree: Tree, edges: list[np.ndarray], level: int) -> np.ndarray:
    """Sums of gradient, curvature and rows by node of a level, feature and bin."""
    nodes, dim, bins = 1 << level, len(edges), max(map(len, edges), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, nodes * dim * bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            node = tree.leaves(x) - (nodes - 1)
            here = node >= 0
            weights = (batch.column("gradient").to_numpy()[here], batch.column("curvature").to_numpy()[here], np.ones(here.sum()))
            for f in range(dim):
                cell = (node[here] * dim + f) * bins + np.searchsorted(edges[f], x[here, f], "left")
                for i, w in enumerate(weights):
                    sums[i] += np.bincount(cell, w, sums.shape[1])
        cells = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(cells), *[pa.array(s[cells]) for s in sums]], ["cell", "g", "h", "n"])

    return _added(rows.select("features", "gradient", "curvature").mapInArrow(run, "cell bigint, g double, h double, n double"), nodes, dim, bins)


def _added(parts: DataFrame, nodes: int, dim: int, bins: int) -> np.ndarray:
    """The tasks' histograms in one."""
    whole = parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
    out = np.zeros((3, nodes * dim * bins))
    out[:, whole["cell"].to_numpy()] = np.stack([whole[c].to_numpy() for c in ("g", "h", "n")])
    return out.reshape(3, nodes, dim, bins)


def _grown(sums: Callable[[Tree, int], np.ndarray], edges: list[np.ndarray], depth: int, smoothing: float, leaf_rows: int) -> Tree:
    size = (1 << (depth + 1)) - 1
    tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
    for level in range(max(depth, 1)):
        first = (1 << level) - 1
        if level and not (tree.feature[(first - 1) // 2 : first] >= 0).any():
            break
        g, h, n = sums(tree, level)
        if not level:
            tree.value[0] = -g[0, 0].sum() / (h[0, 0].sum() + smoothing)
        if not depth:
            break
        for node in range(1 << level):
            at = first + node
            if at and tree.feature[(at - 1) // 2] < 0:
                continue
            gl, hl, nl = (np.cumsum(s[node], axis=1)[:, :-1] for s in (g, h, n))
            gw, hw, nw = (s[node].sum(axis=1, keepdims=True) for s in (g, h, n))
            saved = gl**2 / (hl + smoothing) + (gw - gl) ** 2 / (hw - hl + smoothing) - gw**2 / (hw + smoothing)
            open_ = (nl >= leaf_rows) & (nw - nl >= leaf_rows)
            for f, e in enumerate(edges):
                open_[f, len(e) :] = False
            saved = np.where(open_, np.round(saved, 9), 0)
            f, b = np.unravel_index(np.argmax(saved), saved.shape) if saved.size else (0, 0)
            if saved.size and saved[f, b] > 0:
                tree.feature[at], tree.threshold[at] = f, edges[f][b]
                # the split's own sums are those of its children, so the last level needs no pass
                tree.value[2 * at + 1] = -gl[f, b] / (hl[f, b] + smoothing)
                tree.value[2 * at + 2] = -(gw[f, 0] - gl[f, b]) / (hw[f, 0] - hl[f, b] + smoothing)
    return tree


def grow(rows: DataFrame, edges: list[np.ndarray], depth: int, smoothing: float = SMOOTHING, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree on ``gradient`` and ``curvature``: Newton values in the leaves, splits by the loss that they save."""
    return _grown(lambda tree, level: _histograms(rows, tree, edges, level), edges, depth, smoothing, leaf_rows)


@dataclass(frozen=True)
class _Bins:
    """Features as numbers of their bins; one that is missing has a number of its own and goes left in every tree."""

    edges: list[np.ndarray]

    @property
    def kind(self) -> np.dtype:
        return np.dtype(np.uint8 if max(map(len, self.edges), default=0) < 255 else np.uint16)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A line per feature."""
        missing = np.iinfo(self.kind).max
        return np.stack([np.where(np.isnan(x[:, f]), missing, np.searchsorted(e, x[:, f], "left")).astype(self.kind) for f, e in enumerate(self.edges)])

    def leaves(self, tree: Tree, codes: np.ndarray) -> np.ndarray:
        """What ``Tree.leaves`` returns for the features behind ``codes``."""
        cut = np.array([np.searchsorted(self.edges[f], t, "left") if f >= 0 else 0 for f, t in zip(tree.feature, tree.threshold)])
        at, every = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
        while True:
            feature = tree.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            code = codes[feature, every]
            at = np.where(inner, 2 * at + 1 + ((code > cut[at]) & (code < np.iinfo(self.kind).max)), at)

    def histogram(self, f: int, codes: np.ndarray) -> np.ndarray:
        """The histogram cell of each row."""
        cells = codes[f].astype(np.int64)
        cells[codes[f] == np.iinfo(self.kind).max] = np.searchsorted(self.edges[f], np.nan, "left")
        return cells


def _pairs(score: np.ndarray, gain: np.ndarray, place: np.ndarray, starts: np.ndarray, best: np.ndarray, gains: np.ndarray, there: np.ndarray,
           ideals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gradient and curvature of rows by their query's best, and by query what rows outside do to each of these.

    ``place`` is a row's place among the best, or their number. ``best``, ``gains`` and ``there`` have a line per query: the
    best rows' scores and gains, and which exist.
    """
    k, runs = best.shape[1], np.diff(starts)
    discount = np.append(1 / np.log2(np.arange(k) + 2.0), 0.0)
    own, outside = discount[place], place == k
    g, h, more_g, more_h = np.zeros(len(score)), np.zeros(len(score)), np.zeros(best.shape), np.zeros(best.shape)
    with np.errstate(over="ignore"):
        for j in range(k):
            whole = np.repeat(np.where(there[:, j] & (ideals > 0), ideals, np.inf), runs)
            off = gain - np.repeat(gains[:, j], runs)
            sign = np.sign(off)
            rho = 1 / (1 + np.exp(sign * (score - np.repeat(best[:, j], runs))))
            slope = np.abs(off) * np.abs(own - discount[j]) / whole * rho
            bend = slope * (1 - rho)
            slope *= -sign
            g += slope
            h += bend
            more_g[:, j] = np.add.reduceat(np.where(outside, -slope, 0.0), starts[:-1])
            more_h[:, j] = np.add.reduceat(np.where(outside, bend, 0.0), starts[:-1])
    return g, h, more_g, more_h


def _places(score: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's place among the ``k`` best of its run, or ``k``; and a line per run with the rows in these places, -1 for none."""
    runs = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((-score, runs))
    rank = np.arange(len(score)) - starts[runs]
    place = np.empty(len(score), np.int64)
    place[order] = np.minimum(rank, k)
    rows = np.full((len(starts) - 1, k), -1)
    rows[runs[rank < k], rank[rank < k]] = order[rank < k]
    return place, rows


def _list_gradients(score: np.ndarray, gain: np.ndarray, starts: np.ndarray, ideals: np.ndarray, unnamed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``lambdas`` gives for whole queries, one run of rows each, in the order of their items.

    As there, ``unnamed`` rows, those without an item, may be among the best that others are held against, but have no place themselves.
    """
    place, rows = _places(score, starts, k)
    place[unnamed] = k
    there = rows >= 0
    g, h, more_g, more_h = _pairs(score, gain, place, starts, np.where(there, score[rows], 0.0), np.where(there, gain[rows], 0.0), there, ideals)
    there &= ~np.isin(rows, unnamed)
    g[rows[there]] += more_g[there]
    h[rows[there]] += more_h[there]
    return g, h


def _ideals(gain: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """What ``ideal`` gives, by run."""
    rows = _places(gain, starts, k)[1]
    return (np.where(rows >= 0, gain[rows], 0.0) / np.log2(np.arange(k) + 2.0)).sum(axis=1)


@dataclass(frozen=True)
class _Crowd:
    """A query of several chunks: its ideal DCG and its best rows."""

    ideal: float
    score: np.ndarray = field(default_factory=lambda: np.empty(0))
    gain: np.ndarray = field(default_factory=lambda: np.empty(0))
    at: tuple[tuple[int, int], ...] = ()


def _floats(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), np.float64)


def _blob(x: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes()], pa.binary())


_CHUNK = ("chunk", "crowd", "items", "unnamed", "starts", "ideals", "gains", "codes", "raw", "gradient", "curvature", "more")


class _Chunks:
    """Rows of ``(query, item, relevance, features)`` packed for rounds of boosting.

    A chunk is a row with the runs of its queries, which are whole, or with a part of one crowded query. Every round writes the
    chunks anew with the sums of all trees so far and the rows' gradients, and drops those of the round before.
    """

    def __init__(self, examples: DataFrame, edges: list[np.ndarray], query: str, item: str, k: int, chunk_rows: int):
        self.spark, self.bins, self.k = examples.sparkSession, _Bins(edges), k
        rows = examples.filter(F.col(query).isNotNull()).select(
            F.col(query).alias("query"), F.col(item).alias("item"), "relevance", _gain(F.col("relevance")).alias("gain"), "features"
        )
        sizes = rows.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
        total = sizes.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > chunk_rows).alias("crowds")).first()
        self.item_type = rows.schema["item"].dataType.simpleString()
        self.paths: list[str] = []
        self.crowds: dict[int, _Crowd] = {}
        dealt = rows.withColumns({"crowd": F.lit(None).cast("bigint"), "piece": F.lit(0).cast("bigint")})
        if total.crowds:  # at most one per chunk_rows rows
            numbers = self._stored(sizes.filter(F.col("n") > chunk_rows).select(
                "query", F.monotonically_increasing_id().alias("crowd"), F.ceil(F.col("n") / chunk_rows).alias("pieces")
            ), "crowds")
            dealt = rows.join(F.broadcast(numbers), "query", "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("item", "gain"), "pieces"), F.lit(0).cast("bigint")))
            found = ideal(dealt.filter("crowd is not null"), "crowd", k).collect()
            self.crowds = {r.crowd: _Crowd(r.ideal) for r in found}
        parts = max(1, -(-(total.n or 0) // chunk_rows))
        sorted_ = dealt.select("crowd", F.xxhash64("query", "piece").alias("run"), "query", "piece", "item", "gain", "features").repartition(
            parts, "query", "piece"
        ).sortWithinPartitions("query", "piece", "item").select("crowd", "run", "item", "gain", "features")
        self.table = self._stored(self._packed(sorted_, chunk_rows), "chunks")

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(path := scratch_path(self.spark, name))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _packed(self, rows: DataFrame, chunk_rows: int) -> DataFrame:
        bins, k = self.bins, self.k

        def chunk(t: pa.Table, starts: np.ndarray, number: int, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
            gain, crowd = t["gain"].to_numpy(), t["crowd"][0].as_py()
            x = t["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            items = pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t["item"].combine_chunks()) if crowd is not None else pa.nulls(1, types[2])
            unnamed, none = np.flatnonzero(t["item"].is_null().to_numpy()), _blob(np.empty(0))
            ideals = _ideals(gain, starts, k) if crowd is None else np.empty(0)
            values = [pa.array([number], pa.int64()), pa.array([crowd], pa.int64()), items, _blob(unnamed), _blob(starts), _blob(ideals), _blob(gain), _blob(bins.codes(x)),
                      _blob(np.zeros(t.num_rows)), none, none, none]
            return pa.RecordBatch.from_arrays([v.cast(kind) for v, kind in zip(values, types)], names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            number = TaskContext.get().partitionId() << 32
            held, n = [], 0

            def emitted(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
                """Runs of whole queries make one chunk, each run of a crowded one a chunk of its own."""
                nonlocal number
                types = [pa.int64(), pa.int64(), pa.list_(t["item"].type), *[pa.binary()] * 9]
                crowded = ~np.isnan(t["crowd"].to_numpy(zero_copy_only=False).astype(float))[starts[:-1]]
                lone = [np.array([i]) for i in np.flatnonzero(crowded)]
                for some in [*lone, *([np.flatnonzero(~crowded)] if (~crowded).any() else [])]:
                    sizes = np.diff(starts)[some]
                    of = t.slice(starts[some[0]], sizes[0]) if len(some) == 1 else t if len(some) == len(crowded) else t.take(
                        pa.array(np.concatenate([np.arange(starts[i], starts[i + 1]) for i in some])))
                    yield chunk(of, np.append(0, np.cumsum(sizes)), number, list(_CHUNK), types)
                    number += 1

            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    n += batch.num_rows
                if n >= chunk_rows:
                    t = pa.Table.from_batches(held)
                    ids = t["run"].to_numpy()
                    starts = np.append(0, np.flatnonzero(ids[1:] != ids[:-1]) + 1)
                    if len(starts) > 1:
                        yield from emitted(t.slice(0, starts[-1]), starts)
                        held, n = t.slice(starts[-1]).to_batches(), n - int(starts[-1])
                    elif t["crowd"][0].as_py() is not None:  # goes on in the next chunk
                        yield from emitted(t, np.array([0, n]))
                        held, n = [], 0
            if n:
                t = pa.Table.from_batches(held)
                ids = t["run"].to_numpy()
                yield from emitted(t, np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [n]]))

        kinds = ["bigint", "bigint", f"array<{self.item_type}>", *["binary"] * 9]
        return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in zip(_CHUNK, kinds)))

    def _best(self, rate: float, tree: Tree | None) -> dict[int, _Crowd]:
        """The crowded queries with their best rows by the score after ``tree``."""
        bins, k = self.bins, self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    raw, gain = _floats(batch, "raw", row), _floats(batch, "gains", row)
                    codes = np.frombuffer(batch.column("codes")[row].as_buffer(), bins.kind).reshape(len(bins.edges), -1)
                    score = rate * (raw + tree.value[bins.leaves(tree, codes)] if tree else raw)
                    # all rows as good as the k-th: which of equals go first is told by their items, across chunks
                    at = np.flatnonzero(score >= np.partition(score, len(score) - min(k, len(score)))[len(score) - min(k, len(score))])
                    items = batch.column("items")[row].values
                    order = np.lexsort((np.arange(len(at)), -score[at]))
                    at = at[order][:k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(c)[row].as_py()] * len(at), pa.int64()) for c in ("crowd", "chunk")]
                        + [pa.array(at), items.take(pa.array(at)), pa.array(score[at]), pa.array(gain[at])], ["crowd", "chunk", "at", "item", "score", "gain"],
                    )

        near = self.table.filter("crowd is not null").select("chunk", "crowd", "items", "gains", "codes", "raw").mapInArrow(
            run, f"crowd bigint, chunk bigint, at bigint, item {self.item_type}, score double, gain double"
        )
        order = Window.partitionBy("crowd").orderBy(F.desc("score"), "item", "chunk", "at")
        found: dict[int, list] = {c: [] for c in self.crowds}
        for r in near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
            "crowd", F.when(F.col("item").isNull(), -1).otherwise(F.col("chunk")).alias("chunk"), "at", "score", "gain", "rank"
        ).collect():  # an unnamed row is in no chunk
            found[r.crowd].append(r)
        out = {}
        for c, rows in found.items():
            rows.sort(key=lambda r: r["rank"])
            out[c] = _Crowd(self.crowds[c].ideal, np.array([r.score for r in rows]), np.array([r.gain for r in rows]), tuple((r.chunk, r["at"]) for r in rows))
        return out

    def advance(self, rate: float, tree: Tree | None) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Adds a tree to the rows' sums and finds their gradients. By chunk: rows, and what is to be added to their gradient and curvature."""
        bins, k = self.bins, self.k
        crowds = self._best(rate, tree) if self.crowds else {}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    one = batch.slice(row, 1)
                    raw, gain = _floats(one, "raw", 0), _floats(one, "gains", 0)
                    if tree:
                        codes = np.frombuffer(one.column("codes")[0].as_buffer(), bins.kind).reshape(len(bins.edges), -1)
                        raw = raw + tree.value[bins.leaves(tree, codes)]
                    starts, crowd = np.frombuffer(one.column("starts")[0].as_buffer(), np.int64), one.column("crowd")[0].as_py()
                    more = np.empty(0)
                    if crowd is None:
                        g, h = _list_gradients(rate * raw, gain, starts, _floats(one, "ideals", 0), np.frombuffer(one.column("unnamed")[0].as_buffer(), np.int64), k)
                    else:
                        known, place = crowds[crowd], np.full(len(raw), len(crowds[crowd].at))
                        for p, (chunk, at) in enumerate(known.at):
                            if chunk == one.column("chunk")[0].as_py():
                                place[at] = p
                        there = np.ones((1, len(known.at)), bool)
                        g, h, more_g, more_h = _pairs(rate * raw, gain, place, starts, known.score[None], known.gain[None], there, np.array([known.ideal]))
                        more = np.concatenate([more_g[0], more_h[0]])
                    new = {"raw": _blob(raw), "gradient": _blob(g), "curvature": _blob(h), "more": _blob(more)}
                    yield pa.RecordBatch.from_arrays([new.get(c, one.column(c)) for c in one.schema.names], one.schema.names)

        last, self.table = self.paths[-1], self._stored(self.table.mapInArrow(run, self.table.schema), "chunks")
        drop_path(self.spark, last)
        added: dict[int, np.ndarray] = {}
        if crowds:
            for r in self.table.filter("crowd is not null").select("crowd", "more").collect():
                added[r.crowd] = added.get(r.crowd, 0.0) + np.frombuffer(r.more, np.float64).reshape(2, -1)
        out: dict[int, list] = {}
        for c, known in crowds.items():
            for p, (chunk, at) in enumerate(known.at):
                out.setdefault(chunk, []).append((at, *added[c][:, p]))
        return {chunk: tuple(np.array(x) for x in zip(*rows)) for chunk, rows in out.items()}

    def sums(self, added: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], tree: Tree, level: int) -> np.ndarray:
        """What ``_histograms`` gives."""
        bins, nodes, dim = self.bins, 1 << level, len(self.bins.edges)
        width = max(map(len, bins.edges), default=0) + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((3, dim, nodes * width))
            for batch in batches:
                for row in range(batch.num_rows):
                    g, h = _floats(batch, "gradient", row), _floats(batch, "curvature", row)
                    if more := added.get(batch.column("chunk")[row].as_py()):
                        g, h = g.copy(), h.copy()
                        g[more[0]] += more[1]
                        h[more[0]] += more[2]
                    codes = np.frombuffer(batch.column("codes")[row].as_buffer(), bins.kind).reshape(dim, -1)
                    node = bins.leaves(tree, codes) - (nodes - 1)
                    if (node < 0).any():
                        here = node >= 0
                        node, g, h, codes = node[here], g[here], h[here], codes[:, here]
                    for f in range(dim):
                        cell = node * width + bins.histogram(f, codes)
                        for i, w in enumerate((g, h, None)):
                            sums[i, f] += np.bincount(cell, w, nodes * width)
            sums = sums.reshape(3, dim, nodes, width).transpose(0, 2, 1, 3).reshape(3, -1)
            cells = np.flatnonzero(sums[2])
            yield pa.RecordBatch.from_arrays([pa.array(cells), *[pa.array(s[cells]) for s in sums]], ["cell", "g", "h", "n"])

        parts = self.table.select("chunk", "codes", "gradient", "curvature").mapInArrow(run, "cell bigint, g double, h double, n double")
        return _added(parts, nodes, dim, width)


def fit(examples: DataFrame, rounds: int, rate: float, depth: int, query: str = "user_id", item: str = "item_id", k: int = CUT, bins: int = BINS,
        chunk_rows: int = CHUNK_ROWS) -> Ranker:
    """A ranker of ``(query, item, relevance, features)`` rows, which are packed into chunks first: pass a written table.

    A round reads the chunks once for its gradients and once per tree level, and writes them to the shared folder, so a lost task
    repeats only its part. The driver holds histograms of at most ``2^depth`` nodes, the trees and the best rows of crowded queries.
    """
    first = examples.select(F.size("features").alias("n")).first()
    model = Ranker(rate)
    if first is None:
        return model
    edges = bin_edges(examples, first.n, bins)
    chunks = _Chunks(examples, edges, query, item, k, chunk_rows)
    for _ in range(rounds):
        added = chunks.advance(rate, model.trees[-1] if model.trees else None)
        model.trees.append(_grown(lambda tree, level: chunks.sums(added, tree, level), edges, depth, SMOOTHING, LEAF_ROWS))
    for path in chunks.paths:
        drop_path(chunks.spark, path)
    return model
