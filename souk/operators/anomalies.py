"""Per-row anomaly scores: linear reconstruction error and an isolation forest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.vectors import dot

# Latent size, forest size and sample size per tree.
LATENT = 3
TREES = 100
SAMPLE = 256
EULER = 0.5772156649015329


def recon_error(nodes: DataFrame, latent: int = LATENT, node: str = "node_id", features: str = "features") -> DataFrame:
    """``(node, recon_error)``: mean squared error per row after projection on ``latent`` components.

    Features are standardised first. The components are orthonormal, so the error is what the projection
    leaves of the squared length: (|x|² - |z|²) / d. Only the covariance leaves the tasks.
    """
    vectors = nodes.select(node, array_to_vector(features).alias("raw"))
    scaler = StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=True).fit(vectors)
    scaled = scaler.transform(vectors)
    projected = PCA(k=latent, inputCol="x", outputCol="z").fit(scaled).transform(scaled)
    x, z = vector_to_array("x"), vector_to_array("z")
    arrays = projected.select(node, x.alias("x"), z.alias("z"))
    left = (dot(F.col("x"), F.col("x")) - dot(F.col("z"), F.col("z"))) / F.size("x")
    return arrays.select(node, F.greatest(left, F.lit(0.0)).alias("recon_error"))


def average_depth(n):
    """Expected depth of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        depth = 2 * (np.log(n - 1) + EULER) - 2 * (n - 1) / n
    return np.where(n > 2, depth, np.where(n == 2, 1.0, 0.0))


TREE_SCHEMA = "tree int, node int, feature int, split double, low int, high int, depth double, size int"


def _grow(tree: int, rows: np.ndarray, seed: int) -> list[tuple]:
    """Nodes of one isolation tree; leaves hold their expected depth and feature -1."""
    draw = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(rows), 2))))
    nodes, open_ = [], [(0, rows, 0)]
    count = 1
    while open_:
        number, part, depth = open_.pop()
        spans = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(rows.shape[1])
        usable = np.flatnonzero(spans > 0)
        if depth >= limit or len(part) <= 1 or not len(usable):
            nodes.append((tree, number, -1, 0.0, -1, -1, float(depth + average_depth(len(part))), len(part)))
            continue
        feature = int(draw.choice(usable))
        low, high = part[:, feature].min(), part[:, feature].max()
        split = float(draw.uniform(low, high))
        below = part[:, feature] <= split
        nodes.append((tree, number, feature, split, count, count + 1, float(depth), len(part)))
        open_ += [(count, part[below], depth + 1), (count + 1, part[~below], depth + 1)]
        count += 2
    return nodes


def forest_sample(nodes: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 42, node: str = "node_id",
                  features: str = "features") -> DataFrame:
    """``sample`` rows for each tree, chosen by hash rank so that partitioning cannot change them.

    Every tree draws from all nodes by hashes of its own. Only hashes below a threshold that lets about twice the
    sample through are kept before rows multiply, so the work per tree is bounded and no node is out of reach.
    """
    share = min(1.0, (2 * sample + 64) / max(1, nodes.count()))

    def code(tree):
        return F.xxhash64(F.lit(seed), tree, F.col(node))

    every = F.sequence(F.lit(0), F.lit(trees - 1))
    passing = F.filter(every, lambda t: F.pmod(code(t), F.lit(1 << 40)) < int(share * (1 << 40)))
    drawn = nodes.select(node, F.explode(passing).alias("tree"))
    order = Window.partitionBy("tree").orderBy(F.pmod(code(F.col("tree")), F.lit(1 << 40)), node)
    kept = drawn.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample).select("tree", node)
    return nodes.select(node, features).join(kept, node)


def isolation_forest(nodes: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 42, node: str = "node_id",
                     features: str = "features") -> DataFrame:
    """``(node, isolation)`` in (0, 1]; larger means easier to isolate.

    Trees grow in parallel from at most ``sample`` rows each. The forest, at most 2 * trees * sample small
    rows whatever the input size, is what scoring tasks receive.
    """
    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        rows = np.stack(group.sort_values(node)[features].to_numpy()).astype(float)
        return pd.DataFrame(_grow(tree, rows, seed), columns=[f.split()[0] for f in TREE_SCHEMA.split(", ")])

    # a few trees per task: the sample is small in bytes but not in work
    drawn = forest_sample(nodes, trees, sample, seed, node, features).repartition(max(1, trees // 4), "tree")
    grown = drawn.groupBy("tree").applyInPandas(grow, TREE_SCHEMA)
    forest = grown.toPandas().sort_values(["tree", "node"])
    plans = [part[["feature", "split", "low", "high", "depth"]].to_numpy().T for _, part in forest.groupby("tree")]
    shared = nodes.sparkSession.sparkContext.broadcast(plans)
    norm = max(float(average_depth(forest["size"].max())), 1.0)  # the largest node is a root: the sample size

    @F.pandas_udf(T.DoubleType())
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=float)
        x = np.stack(vectors.to_numpy()).astype(float)
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, split, low, high, depth in shared.value:
            at = np.zeros(len(x), int)
            while True:
                used = feature[at].astype(int)
                inner = used >= 0
                if not inner.any():
                    break
                below = x[every, np.maximum(used, 0)] <= split[at]
                at = np.where(inner, np.where(below, low[at], high[at]).astype(int), at)
            total += depth[at]
        return pd.Series(2.0 ** (-total / len(shared.value) / norm))

    return nodes.select(node, score(features).alias("isolation"))
