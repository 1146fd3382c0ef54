"""Model fits on Spark ML over tables the log derives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.scalars import ltr_features, relevance_label, sigmoid
from souk.functions.vectors import dot, l2_normalize
from souk.operators import boosting, contrastive, joint
from souk.operators.graph import neighbor_mean
from souk.operators.lookups import user_item_features
from souk.operators.ordered import global_rank
from souk.session import cut_lineage

#: A fitted model: adds its scores to rows.
Scorer = Callable[[DataFrame], DataFrame]

# Boosting rounds, learning rate, depth and embedding width.
ROUNDS, LEARNING_RATE, DEPTH = 30, 0.05, 5
EMBEDDING_DIM = 32


def train_embeddings(events: DataFrame, weight: Column, dim: int = EMBEDDING_DIM, epochs: int = contrastive.EPOCHS,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """User and item unit vectors from the in-batch contrastive loss: two ``(id, embedding)`` tables.

    Ids may be of any type. Events without user or item are left out. Repeated events of a pair are summed before the fit sees them.
    """
    sums = events.filter("user_id is not null and item_id is not null").groupBy("user_id", "item_id")
    pairs = cut_lineage(sums.agg(F.sum(weight.cast("double")).alias("weight")).filter("weight > 0"))
    users, items = contrastive.fit(pairs, dim, epochs, seed=seed)
    return users.select(F.col("user_id").alias("query_id"), F.col("vec").alias("embedding")), items.select("item_id", F.col("vec").alias("embedding"))


def factor_embeddings(events: DataFrame, weight: Column, dim: int = EMBEDDING_DIM, iterations: int = 5, reg: float = 0.1,
                      alpha: float = 1.0, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """User and item unit vectors from implicit-feedback factorisation: two ``(id, embedding)`` tables.

    Ids may be of any type that sorts; they are numbered across tasks for the factorisation, which takes 32-bit numbers.
    Events without user or item are left out. Repeated events of a pair are summed before the factorisation sees them.
    """
    sums = events.filter("user_id is not null and item_id is not null").groupBy("user_id", "item_id")
    pairs = cut_lineage(sums.agg(F.sum(weight.cast("double")).alias("weight")))
    numbers = {c: global_rank(pairs.select(c).distinct(), [], [c], f"_{c}") for c in ("user_id", "item_id")}
    numbered = pairs
    for c, table in numbers.items():
        numbered = numbered.join(table, c)
    als = ALS(rank=dim, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
              userCol="_user_id", itemCol="_item_id", ratingCol="weight")
    model = als.fit(numbered)

    def unit(factors: DataFrame, of: str, name: str) -> DataFrame:
        known = factors.join(numbers[of], factors["id"] == numbers[of][f"_{of}"])
        return known.select(F.col(of).alias(name), l2_normalize(F.col("features")).alias("embedding"))

    return unit(model.userFactors, "user_id", "query_id"), unit(model.itemFactors, "item_id", "item_id")


def _logistic(rows: DataFrame, label: str, iterations: int) -> LogisticRegressionModel:
    """Fit on the array column ``x``; inputs are standardised by the fit itself."""
    vectors = rows.select(F.col(label).cast("double").alias("label"), array_to_vector("x").alias("features"))
    return LogisticRegression(maxIter=iterations, regParam=1e-3, standardization=True).fit(vectors)


def _probability(model: LogisticRegressionModel, x: Column) -> Column:
    """The model as a Column expression: scoring needs no vector conversion and no model object in tasks."""
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients])
    return sigmoid(dot(x, weights) + F.lit(float(model.intercept)))


CTR_INPUTS = ("user_view_count", "user_purchase_count", "user_conversion_rate", "base_price", "popularity")


def ranker_examples(events: DataFrame, users: DataFrame, items: DataFrame, clicked: Column, converted: Column) -> DataFrame:
    """One row per (user, item) seen in the log, with both labels and the ranking inputs."""
    seen = events.groupBy("user_id", "item_id").agg(
        F.max(clicked.cast("double")).alias("ctr_label"), F.max(converted.cast("double")).alias("cvr_label")
    )
    return user_item_features(seen, users, items)


def fit_ctr_cvr(examples: DataFrame, inputs: tuple[str, ...] = CTR_INPUTS, iterations: int = 40,
                names: tuple[str, str] = ("ctr_pred", "cvr_pred")) -> Scorer:
    """A scorer that adds click and conversion probabilities to any rows with the input columns, seen or not.

    One model for both (see ``joint.TwoTasks``), fitted together on the click loss plus half the conversion loss. The fit reads
    ``examples`` once per step, so pass a written table.
    """
    model = joint.fit_two_tasks(examples, inputs, ("ctr_label", "cvr_label"), iterations)
    return lambda rows: rows.withColumns(model.score([F.col(c) for c in inputs], names))


def fit_heads(examples: DataFrame, inputs: tuple[str, ...] = CTR_INPUTS, iterations: int = 25,
              names: tuple[str, str] = ("ctr_pred", "cvr_pred")) -> Scorer:
    """A scorer like that of ``fit_ctr_cvr`` from two models that share nothing but their inputs.

    Two logistic heads over shared inputs, standardised as in the examples, and their user x item products. The fit
    reads ``examples`` several times, so pass a written table; the scorer is plain Column arithmetic.
    """
    raw = examples.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in inputs])).alias("raw"))
    scaler = StandardScaler(inputCol="raw", outputCol="x").fit(raw)
    plain = {
        c: (F.col(c).cast("double") - float(mean)) * (1.0 / float(spread) if spread > 0 else 0.0)
        for c, mean, spread in zip(inputs, scaler.mean, scaler.std)
    }
    of_user = [v for c, v in plain.items() if c.startswith("user")]
    of_item = [v for c, v in plain.items() if not c.startswith("user")]
    x = F.array(*plain.values(), *[u * i for u in of_user for i in of_item])
    shared = examples.withColumn("x", x)
    heads = [_logistic(shared, label, iterations) for label in ("ctr_label", "cvr_label")]
    return lambda rows: rows.withColumns({name: _probability(head, x) for name, head in zip(names, heads)})


def train_ctr_cvr(examples: DataFrame, inputs: tuple[str, ...] = CTR_INPUTS, iterations: int = 40) -> DataFrame:
    """``examples`` with the ``ctr_pred`` and ``cvr_pred`` of the model that they teach."""
    examples = cut_lineage(examples)
    return fit_ctr_cvr(examples, inputs, iterations)(examples)


def with_ltr_features(rows: DataFrame) -> DataFrame:
    """Adds the ten ranking ``features`` to rows with the ranking inputs."""
    return rows.withColumn("features", ltr_features(*[F.col(c) for c in CTR_INPUTS]))


def ltr_examples(events: DataFrame, users: DataFrame, items: DataFrame, grades: dict[str, int]) -> DataFrame:
    """One row per (user, item) with its best grade and the ten ranking features."""
    seen = events.groupBy("user_id", "item_id").agg(F.max(relevance_label(F.col("event_type"), grades)).alias("relevance"))
    inputs = with_ltr_features(user_item_features(seen, users, items))
    return inputs.select("user_id", "item_id", "relevance", "features")


def fit_ltr(examples: DataFrame, rounds: int = ROUNDS, rate: float = LEARNING_RATE, depth: int = DEPTH) -> Scorer:
    """A scorer that adds ``ltr_score`` to rows with ``features``: trees boosted on each user's list, for the best NDCG at ten.

    The fit reads ``examples`` for bin edges, list sizes and its chunks, so pass a written table.
    """
    model = boosting.fit(examples, rounds, rate, depth)
    return lambda rows: rows.withColumn("ltr_score", model.score("features"))


def fit_grades(examples: DataFrame, rounds: int = ROUNDS, rate: float = LEARNING_RATE, depth: int = DEPTH, seed: int = 42) -> Scorer:
    """A scorer like that of ``fit_ltr`` whose trees predict each row's grade by itself, without regard to its list."""
    model = GBTRegressor(featuresCol="x", labelCol="relevance", predictionCol="ltr_score", maxIter=rounds,
                         stepSize=rate, maxDepth=depth, seed=seed).fit(examples.withColumn("x", array_to_vector("features")))
    return lambda rows: model.transform(rows.withColumn("x", array_to_vector("features"))).drop("x")


def train_ltr(examples: DataFrame, rounds: int = ROUNDS, rate: float = LEARNING_RATE, depth: int = DEPTH) -> DataFrame:
    """``examples`` with the ``ltr_score`` of the model that they teach."""
    examples = cut_lineage(examples)
    return fit_ltr(examples, rounds, rate, depth)(examples)


def graph_score(nodes: DataFrame, edges: DataFrame, dim: int, iterations: int = 40, node: str = "node_id",
                features: str = "features", label: str = "label") -> DataFrame:
    """``(node, graph_risk)``: probability from one hidden layer over a node's own features beside its neighbours' mean over ``edges``."""
    return neighborhood_score(neighbor_mean(nodes, edges, dim, node, features), iterations, node, features, label)


def neighborhood_score(both: DataFrame, iterations: int = 40, node: str = "node_id", features: str = "features",
                       label: str = "label") -> DataFrame:
    """``graph_score`` of nodes that already have their ``neighbor_mean``, for instance from ``shared_attr_mean``."""
    rows = cut_lineage(both.select(node, F.col(label).alias("label"), F.concat(features, "neighbor_mean").alias("x")))
    model = joint.fit_neighbourhood(rows, iterations)
    return rows.select(node, (model.score(F.col("x")) if model else F.lit(None).cast("double")).alias("graph_risk"))


def linear_neighborhood_score(both: DataFrame, iterations: int = 25, node: str = "node_id", features: str = "features",
                              label: str = "label") -> DataFrame:
    """Like ``neighborhood_score`` without the hidden layer: a logistic model of the same inputs."""
    rows = cut_lineage(both.select(node, label, F.concat(features, "neighbor_mean").alias("x")))
    return rows.select(node, _probability(_logistic(rows, label, iterations), F.col("x")).alias("graph_risk"))
