"""Model fits over the stored tables. Closed forms are checked by SQL; iterative fits by tests with a known answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from souk.functions import scalars as S
from souk.functions import vectors as V
from souk.operators import anomalies, boosting, evaluation, graph, models, retrieval, series
from souk.plans import fraud
from souk.queries.features import INTERACTIONS, items_of, users_of
from souk.queries.operations import NODES
from souk.queries.ranking import _SCORED, CANDIDATES
from souk.session import cut_lineage
from souk.sources import adapters as A

FEATURES = len(A.NODE_FEATURES)


def _embeddings(spark, d):
    return models.train_embeddings(A.interactions(spark, d), S.relevance_label(F.col("event_type"), A.STORED_RELEVANCE))


def train_embeddings(spark, d):
    return retrieval.knn_lists(*_embeddings(spark, d), 10)


def embedding_ids(spark, d):
    """Who has a trained vector: every user and item of the log, with unit vectors of the stated width."""
    users, items = _embeddings(spark, d)
    both = users.select(F.lit("user").alias("side"), F.col("query_id").alias("id"), "embedding").union(items.select(F.lit("item"), "item_id", "embedding"))
    return both.select("side", "id", F.size("embedding").alias("dim"), F.round(V.l2_norm(F.col("embedding")), 6).alias("norm"))


def _ranker_examples(spark, d):
    return models.ranker_examples(
        A.interactions(spark, d), users_of(spark, d), items_of(spark, d),
        F.col("event_type") == "click", F.col("event_type") == "purchase",
    )


def train_ctr_cvr(spark, d):
    return models.train_ctr_cvr(_ranker_examples(spark, d)).select("user_id", "item_id", "ctr_label", "cvr_label", "ctr_pred", "cvr_pred")


def ranker_optimum(spark, d):
    """What the fitted heads promise: predicted and true labels have the same sums, alone and times every input."""
    scored = models.train_ctr_cvr(_ranker_examples(spark, d))
    sums = [
        F.struct(F.lit(head).alias("head"), F.lit(c).alias("input"), F.sum(F.col(f"{head}_pred") * (F.lit(1.0) if c == "one" else F.col(c).cast("double"))).alias("total"))
        for head in ("ctr", "cvr") for c in ("one", *models.CTR_INPUTS)
    ]
    return scored.agg(F.array(*sums).alias("s")).select(F.inline("s")).withColumn("total", F.round("total", 2))


def ranker_loss(spark, d):
    return evaluation.bce_joint_loss(train_ctr_cvr(spark, d))


def _ltr_examples(spark, d):
    return models.ltr_examples(A.interactions(spark, d), users_of(spark, d), items_of(spark, d), A.STORED_RELEVANCE)


def train_ltr(spark, d):
    return models.train_ltr(_ltr_examples(spark, d)).select("user_id", "item_id", "relevance", "ltr_score")


def ltr_gradient(spark, d):
    """What one round of the list ranker learns from, at the scores of the fixed linear ranker."""
    x = F.col("features")
    scored = _ltr_examples(spark, d).withColumn("score", F.round(S.ltr_linear_score(x[4], x[2], x[3]), 6))
    found = boosting.lambdas(cut_lineage(scored), boosting.ideal(scored, "user_id"))
    return found.select("user_id", "item_id", *[(F.round(c, 6) + 0.0).alias(c) for c in ("gradient", "curvature")])


def forecast_basis(spark, d):
    return series.forecast_basis(A.monthly_brand_sales(spark, d)).withColumn("y_hat", F.round("y_hat", 3))


def graph_score(spark, d):
    return models.neighborhood_score(graph.shared_attr_mean(A.customer_nodes(spark, d), A.customer_parts(spark, d), FEATURES))


def recon_error(spark, d):
    return anomalies.recon_error(A.customer_nodes(spark, d)).withColumn("recon_error", F.round("recon_error", 6))


def isolation_forest(spark, d):
    return anomalies.isolation_forest(A.customer_nodes(spark, d))


def fraud_ensemble(spark, d):
    return fraud.fraud_ensemble(A.customer_nodes(spark, d), A.customer_parts(spark, d), FEATURES, shared=True)


QUERIES = {
    f.__name__: f
    for f in (
        train_embeddings, embedding_ids, train_ctr_cvr, ranker_optimum, ranker_loss, train_ltr, ltr_gradient, forecast_basis, graph_score, recon_error, isolation_forest,
        fraud_ensemble,
    )
}


def _basis_sql(step: str) -> list[str]:
    waves = [f"{fn}({step} * {h} * 2 * pi() / {S.SEASON_PERIOD})" for h in (1, 2) for fn in ("cos", "sin")]
    return ["1.0", f"{step}", f"{step} * {step}", *waves]


def _forecast_sql() -> str:
    """Gauss-Jordan elimination of each series' ridge system, one common table per column."""
    p, past = 7, series.BACKCAST
    cells = [(i, j) for i in range(p) for j in range(p + 1)]
    x = ", ".join(f"{term} AS x{i}" for i, term in enumerate(_basis_sql("s")))
    sums = ", ".join(
        f"sum(x{i} * y) AS a{i}_{j}" if j == p else f"sum(x{i} * x{j}){' + 1e-6' if i == j else ''} AS a{i}_{j}" for i, j in cells
    )
    steps = []
    for k in range(p):
        new = ", ".join(
            f"a{k}_{j} / a{k}_{k} AS a{k}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}" for i, j in cells
        )
        steps.append(f"m{k + 1} AS (SELECT series_id, last, {new} FROM m{k})")
    y_hat = " + ".join(f"a{i}_{p} * ({term})" for i, term in enumerate(_basis_sql(f"CAST(h + {past - 1} AS DOUBLE)")))
    return f"""WITH q AS (SELECT p_brand AS series_id, (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS t, CAST(sum(l_quantity) AS DOUBLE) AS y
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
      l AS (SELECT series_id, max(t) AS last FROM q GROUP BY 1),
      x AS (SELECT q.series_id, last, y, CAST(t - last + {past - 1} AS DOUBLE) AS s FROM q JOIN l ON q.series_id = l.series_id WHERE t - last + {past - 1} >= 0),
      b AS (SELECT series_id, last, y, {x} FROM x), m0 AS (SELECT series_id, last, {sums} FROM b GROUP BY 1, 2), {", ".join(steps)},
      f AS (SELECT *, unnest(range(1, {series.FORECAST + 1})) AS h FROM m{p})
      SELECT series_id, CAST(last + h AS INTEGER) AS t, round({y_hat}, 3) AS y_hat FROM f"""


def _recon_sql(squarings: int = 16) -> str:
    """Projectors on the leading components: a matrix squared again and again tends to that on its first one."""
    def scaled(name: str, of: str) -> str:
        return f"{name} AS MATERIALIZED (SELECT i, j, v / sum(v) FILTER (i = j) OVER () AS v FROM ({of}))"

    parts = []
    for r in range(anomalies.LATENT):
        parts.append(scaled(f"p{r}_0", f"SELECT * FROM c{r}"))
        for k in range(squarings):
            last = f"p{r}_{k}"
            parts.append(scaled(f"p{r}_{k + 1}", f"SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY 1, 2"))
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.i, c.j, c.v - p.v * sum(c.v * p.v) OVER () AS v FROM c{r} c JOIN p{r}_{squarings} p ON c.i = p.i AND c.j = p.j)")
    projector = " UNION ALL ".join(f"SELECT * FROM p{r}_{squarings}" for r in range(anomalies.LATENT))
    return f"""WITH {NODES}, x AS (SELECT node_id, unnest([{", ".join(A.NODE_FEATURES)}]) AS v, unnest(range({FEATURES})) AS i FROM nodes),
      s AS (SELECT i, avg(v) AS mean, stddev_samp(v) AS spread FROM x GROUP BY 1),
      z AS MATERIALIZED (SELECT node_id, x.i, coalesce((v - mean) / nullif(spread, 0), 0) AS v FROM x JOIN s ON x.i = s.i),
      c0 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM z a JOIN z b ON a.node_id = b.node_id GROUP BY 1, 2), {", ".join(parts)},
      q AS (SELECT i, j, sum(v) AS v FROM ({projector}) GROUP BY 1, 2),
      w AS (SELECT a.node_id, sum(a.v * q.v * b.v) AS kept FROM z a JOIN q ON a.i = q.i JOIN z b ON a.node_id = b.node_id AND b.i = q.j GROUP BY 1),
      n AS (SELECT node_id, sum(v * v) AS whole FROM z GROUP BY 1)
      SELECT n.node_id, round(greatest((whole - kept) / {FEATURES}, 0), 6) AS recon_error FROM n JOIN w ON n.node_id = w.node_id"""


def _lambda_sql(k: int = boosting.CUT) -> str:
    """All pairs of a user's rows, one of them among the best ``k``."""
    grade = " ".join(f"WHEN '{name}' THEN {value}" for name, value in A.STORED_RELEVANCE.items())
    return f"""WITH {CANDIDATES}, g AS (SELECT user_id, item_id, max(CASE event_type {grade} ELSE {S.RELEVANCE_OTHER} END) AS relevance FROM interactions GROUP BY 1, 2),
      e AS (SELECT c.user_id, c.item_id, pow(2, relevance) - 1 AS gain, round(pop * 0.1 + cvr_u * 2.0 - price * 0.001, 6) AS score
        FROM candidates c JOIN g ON c.user_id = g.user_id AND c.item_id = g.item_id),
      r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank, row_number() OVER (PARTITION BY user_id ORDER BY gain DESC) AS best FROM e),
      d AS (SELECT *, CASE WHEN rank <= {k} THEN 1 / log2(rank + 1) ELSE 0 END AS disc, sum(CASE WHEN best <= {k} THEN gain / log2(best + 1) ELSE 0 END) OVER (PARTITION BY user_id) AS ideal FROM r),
      p AS (SELECT a.user_id, a.item_id, sign(a.gain - b.gain) AS s, abs(a.gain - b.gain) * abs(a.disc - b.disc) / a.ideal AS swap,
          1 / (1 + exp(sign(a.gain - b.gain) * (a.score - b.score))) AS rho
        FROM d a JOIN d b ON a.user_id = b.user_id AND a.gain <> b.gain AND least(a.rank, b.rank) <= {k}),
      t AS (SELECT user_id, item_id, sum(-s * swap * rho) AS g, sum(swap * rho * (1 - rho)) AS h FROM p GROUP BY 1, 2)
      SELECT e.user_id, e.item_id, round(coalesce(g, 0.0), 6) + 0.0 AS gradient, round(coalesce(h, 0.0), 6) + 0.0 AS curvature
      FROM e LEFT JOIN t ON e.user_id = t.user_id AND e.item_id = t.item_id"""


def _optimum_sql() -> str:
    names = dict(zip(("one", *models.CTR_INPUTS), ("1", "uv", "up", "cvr_u", "price", "pop")))
    parts = [f"SELECT '{head}' AS head, '{name}' AS input, round(sum({y} * {column})::DOUBLE, 2) AS total FROM scored"
             for head, y in (("ctr", "y1"), ("cvr", "y2")) for name, column in names.items()]
    return f"WITH {_SCORED} {' UNION ALL '.join(parts)}"


_IDS_SQL = f"""WITH {INTERACTIONS}, s AS (SELECT DISTINCT user_id, item_id FROM interactions WHERE user_id IS NOT NULL AND item_id IS NOT NULL)
      SELECT 'user' AS side, user_id AS id, {models.EMBEDDING_DIM}::INTEGER AS dim, 1.0::DOUBLE AS norm FROM s GROUP BY user_id
      UNION ALL SELECT 'item', item_id, {models.EMBEDDING_DIM}::INTEGER, 1.0::DOUBLE FROM s GROUP BY item_id"""

ORACLE = {"embedding_ids": _IDS_SQL, "ranker_optimum": _optimum_sql(), "ltr_gradient": _lambda_sql(), "forecast_basis": _forecast_sql(), "recon_error": _recon_sql()}
