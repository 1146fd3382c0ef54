"""Queries over retrieval, ranking, interleaving and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import scalars as S
from souk.functions import vectors as V
from souk.operators import evaluation, interleaving, lookups, models, ranking, retrieval
from souk.plans import serving
from souk.queries.features import INTERACTIONS, ITEMS, USERS, items_of, users_of
from souk.session import cut_lineage, scratch_path
from souk.sources import adapters as A
from souk.sources import vector_table


def _r(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _vectors(spark, d, name: str) -> DataFrame:
    return A.table(spark, d, "embeddings").select(F.col("vec_id").alias(name), "embedding")


def _user_vectors(spark, d) -> DataFrame:
    users = A.table(spark, d, "events").select("user_id").distinct()
    return _vectors(spark, d, "user_id").join(users, "user_id", "left_semi")


def _seen_pairs(spark, d) -> DataFrame:
    return A.interactions(spark, d).select("user_id", "item_id").distinct()


def _candidates(spark, d) -> DataFrame:
    return lookups.user_item_features(_seen_pairs(spark, d), users_of(spark, d), items_of(spark, d))


def l2_normalize(spark, d):
    scaled = A.table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * F.col("label")).alias("v")
    )
    return scaled.select("vec_id", F.posexplode(V.l2_normalize(F.col("v"))).alias("pos", "x")).withColumn("x", F.round("x", 6))


def vector_table_write(spark, d):
    path = scratch_path(spark, "vectors")
    vector_table.write_vectors(_vectors(spark, d, "item_id"), path)
    back = vector_table.read_vectors(spark, path)
    return back.select("item_id", F.size("embedding").alias("dim"), F.round(V.l2_norm(F.col("embedding")), 5).alias("norm"))


def knn_cosine(spark, d):
    return _r(retrieval.knn_cosine(_vectors(spark, d, "query_id"), _vectors(spark, d, "item_id"), 10), 6, "score")


def knn_lsh(spark, d):
    """Approximate neighbours of every vector; the index is inverted lists, whatever the row's name says."""
    return _r(retrieval.knn_lists(_vectors(spark, d, "query_id"), _vectors(spark, d, "item_id"), 10), 6, "score")


def topk_per_query(spark, d):
    rows = A.interactions(spark, d).select(F.col("user_id").alias("query_id"), F.col("event_id").alias("item_id"), F.col("price").alias("score"))
    return retrieval.topk_per_query(rows, 5)


def ctr_cvr_score(spark, d):
    ctr, cvr = S.ctr_cvr_score(F.col("popularity"), F.col("base_price"), F.col("user_conversion_rate"))
    return _candidates(spark, d).select("user_id", "item_id", F.round(ctr, 6).alias("ctr"), F.round(cvr, 6).alias("cvr"))


def rank_by_ctr(spark, d):
    return ranking.rank_by_ctr(_candidates(spark, d)).select("user_id", "rank", "item_id", F.round("ctr", 6).alias("ctr"))


def ltr_features(spark, d):
    x = S.ltr_features(*[F.col(c) for c in ("user_view_count", "user_purchase_count", "user_conversion_rate", "base_price", "popularity")])
    rows = _candidates(spark, d).select("user_id", "item_id", F.posexplode(x).alias("pos", "x"))
    return rows.withColumn("x", F.round("x", 6))


def ltr_linear_score(spark, d):
    score = S.ltr_linear_score(F.col("popularity"), F.col("user_conversion_rate"), F.col("base_price"))
    return _candidates(spark, d).select("user_id", "item_id", F.round(score, 6).alias("ltr_score"))


def rank_by_ltr(spark, d):
    return ranking.rank_by_ltr(_candidates(spark, d)).select("user_id", "rank", "item_id", F.round("ltr_score", 6).alias("ltr_score"))


def cap_per_category(spark, d):
    scored = ranking.score_ltr(_candidates(spark, d)).select("user_id", "item_id", "category", "ltr_score")
    return ranking.cap_per_category(scored, 2, F.desc("ltr_score"), F.asc("item_id")).select("user_id", "item_id", "category", "rank")


def batch_recommend(spark, d):
    out = serving.batch_recommend(_user_vectors(spark, d), _vectors(spark, d, "item_id"), users_of(spark, d), items_of(spark, d))
    return _r(out, 6, "ctr", "cvr")


def recommend_trained(spark, d):
    """Every user's candidates from the inverted lists, most of them never seen, ordered by a ranker fitted on the log."""
    users, items = users_of(spark, d), items_of(spark, d)
    seen = models.ranker_examples(A.interactions(spark, d), users, items, F.col("event_type") == "click", F.col("event_type") == "purchase")
    score = models.fit_ctr_cvr(cut_lineage(seen), names=("ctr", "cvr"))
    return serving.batch_recommend(_user_vectors(spark, d), _vectors(spark, d, "item_id"), users, items, score=score, nearest=retrieval.knn_lists)


def batch_search(spark, d):
    out = serving.batch_search(_user_vectors(spark, d), _vectors(spark, d, "item_id"), users_of(spark, d), items_of(spark, d))
    return _r(out, 6, "ltr_score")


def relevance_label(spark, d):
    plain = S.relevance_label(F.col("event_type")).alias("relevance")
    graded = S.relevance_label(F.col("event_type"), A.STORED_RELEVANCE).alias("stored_relevance")
    return A.table(spark, d, "events").select("event_id", plain, graded)


def hash_bucket(spark, d):
    buckets = [S.hash_bucket_md5(F.col("user_id"), n).alias(f"user_{n}") for n in (500, 20, 5)]
    buckets += [S.hash_bucket_md5(A.item_of(F.col("props")), n).alias(f"item_{n}") for n in (1000, 15, 100)]
    return A.table(spark, d, "events").select("event_id", *buckets)


def dedup_first(spark, d):
    lists = A.interactions(spark, d).select("user_id", "item_id", "event_id", "event_type")
    return ranking.dedup_first(lists, "user_id", "item_id", "event_id")


def _request_lists(spark, d):
    """Per user, the top ten items by spend and the top ten by number of events."""
    stats = A.interactions(spark, d).groupBy("user_id", "item_id").agg(
        F.round(F.sum("price"), 4).alias("spend"), F.count(F.lit(1)).alias("hits")
    )

    def top(score: str, name: str) -> DataFrame:
        rows = retrieval.topk_per_query(stats.withColumnRenamed("user_id", "request_id"), 10, "request_id", "item_id", score)
        return interleaving.ranked_list(rows, "request_id", "item_id", "rank", name)

    return top("spend", "list_a"), top("hits", "list_b")


def team_draft_interleave(spark, d):
    return interleaving.team_draft_interleave(*_request_lists(spark, d), max_size=12)


def click_attribution(spark, d):
    clicks = A.interactions(spark, d).filter(F.col("event_type") == "click").select(F.col("user_id").alias("request_id"), "item_id")
    return interleaving.click_attribution(clicks, team_draft_interleave(spark, d))


def info_nce(spark, d):
    e = A.table(spark, d, "embeddings").withColumn("pair_id", F.floor(F.col("vec_id") / 2))
    first = e.filter(F.col("vec_id") % 2 == 0).select("pair_id", F.col("embedding").alias("user_vec"))
    second = e.filter(F.col("vec_id") % 2 == 1).select("pair_id", F.col("embedding").alias("item_vec"))
    pairs = first.join(second, "pair_id").withColumn("batch_id", F.floor(F.col("pair_id") / 64))
    return _r(evaluation.info_nce(pairs), 6, "info_nce")


def _scored(spark, d) -> DataFrame:
    """Scored (user, item) pairs with click and purchase labels; scores are stored with nine decimals."""
    labels = A.interactions(spark, d).groupBy("user_id", "item_id").agg(
        F.max((F.col("event_type") == "click").cast("double")).alias("ctr_label"),
        F.max((F.col("event_type") == "purchase").cast("double")).alias("cvr_label"),
    )
    full = lookups.user_item_features(labels, users_of(spark, d), items_of(spark, d))
    ctr, cvr = S.ctr_cvr_score(F.col("popularity"), F.col("base_price"), F.col("user_conversion_rate"))
    return full.withColumns({"ctr_pred": F.round(ctr, 9), "cvr_pred": F.round(cvr, 9)})


def bce_joint_loss(spark, d):
    return _r(evaluation.bce_joint_loss(_scored(spark, d)), 6, "ctr_loss", "cvr_loss", "joint_loss")


def champion_challenger(spark, d):
    rows = _scored(spark, d)
    old, new = F.col("ctr_pred"), F.col("cvr_pred")
    both = rows.select(F.col("cvr_label").alias("label"), F.inline(F.array(
        F.struct(F.lit("ctr").alias("model"), old.alias("score")), F.struct(F.lit("cvr").alias("model"), new.alias("score"))
    )))
    return _r(evaluation.champion_challenger(both, "ctr", "cvr"), 6, "champion_auc", "challenger_auc")


def ranking_metrics(spark, d):
    scored = ranking.score_ltr(_candidates(spark, d)).select(F.col("user_id").alias("query_id"), "item_id", "ltr_score")
    ranked = retrieval.topk_per_query(scored, 10, score="ltr_score")
    grade = F.when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "click", 2).when(F.col("event_type") == "view", 1).otherwise(0)
    truth = A.interactions(spark, d).groupBy(F.col("user_id").alias("query_id"), "item_id").agg(F.max(grade).alias("relevance"))
    return _r(evaluation.ranking_metrics(ranked, truth, 10), 6, "recall", "ndcg")


def assign_variant(spark, d):
    users = A.table(spark, d, "events").select("user_id").distinct()
    weights = {"control": 0.475, "treatment": 0.475, "holdout": 0.05}
    return users.select("user_id", S.assign_variant(F.col("user_id"), "ranker", weights).alias("variant"))


QUERIES = {
    f.__name__: f
    for f in (
        l2_normalize, vector_table_write, knn_cosine, knn_lsh, topk_per_query, ctr_cvr_score, rank_by_ctr, ltr_features,
        ltr_linear_score, rank_by_ltr, cap_per_category, batch_recommend, recommend_trained, batch_search, relevance_label, hash_bucket, dedup_first,
        team_draft_interleave, click_attribution, info_nce, bce_joint_loss, champion_challenger, ranking_metrics, assign_variant,
    )
}

CANDIDATES = f"""{INTERACTIONS}, {USERS}, {ITEMS}, candidates AS (
  SELECT p.user_id, p.item_id, user_view_count AS uv, user_purchase_count AS up, user_conversion_rate AS cvr_u, category, base_price AS price, popularity AS pop
  FROM (SELECT DISTINCT user_id, item_id FROM interactions) p JOIN users u ON p.user_id = u.user_id JOIN items i ON p.item_id = i.item_id)"""
_RAW = "(0.3 * ln(pop + 1) - 0.001 * price + 0.5)"
_CTR = f"(1 / (1 + exp(-{_RAW})))"
_CVR = f"(1 / (1 + exp(-({_RAW} * (0.1 + 2 * cvr_u)))))"
_LTR = "(pop * 0.1 + cvr_u * 2.0 - price * 0.001)"
_SCORED = f"""{CANDIDATES}, labels_ AS (SELECT user_id, item_id, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS y1,
      max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS y2 FROM interactions GROUP BY 1, 2),
      scored AS (SELECT c.*, y1, y2, round({_CTR}, 9) AS p1, round({_CVR}, 9) AS p2 FROM candidates c JOIN labels_ l ON c.user_id = l.user_id AND c.item_id = l.item_id)"""


def _nearest(k: int) -> str:
    """CTEs to ``near``: the k nearest embeddings of every user that has a vector."""
    return f"""q AS (SELECT vec_id AS user_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IN (SELECT user_id FROM events)),
      x AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
      s AS (SELECT user_id, item_id, round(list_cosine_similarity(q.v, x.v), 9) AS sim FROM q, x),
      near AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, item_id) AS r FROM s) WHERE r <= {k}),
      full_ AS (SELECT n.user_id, n.item_id, coalesce(user_conversion_rate, 0.0) AS cvr_u, coalesce(base_price, 0.0) AS price, coalesce(popularity, 0) AS pop
        FROM near n LEFT JOIN users u ON n.user_id = u.user_id LEFT JOIN items i ON n.item_id = i.item_id)"""


_LISTS = f"""{INTERACTIONS}, st AS (SELECT user_id, item_id, round(sum(price), 4) AS spend, count(*) AS hits FROM interactions GROUP BY 1, 2),
      a AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY spend DESC, item_id) AS r FROM st) WHERE r <= 10),
      b AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY hits DESC, item_id) AS r FROM st) WHERE r <= 10),
      n AS (SELECT user_id, max(na) AS na, max(nb) AS nb FROM (SELECT user_id, count(*) AS na, 0 AS nb FROM a GROUP BY 1 UNION ALL SELECT user_id, 0, count(*) FROM b GROUP BY 1) GROUP BY 1),
      steps AS (SELECT user_id, na, nb, unnest(range(1, na + nb + 1)) AS s FROM n),
      coins AS (SELECT *, CAST('0x' || substr(md5(user_id || '-' || s), 1, 8) AS BIGINT) % 2 AS coin FROM steps),
      runs AS (SELECT *, greatest(least(sum(coin) OVER (PARTITION BY user_id ORDER BY s), na), s - nb) AS taken FROM coins),
      turn AS (SELECT *, taken > coalesce(lag(taken) OVER (PARTITION BY user_id ORDER BY s), 0) AS from_a FROM runs),
      drawn AS (SELECT t.user_id, s, coalesce(a.item_id, b.item_id) AS item_id, CASE WHEN from_a THEN 'model_A' ELSE 'model_B' END AS model
        FROM turn t LEFT JOIN a ON from_a AND a.user_id = t.user_id AND a.r = taken LEFT JOIN b ON NOT from_a AND b.user_id = t.user_id AND b.r = s - taken),
      once AS (SELECT user_id, item_id, min(s) AS s, arg_min(model, s) AS model FROM drawn GROUP BY 1, 2),
      feed AS (SELECT user_id AS request_id, row_number() OVER (PARTITION BY user_id ORDER BY s) AS rank, item_id, model FROM once QUALIFY rank <= 12)"""


def _lists_sql(k: int = 10) -> str:
    """Rounds of k-means, one common table per step; then codes within the probed lists, and the best of them in full."""
    steps, rounds = [], retrieval.ROUNDS
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT id, arg_max(c, list_dot_product(u, m)) AS c FROM u, m{i} WHERE nth < {retrieval.SAMPLE_ROWS} GROUP BY id),
      t{i} AS (SELECT c, list(x ORDER BY d) AS t FROM (SELECT c, d, sum(x) AS x FROM (SELECT c, unnest(u) AS x, generate_subscripts(u, 1) AS d FROM a{i} JOIN u ON a{i}.id = u.id) GROUP BY 1, 2) GROUP BY 1),
      m{i + 1} AS MATERIALIZED (SELECT m{i}.c, coalesce([round(x / sqrt(list_dot_product(t, t)), {retrieval.CENTROID_DIGITS}) for x in t], m) AS m FROM m{i} LEFT JOIN t{i} ON m{i}.c = t{i}.c)""")
    return f"""WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
      u AS MATERIALIZED (SELECT id, v, [x / sqrt(list_dot_product(v, v)) for x in v] AS u, row_number() OVER (ORDER BY md5(id::VARCHAR), id) - 1 AS nth,
        least({retrieval.SAMPLE_ROWS}, count(*) OVER ()) // {retrieval.LIST_ROWS} AS lists FROM v),
      m0 AS MATERIALIZED (SELECT nth AS c, [round(x, {retrieval.CENTROID_DIGITS}) for x in u] AS m FROM u WHERE nth < greatest(1, lists)), {", ".join(steps)},
      f AS MATERIALIZED (SELECT id, c, row_number() OVER (PARTITION BY id ORDER BY list_dot_product(u, m) DESC, c) AS r, lists FROM u, m{rounds}),
      o AS MATERIALIZED (SELECT u.id, v, u, f.c, m, list_max([abs(z[1] - z[2]) for z in list_zip(u, m)]) / 7 AS step FROM u JOIN f ON u.id = f.id AND r = 1 JOIN m{rounds} ON f.c = m{rounds}.c),
      q AS MATERIALIZED (SELECT id, v, u, c, [z[2] + step * CASE WHEN step > 0 THEN floor((z[1] - z[2]) / step + 0.5) ELSE 0 END for z in list_zip(u, m)] AS q FROM o),
      s AS (SELECT p.id AS query_id, b.id AS item_id, list_dot_product(a.u, b.q) AS code FROM f p JOIN q b ON p.c = b.c JOIN q a ON a.id = p.id
        WHERE p.r <= greatest(1, ceil({retrieval.PROBE_SHARE}::DOUBLE * greatest(1, p.lists)))),
      h AS (SELECT query_id, item_id FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY code DESC, item_id) <= {retrieval.RESCORED * k}),
      e AS (SELECT query_id, item_id, round(list_cosine_similarity(a.v, b.v), 9) AS score FROM h JOIN q a ON a.id = query_id JOIN q b ON b.id = item_id),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM e)
      SELECT query_id, item_id, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


def _auc(score: str) -> str:
    return f"""(SELECT CAST(sum(p * (below + n / 2)) AS DOUBLE) / (sum(p) * sum(n)) FROM (SELECT p, n, sum(n) OVER (ORDER BY v) - n AS below
      FROM (SELECT {score} AS v, count(*) FILTER (y2 = 1) AS p, count(*) FILTER (y2 = 0) AS n FROM scored GROUP BY 1)))"""


def _log(p: str) -> str:
    return f"CASE WHEN {p} > 0 THEN greatest(ln({p}), -100) ELSE -100 END"


ORACLE = {
    "l2_normalize": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * label) AS v FROM embeddings),
      n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM v)
      SELECT vec_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(CASE WHEN norm > 0 THEN unnest(v) / norm ELSE 0.0 END, 6) AS x FROM n""",
    "vector_table_write": "SELECT vec_id AS item_id, CAST(len(embedding) AS INTEGER) AS dim, 1.0::DOUBLE AS norm FROM embeddings",
    "knn_cosine": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
      s AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, round(list_cosine_similarity(a.v, b.v), 9) AS score FROM v a, v b),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM s)
      SELECT query_id, item_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""",
    "knn_lsh": _lists_sql(),
    "topk_per_query": """SELECT query_id, item_id, score, rank FROM (SELECT user_id AS query_id, event_id AS item_id, value AS score,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM events) WHERE rank <= 5""",
    "ctr_cvr_score": f"WITH {CANDIDATES} SELECT user_id, item_id, round({_CTR}, 6) AS ctr, round({_CVR}, 6) AS cvr FROM candidates",
    "rank_by_ctr": f"""WITH {CANDIDATES} SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY {_CTR} DESC, item_id) AS BIGINT) AS rank,
      item_id, round({_CTR}, 6) AS ctr FROM candidates""",
    "ltr_features": f"""WITH {CANDIDATES}, f AS (SELECT user_id, item_id, [CAST(uv AS DOUBLE), up, cvr_u, price, pop, price * cvr_u, pop * uv, 0, 0, 0] AS v FROM candidates)
      SELECT user_id, item_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, round(unnest(v), 6) AS x FROM f""",
    "ltr_linear_score": f"WITH {CANDIDATES} SELECT user_id, item_id, round({_LTR}, 6) AS ltr_score FROM candidates",
    "rank_by_ltr": f"""WITH {CANDIDATES} SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY {_LTR} DESC, item_id) AS BIGINT) AS rank,
      item_id, round({_LTR}, 6) AS ltr_score FROM candidates""",
    "cap_per_category": f"""WITH {CANDIDATES}, r AS (SELECT user_id, item_id, category, row_number() OVER (PARTITION BY user_id ORDER BY {_LTR} DESC, item_id) AS r FROM candidates),
      k AS (SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY r) AS c FROM r)
      SELECT user_id, item_id, category, CAST(row_number() OVER (PARTITION BY user_id ORDER BY r) AS INTEGER) AS rank FROM k WHERE c <= 2""",
    "batch_recommend": f"""WITH {INTERACTIONS}, {USERS}, {ITEMS}, {_nearest(20)} SELECT user_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY {_CTR} DESC, item_id) AS BIGINT) AS rank, item_id, round({_CTR}, 6) AS ctr, round({_CVR}, 6) AS cvr FROM full_""",
    "batch_search": f"""WITH {INTERACTIONS}, {USERS}, {ITEMS}, {_nearest(20)}, r AS (SELECT user_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY {_LTR} DESC, item_id) AS BIGINT) AS rank, item_id, round({_LTR}, 6) AS ltr_score FROM full_)
      SELECT * FROM r WHERE rank <= 10""",
    "relevance_label": """SELECT event_id, CASE event_type WHEN 'cart' THEN 2 WHEN 'purchase' THEN 3 ELSE 1 END AS relevance,
      CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 1 END AS stored_relevance FROM events""",
    "hash_bucket": "SELECT event_id, "
    + ", ".join(f"CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % {n} AS INTEGER) AS user_{n}" for n in (500, 20, 5))
    + ", " + ", ".join(f"CAST(CAST('0x' || substr(md5(regexp_extract(props, '[0-9]+')), 1, 8) AS BIGINT) % {n} AS INTEGER) AS item_{n}" for n in (1000, 15, 100))
    + " FROM events",
    "dedup_first": f"""WITH {INTERACTIONS} SELECT user_id, item_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY event_id) AS r
      FROM interactions) WHERE r = 1""",
    "team_draft_interleave": f"WITH {_LISTS} SELECT request_id, CAST(rank AS INTEGER) AS rank, item_id, model FROM feed",
    "click_attribution": f"""WITH {_LISTS}, c AS (SELECT user_id AS request_id, item_id, count(*) AS clicks FROM interactions WHERE event_type = 'click' GROUP BY 1, 2)
      SELECT model, CAST(sum(clicks) AS BIGINT) AS clicks, count(*) AS clicked_items FROM c JOIN feed USING (request_id, item_id) GROUP BY 1""",
    "info_nce": """WITH p AS (SELECT CAST(a.vec_id // 2 AS BIGINT) AS pair_id, CAST(a.vec_id // 128 AS BIGINT) AS batch_id, CAST(a.embedding AS DOUBLE[]) AS u, CAST(b.embedding AS DOUBLE[]) AS v
      FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0),
      s AS (SELECT a.batch_id, a.pair_id, ln(sum(exp(list_dot_product(a.u, b.v) / 0.07))) AS total, max(list_dot_product(a.u, a.v)) / 0.07 AS own
      FROM p a JOIN p b ON a.batch_id = b.batch_id GROUP BY 1, 2)
      SELECT batch_id, count(*) AS pairs, round(avg(total - own), 6) AS info_nce FROM s GROUP BY 1""",
    "bce_joint_loss": f"""WITH {_SCORED}, l AS (SELECT avg(-(y1 * {_log('p1')} + (1 - y1) * {_log('1 - p1')})) AS a,
      avg(-(y2 * {_log('p2')} + (1 - y2) * {_log('1 - p2')})) AS b FROM scored)
      SELECT round(a, 6) AS ctr_loss, round(b, 6) AS cvr_loss, round(a + 0.5 * b, 6) AS joint_loss FROM l""",
    "champion_challenger": f"""WITH {_SCORED}, r AS (SELECT {_auc('p1')} AS a, {_auc('p2')} AS b)
      SELECT round(a, 6) AS champion_auc, round(b, 6) AS challenger_auc, b > a AS promote FROM r""",
    "ranking_metrics": f"""WITH {CANDIDATES}, r AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY {_LTR} DESC, item_id) AS rank FROM candidates),
      g AS (SELECT user_id, item_id, max(CASE event_type WHEN 'purchase' THEN 3 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END) AS rel FROM interactions GROUP BY 1, 2),
      t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rel DESC, item_id) AS place FROM g WHERE rel > 0),
      i AS (SELECT user_id, count(*) AS n, sum(CASE WHEN place <= 10 THEN (pow(2, rel) - 1) / log2(place + 1) END) AS idcg FROM t GROUP BY 1),
      h AS (SELECT t.user_id, count(*) AS hits, sum((pow(2, rel) - 1) / log2(rank + 1)) AS dcg FROM t JOIN r ON t.user_id = r.user_id AND t.item_id = r.item_id WHERE rank <= 10 GROUP BY 1)
      SELECT count(*) AS queries, round(avg(coalesce(hits, 0) / n), 6) AS recall, round(avg(coalesce(dcg, 0) / idcg), 6) AS ndcg FROM i LEFT JOIN h ON i.user_id = h.user_id""",
    "assign_variant": """WITH u AS (SELECT DISTINCT user_id, CAST('0x' || substr(md5('ranker-' || user_id), 1, 8) AS BIGINT) % 10000 AS slot FROM events)
      SELECT user_id, CASE WHEN slot < 4750 THEN 'control' WHEN slot < 9500 THEN 'treatment' ELSE 'holdout' END AS variant FROM u""",
}
