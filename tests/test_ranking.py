"""Retrieval, ranking, ordered totals, point-in-time joins and interleaving against brute force."""

import functools
import hashlib
import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from souk.functions import vectors as V
from souk.operators import asof, interleaving, ordered, ranking, retrieval
from souk.plans import serving

VEC = "item_id {}, embedding array<float>"


def table(spark, vectors, ids=None, kind="bigint"):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], VEC.format(kind)).repartition(3)


def brute(queries, items, k):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    sims = np.round(unit(queries.astype(np.float32).astype(float)) @ unit(items.astype(np.float32).astype(float)).T, 9)
    return {q: [int(i) for i in np.lexsort((np.arange(len(items)), -row))[:k]] for q, row in enumerate(sims)}


@pytest.mark.parametrize("query_rows,index_rows", [(2048, 8192), (7, 11)])
def test_knn_is_exact_in_any_blocks(spark, query_rows, index_rows):
    rng = np.random.default_rng(0)
    items, queries = rng.normal(size=(60, 8)), rng.normal(size=(25, 8))
    items[5], items[9] = items[30], 0.0  # a tie and a zero vector
    q = table(spark, queries).withColumnRenamed("item_id", "query_id")
    found = retrieval.knn_cosine(q, table(spark, items), 6, query_rows=query_rows, index_rows=index_rows).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.item_id)
    assert got == brute(queries, items, 6)


def test_knn_edge_sizes(spark):
    rng = np.random.default_rng(1)
    q = table(spark, rng.normal(size=(3, 4)), ["a", "b", "c"], "string").withColumnRenamed("item_id", "query_id")
    few = table(spark, rng.normal(size=(2, 4)), ["x", "y"], "string")
    assert retrieval.knn_cosine(q, few, 10).count() == 6
    assert retrieval.knn_cosine(q, few.limit(0), 10).count() == 0


def work(q, df, k, lists, depth=None):
    """Recall against the exact search, and the shares of pairs scored by code and compared in full."""
    found = retrieval.knn_lists(q, df, k, lists, depth).cache()
    recall = retrieval.recall_at_k(found, retrieval.knn_cosine(q, df, k)).first().recall
    done = retrieval.comparisons(q, df, k, lists, depth).first()
    shares = recall, done.scored / done.pairs, done.full / done.pairs
    print("recall %.3f, scored %.3f, full %.4f of all pairs" % shares)
    found.unpersist()
    return shares


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_lists_find_most_neighbours_of_unclustered_vectors(spark, folder):
    path = f"/root/testdata/{folder}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    df = spark.read.parquet(path).select(F.col("vec_id").alias("item_id"), "embedding")
    recall, scored, full = work(df.withColumnRenamed("item_id", "query_id"), df, 10, retrieval.train_lists(df))
    assert recall >= 0.9 and full <= 0.1 and scored < 0.75


def test_lists_of_an_index_ten_times_larger(spark):
    rng = np.random.default_rng(7)
    df = table(spark, rng.normal(size=(20_000, 64))).repartition(4)
    q = df.filter("item_id % 40 = 0").withColumnRenamed("item_id", "query_id")
    lists = retrieval.train_lists(df)
    assert len(set(lists.groups)) > 1 and len(lists.centroids) == retrieval.SAMPLE_ROWS // retrieval.LIST_ROWS
    recall, scored, full = work(q, df, 10, lists)
    assert recall >= 0.9 and full <= 0.1 and scored < 0.75


def test_clustered_vectors_need_few_probes(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(50, 32))
    df = table(spark, np.repeat(centers, 80, axis=0) + 0.2 * rng.normal(size=(4000, 32)))
    q = df.withColumnRenamed("item_id", "query_id")
    lists = retrieval.tuned(retrieval.train_lists(df), q, df, 10, 0.99)
    recall, scored, full = work(q, df, 10, lists)
    assert lists.probes <= 10 and recall >= 0.95 and scored + full <= 0.12


def test_lists_in_one_hot_list_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    center = rng.normal(size=16)
    items = np.concatenate([center + 0.05 * rng.normal(size=(200, 16)), rng.normal(size=(100, 16)), np.zeros((2, 16)), np.tile(center, (30, 1))])
    df = table(spark, items).union(spark.createDataFrame([(900, None)], "item_id long, embedding array<double>"))
    q = df.withColumnRenamed("item_id", "query_id")
    lists = retrieval.train_lists(df, list_rows=20, group_rows=64)
    found = retrieval.knn_lists(q, df, 5, lists, depth=60, index_rows=64)
    assert retrieval.recall_at_k(found, retrieval.knn_cosine(q, df, 5)).first().recall >= 0.9
    rows = [(r.query_id, r.rank, r.item_id) for r in found.collect()]
    assert len(rows) == 332 * 5 and [i for c, _, i in sorted(rows) if c == 302] == [302, 303, 304, 305, 306]
    assert retrieval.knn_lists(q, df.limit(0), 5).count() == retrieval.knn_lists(q.limit(0), df, 5).count() == 0


@pytest.mark.parametrize("task_index,task_queries", [(131_072, 65_536), (90, 70)])
def test_lists_are_searched_block_by_block_in_any_parts(spark, monkeypatch, task_index, task_queries):
    """The ``depth`` best by code of every block, then the best of these; and a query goes once to a part, not to every block."""
    monkeypatch.setattr(retrieval, "TASK_INDEX", task_index)
    monkeypatch.setattr(retrieval, "TASK_QUERIES", task_queries)
    rng = np.random.default_rng(8)
    items = np.concatenate([rng.normal(size=(300, 8)), np.repeat(rng.normal(size=(10, 8)), 30, axis=0)])
    k, depth, index_rows, df = 5, 9, 40, table(spark, items)
    q = df.withColumnRenamed("item_id", "query_id")
    lists = retrieval.train_lists(df, list_rows=20, group_rows=60)
    got = {(r.query_id, r["rank"]): (r.item_id, r.score) for r in retrieval.knn_lists(q, df, k, lists, depth, query_rows=50, index_rows=index_rows).collect()}

    unit = items.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = np.argsort(-(unit @ lists.centroids.T), axis=1, kind="stable")
    own, rebuilt = near[:, 0], lists.rebuilt(unit, near[:, 0])
    hashed = np.array([r.h for r in df.orderBy("item_id").select(F.xxhash64("item_id").alias("h")).collect()])
    held = np.bincount(lists.groups[own])
    block = lists.groups[own] * 1000 + hashed % -(-held // index_rows)[lists.groups[own]]
    assert len(np.unique(block)) > 10
    for query in range(len(items)):
        probed, found = set(near[query, : lists.probes]), []
        for of in np.unique(block):
            inside = [i for i in np.flatnonzero(block == of) if own[i] in probed]
            code = {i: round(float(unit[query] @ rebuilt[i]), 12) for i in inside}
            found += [(-round(float(unit[query] @ unit[i]), 9), i) for i in sorted(inside, key=lambda i: (-code[i], i))[:depth]]
        for place, (score, i) in enumerate(sorted(found)[:k], 1):
            assert got[query, place] == (i, pytest.approx(-score, abs=2e-9))
    layout = retrieval._layout(held, index_rows, task_index)
    asked = retrieval._asking(q.withColumnRenamed("embedding", "query_vec"), lists, layout)
    assert asked.count() <= len(items) * -(-len(items) // task_index)
    assert asked.groupBy("query_id", "part").count().filter("count > 1").isEmpty()


def test_normalising_keeps_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(V.l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    assert df.select(V.normalize_query(F.col("v"))).collect()[1][0] == [0.0, 0.0]


def test_topk_sends_only_k_rows_per_task(spark):
    df = spark.range(10000).select(F.when(F.col("id") >= 0, "q").alias("query_id"), F.col("id").alias("item_id"), (F.col("id") % 100).alias("score"))
    top = retrieval.topk_per_query(df, 3)
    assert [r.item_id for r in top.orderBy("rank").collect()] == [99, 199, 299]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.fixture
def many_parts(spark):
    """Keep small shuffles in several partitions, so that offsets between partitions matter."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_totals_over_a_hot_key(spark, many_parts):
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, int(rng.integers(0, 9))) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t int, n int").repartition(6)
    with_parts = ordered.place(df, ["k"], ["t"])
    assert with_parts.filter("k = 'hot'").select("_part").distinct().count() > 1
    got = {(r.k, r.t): (r.n_run, r.n_all) for r in ordered.running_totals(df, ["k"], ["t"], ["n"], whole=True).collect()}
    want = pd.DataFrame(rows, columns=["k", "t", "n"]).sort_values("t")
    want["run"], want["all"] = want.groupby("k")["n"].cumsum(), want.groupby("k")["n"].transform("sum")
    assert got == {(r.k, r.t): (r.run, r["all"]) for _, r in want.iterrows()}


def test_ranks_of_a_long_list_equal_those_of_a_window(spark, many_parts):
    df = spark.range(500).select(F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id") % 3).alias("user_id"),
                                 F.col("id").alias("item_id"), (F.col("id") * 31 % 17).cast("double").alias("s"))
    far, near = (ranking.rank_rows(df, "s", bounded=b).collect() for b in (False, True))
    assert sorted(map(tuple, far)) == sorted(map(tuple, near))


@pytest.mark.parametrize("n", [1, 2, 501])
def test_quantiles_match_numpy(spark, many_parts, n):
    rng = np.random.default_rng(n)
    x, y = rng.normal(size=n), rng.integers(0, 4, n).astype(float)
    df = spark.createDataFrame([("x", float(v)) for v in x] + [("y", float(v)) for v in y], "k string, v double").repartition(5)
    probs = [0, 0.01, 0.25, 0.5, 0.99, 1]
    got = {r.k: r.quantiles for r in ordered.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert got["x"] == pytest.approx(list(np.quantile(x, probs))) and got["y"] == pytest.approx(list(np.quantile(y, probs)))


def test_pit_join_matches_merge_asof(spark):
    rng = np.random.default_rng(4)
    start = datetime(2024, 1, 1)

    def rows(n, tag):
        ts = [start + timedelta(seconds=int(s)) for s in rng.integers(0, 90000, n)]
        keys = [0 if i % 3 else int(i % 5) for i in range(n)]
        return pd.DataFrame({"k": keys, "ts": ts, f"{tag}_id": np.arange(n)})

    labels, features = rows(300, "l"), rows(400, "f").drop_duplicates(["k", "ts"])
    a = spark.createDataFrame(labels.rename(columns={"ts": "at"})).repartition(4)
    b = spark.createDataFrame(features).repartition(4)
    ttl = timedelta(minutes=5)
    got = {r.l_id: r.f_id for r in asof.pit_join(a, b, "k", "at", "ts", ["f_id"], "f_id", ttl=ttl).collect()}
    want = pd.merge_asof(labels.sort_values("ts"), features.sort_values("ts"), on="ts", by="k", tolerance=pd.Timedelta(ttl))
    assert got == {r.l_id: (None if pd.isna(r.f_id) else int(r.f_id)) for r in want.itertuples()}


def test_pit_join_takes_equal_times_and_the_largest_tiebreak(spark):
    at = datetime(2024, 1, 1, 12)
    labels = spark.createDataFrame([(1, at), (2, at)], "k int, at timestamp")
    features = spark.createDataFrame([(1, at, 1, "a"), (1, at, 2, "b"), (2, at + timedelta(seconds=1), 3, "late")], "k int, ts timestamp, id int, v string")
    got = {r.k: r.v for r in asof.pit_join(labels, features, "k", "at", "ts", ["v"], "id").collect()}
    assert got == {1: "b", 2: None}


def draft_by_hand(request, a, b, size):
    """The same rule step by step, with the same coins."""
    feed, credit, step = [], {}, 0
    a, b = list(a), list(b)
    while len(feed) < size and (a or b):
        step += 1
        heads = int(hashlib.md5(f"{request}-{step}".encode()).hexdigest()[:8], 16) % 2 == 1
        side, name = (a, "model_A") if (a and (heads or not b)) else (b, "model_B")
        item = side.pop(0)
        if item not in credit:
            feed.append(item)
            credit[item] = name
    return [(i + 1, item, credit[item]) for i, item in enumerate(feed)]


def test_interleaving_matches_the_stepwise_rule(spark):
    rng = np.random.default_rng(5)
    lists = {f"r{i}": ([f"i{x}" for x in rng.integers(0, 12, rng.integers(0, 8))], [f"i{x}" for x in rng.integers(0, 12, rng.integers(0, 8))]) for i in range(200)}
    lists["demo"] = (["pear", "plum", "fig", "kiwi", "lime"], ["date", "plum", "mango", "guava", "melon", "quince"])

    def rows(side, name):
        data = [(r, p, item) for r, pair in lists.items() for p, item in enumerate(pair[side])]
        df = spark.createDataFrame([*data, ("demo", 99, None), ("demo", 100, "")], "request_id string, p int, item_id string")
        return interleaving.ranked_list(df, "request_id", "item_id", "p", name)

    got = {}
    for r in interleaving.team_draft_interleave(rows(0, "list_a"), rows(1, "list_b"), max_size=6).orderBy("request_id", "rank").collect():
        got.setdefault(r.request_id, []).append((r["rank"], r.item_id, r.model))
    want = {r: draft_by_hand(r, a, b, 6) for r, (a, b) in lists.items()}
    assert got == {r: feed for r, feed in want.items() if feed}
    assert len({item for _, item, _ in got["demo"]}) == 6


def test_dedup_first_and_category_cap(spark):
    lists = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "a", 3)], "q string, item string, p int")
    assert sorted((r.item, r.p) for r in ranking.dedup_first(lists, "q", "item", "p").collect()) == [("a", 1), ("b", 2)]
    rows = spark.createDataFrame([(1, i, "c" if i < 4 else "d", i) for i in range(1, 6)], "user_id int, item_id int, category string, rank int")
    assert [(r["rank"], r.item_id) for r in ranking.cap_per_category(rows.withColumnRenamed("rank", "place"), 2, F.asc("place")).orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 4), (4, 5)]


@pytest.mark.parametrize("k", [-5, 0, 101])
def test_recommend_rejects_bad_sizes(spark, k):
    empty = spark.createDataFrame([], "user_id bigint, embedding array<float>")
    with pytest.raises(ValueError):
        serving.batch_recommend(empty, empty, empty, empty, k)


def test_recommend_and_search_for_known_and_unknown_ids(spark):
    users = spark.createDataFrame([("u1", 4, 2, 0.5)], "user_id string, user_view_count bigint, user_purchase_count bigint, user_conversion_rate double")
    items = spark.createDataFrame([("i1", "books", 10.0, 1), ("i2", "home", 10.0, 50)], "item_id string, category string, base_price double, popularity bigint")
    vectors = spark.createDataFrame([("u1", [1.0, 0.0]), ("u2", [0.0, 1.0])], "user_id string, embedding array<float>")
    index = spark.createDataFrame([("i1", [1.0, 0.1]), ("i2", [1.0, 0.2]), ("i3", [0.0, 1.0])], VEC.format("string"))
    got = serving.batch_recommend(vectors, index, users, items, 2).orderBy("user_id", "rank").collect()
    assert [(r.user_id, r.item_id) for r in got if r.user_id == "u1"] == [("u1", "i2"), ("u1", "i1")]  # the more popular first
    assert {r.user_id for r in got} == {"u1", "u2"}
    search = serving.batch_search(vectors, index, users, items, 1).collect()
    assert {r.user_id: r.item_id for r in search} == {"u1": "i2", "u2": "i2"}
    body = serving.as_response(serving.batch_recommend(vectors, index, users, items, 2), "item_id", "ctr").orderBy("user_id").first()
    assert body.item_id == ["i2", "i1"] and body.ctr[0] > body.ctr[1]


def test_recommendations_from_lists_do_not_depend_on_parts(spark, monkeypatch):
    """The way of ``recommend_trained``: every user gets the same list, however few rows a task holds."""
    rng = np.random.default_rng(4)
    index = table(spark, rng.normal(size=(300, 8)))
    users = spark.createDataFrame([(u, 4, 2, 0.5) for u in range(100)], "user_id long, user_view_count bigint, user_purchase_count bigint, user_conversion_rate double")
    items = spark.createDataFrame([(i, "c", float(i), i % 7) for i in range(250)], "item_id long, category string, base_price double, popularity bigint")
    vectors, found = index.filter("item_id < 120").withColumnRenamed("item_id", "user_id"), []
    for held, asked in ((131_072, 65_536), (64, 30)):
        monkeypatch.setattr(retrieval, "TASK_INDEX", held)
        monkeypatch.setattr(retrieval, "TASK_QUERIES", asked)
        near = functools.partial(retrieval.knn_lists, index_rows=32)
        found.append(sorted(map(tuple, serving.batch_recommend(vectors, index, users, items, 10, nearest=near).collect())))
    assert found[0] == found[1] and len(found[0]) == 120 * 10


def test_null_scores_rank_last_in_both_ways(spark):
    df = spark.createDataFrame([("q", 1, 5.0), ("q", 2, None), ("q", 3, 9.0)], "user_id string, item_id int, s double")
    for bounded in (False, True):
        assert {r.item_id: r["rank"] for r in ranking.rank_rows(df, "s", bounded=bounded).collect()} == {3: 1, 1: 2, 2: 3}
