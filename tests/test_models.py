"""Model jobs on small fixtures with a known answer."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.operators import anomalies, boosting, contrastive, evaluation, graph, joint, lookups, models, retrieval
from souk.plans import fraud
from souk.session import shared_root


OUTLIERS = (17, 60, 111)


@pytest.fixture(scope="module")
def grid(spark):
    """A 12 x 11 grid of nodes with six correlated features; three nodes break the correlation and are labelled."""
    rng = np.random.default_rng(311)
    base = rng.normal(size=(132, 2))
    x = base @ rng.normal(size=(2, 6)) + 0.1 * rng.normal(size=(132, 6))
    for i in OUTLIERS:
        x[i] = 7.0 * rng.choice([-1.0, 1.0], 6)
    nodes = spark.createDataFrame([(i, [float(v) for v in row], int(i in OUTLIERS)) for i, row in enumerate(x)], "node_id long, features array<double>, label int")
    steps = [(i, j) for i in range(132) for j in (i + 1, i + 11) if j < 132 and (j == i + 11 or j % 11)]
    return nodes.repartition(4), graph.both_directions(spark.createDataFrame(steps, "src long, dst long"))


def top(df, score):
    return {r.node_id for r in df.orderBy(F.desc(score)).limit(len(OUTLIERS)).collect()}


def test_reconstruction_is_that_of_the_leading_components(grid):
    nodes, _ = grid
    out = anomalies.recon_error(nodes)
    x = np.array([r.features for r in nodes.orderBy("node_id").collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    basis = np.linalg.svd(z, full_matrices=False)[2][:3]
    want = ((z - z @ basis.T @ basis) ** 2).mean(1)
    got = np.array([r.recon_error for r in out.orderBy("node_id").collect()])
    assert got == pytest.approx(want, abs=1e-8)


def test_outliers_are_easiest_to_isolate_and_partitions_do_not_matter(grid):
    nodes, _ = grid
    out = anomalies.isolation_forest(nodes)
    assert top(out, "isolation") == set(OUTLIERS)
    again = anomalies.isolation_forest(nodes.repartition(7))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))
    scores = [r.isolation for r in out.collect()]
    assert 0 < min(scores) < 0.5 < max(scores) <= 1


def test_forest_sample_is_bounded_per_tree(grid):
    sizes = anomalies.forest_sample(grid[0], trees=7, sample=16).groupBy("tree").count().collect()
    assert {r.tree: r["count"] for r in sizes} == {t: 16 for t in range(7)}


def test_consensus_ranks_the_outliers_first(grid):
    nodes, edges = grid
    out = fraud.fraud_ensemble(nodes, edges, 6)
    assert out.count() == 132 and top(out, "risk") == set(OUTLIERS)
    row = out.filter(f"node_id = {OUTLIERS[0]}").first()
    assert row.risk == pytest.approx(0.4 * row.graph_risk + 0.35 * min(row.recon_error, 1) + 0.25 * min(row.isolation, 1))


def test_graph_score_learns_from_neighbours(spark):
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 200)
    nodes = spark.createDataFrame([(i, [float(rng.normal())], int(label[i])) for i in range(200)], "node_id long, features array<double>, label int")
    far = [(200 + i, [float(4 * label[i] + rng.normal())], int(label[i])) for i in range(200)]
    both = nodes.unionByName(spark.createDataFrame(far, nodes.schema))
    edges = graph.both_directions(spark.createDataFrame([(i, 200 + i) for i in range(200)], "src long, dst long"))
    scored = models.graph_score(both, edges, 1).filter("node_id < 200").join(nodes, "node_id")
    assert evaluation.auc(scored.withColumnRenamed("graph_risk", "score")).first().auc > 0.9


@pytest.fixture(scope="module")
def clustered(spark):
    """Users of two tastes; each taste prefers its own half of the items."""
    rng = np.random.default_rng(2)
    rows = []
    for u in range(60):
        for i in rng.choice(30, 12, replace=False):
            liked = (u % 2) == (i % 2)
            rows.append((u, int(i), "purchase" if liked else "view"))
    return spark.createDataFrame(rows, "user_id long, item_id long, event_type string").repartition(4)


def test_embeddings_beat_popularity(clustered):
    weight = F.when(F.col("event_type") == "purchase", 5).otherwise(0.1)
    users, items = models.train_embeddings(clustered, weight, dim=4)
    found = retrieval.knn_cosine(users, items, 5)
    agree = found.agg(F.avg((F.col("query_id") % 2 == F.col("item_id") % 2).cast("double")).alias("share")).first().share
    assert agree > 0.75  # a popularity list would agree half the time


def contrast(pairs, users, items):
    """Mean in-batch loss of held-out pairs."""
    both = pairs.join(users.withColumnRenamed("query_id", "user_id").withColumnRenamed("embedding", "user_vec"), "user_id").join(
        items.withColumnRenamed("embedding", "item_vec"), "item_id"
    )
    numbered = both.withColumn("pair_id", F.col("user_id") * 1000 + F.col("item_id")).withColumn("batch_id", F.pmod(F.xxhash64("pair_id"), F.lit(8)))
    return evaluation.info_nce(numbered).agg(F.avg("info_nce")).first()[0]


def test_contrastive_vectors_tell_held_out_pairs(spark):
    rng = np.random.default_rng(9)
    taste, kind = rng.normal(size=(150, 4)), rng.normal(size=(120, 4))
    odds = taste @ kind.T
    liked = [(u, int(i), "view", bool(rng.random() < 0.2)) for u in range(150) for i in np.argsort(-odds[u])[:20]]
    log = spark.createDataFrame(liked, "user_id long, item_id long, event_type string, held boolean").repartition(4).cache()
    known, held = log.filter("not held"), log.filter("held").select("user_id", "item_id")
    short, fitted, factors = (
        contrast(held, *f) for f in (
            models.train_embeddings(known, F.lit(1.0), dim=8, epochs=1), models.train_embeddings(known, F.lit(1.0), dim=8),
            models.factor_embeddings(known, F.lit(1.0), dim=8),
        )
    )
    print(short, fitted, factors)
    assert fitted < short and fitted < factors


def test_contrastive_gradients_and_repeated_items():
    rng = np.random.default_rng(0)
    u, v, items, w = rng.normal(size=(6, 4)), rng.normal(size=(6, 4)), np.array([0, 1, 2, 2, 3, 4]), rng.random(6)
    _, du, dv = contrastive.gradients(u, v, items, w, 0.5)
    for side, found in ((u, du), (v, dv)):
        for at in np.ndindex(6, 4):
            kept = side[at]
            losses = []
            for step in (1e-6, -1e-6):
                side[at] = kept + step
                losses.append(contrastive.gradients(u, v, items, w, 0.5)[0])
            side[at] = kept
            assert found[at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("group_blocks", [1, 16])
def test_groups_of_blocks_make_the_turns_in_order_and_leave_one_table(spark, monkeypatch, group_blocks):
    """The same vectors as block by block, turn by turn; tables of past rounds are gone."""
    monkeypatch.setattr(contrastive, "GROUP_BLOCKS", group_blocks)
    rng = np.random.default_rng(5)
    rows = {(int(a), f"i{b}"): float(w) for a, b, w in zip(rng.integers(0, 90, 900), rng.integers(0, 25, 900), rng.random(900) + 0.1)}
    pairs = spark.createDataFrame([(a, b, w) for (a, b), w in rows.items()], "user_id long, item_id string, weight double").cache()
    epochs, blocks, rate, tau, batch = 2, 9, 0.2, 0.1, 16
    folder = os.path.join(shared_root(spark).removeprefix("file://"), "souk")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    users, items = contrastive.fit(pairs, 4, epochs, rate, 1, tau, block_rows=10, batch=batch)
    got = {r.user_id: r.vec for r in users.collect()} | {r.item_id: r.vec for r in items.collect()}
    assert len([x for x in set(os.listdir(folder)) - before if x.startswith("contrastive")]) == 1

    want = {r[0]: np.array(r[1]) for c in ("user_id", "item_id") for r in contrastive.first_vectors(pairs.select(c).distinct(), c, 4, 1).collect()}
    at = [F.xxhash64("user_id", "item_id", F.lit(e)).alias(f"at{e}") for e in range(epochs)]
    dealt = pairs.select("*", contrastive._block("user_id", blocks).alias("ub"), contrastive._block("item_id", blocks).alias("ib"), *at).collect()
    for epoch in range(epochs):
        for shift in range(blocks):
            for block in range(blocks):
                cell = sorted((r for r in dealt if r.ub == block and (r.ib - r.ub) % blocks == shift), key=lambda r: r[f"at{epoch}"])
                for some in (cell[n : n + batch] for n in range(0, len(cell), batch)):
                    ids = {x: n for n, x in enumerate(dict.fromkeys(r.item_id for r in some))}
                    w = np.array([r.weight for r in some])
                    u, v = np.array([want[r.user_id] for r in some]), np.array([want[r.item_id] for r in some])
                    _, du, dv = contrastive.gradients(u, v, np.array([ids[r.item_id] for r in some]), w / w.mean(), tau)
                    for r, a, b in zip(some, du, dv):
                        want[r.user_id] = want[r.user_id] - rate * (1 - epoch / epochs) * tau * a
                        want[r.item_id] = want[r.item_id] - rate * (1 - epoch / epochs) * tau * b
                    for x in {r.user_id for r in some} | set(ids):
                        want[x] = want[x] / np.linalg.norm(want[x])
    assert got.keys() == want.keys()
    assert all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)


def test_embeddings_take_ids_of_any_type(clustered):
    weight = F.when(F.col("event_type") == "purchase", 5).otherwise(0.1)
    far = clustered.select((F.col("user_id") + (1 << 40)).alias("user_id"), F.concat(F.lit("i-"), "item_id").alias("item_id"), "event_type")
    users, items = models.train_embeddings(far, weight, dim=4)
    assert {r.query_id for r in users.collect()} == {(1 << 40) + u for u in range(60)}
    assert {r.item_id for r in items.collect()} == {f"i-{i}" for i in range(30)}


def test_trained_vectors_are_searched_in_any_parts(clustered, monkeypatch):
    """The way of ``train_embeddings``: ids of any type, from events to neighbours, whatever share of them a task holds."""
    named = clustered.select(F.concat(F.lit("u"), "user_id").alias("user_id"), F.concat(F.lit("i"), "item_id").alias("item_id"), "event_type")
    found = []
    for index, queries in ((131_072, 65_536), (7, 20)):
        monkeypatch.setattr(retrieval, "TASK_INDEX", index)
        monkeypatch.setattr(retrieval, "TASK_QUERIES", queries)
        users, items = models.train_embeddings(named, F.lit(1.0), dim=4, epochs=2)
        found.append(sorted(map(tuple, retrieval.knn_lists(users, items, 5, index_rows=7).collect())))
    assert found[0] == found[1] and len(found[0]) == 60 * 5


def test_rankers_order_their_training_data(spark, clustered):
    users = clustered.groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("user_view_count"),
                                             F.count_if(F.col("event_type") == "purchase").alias("user_purchase_count"))
    users = users.withColumn("user_conversion_rate", F.col("user_purchase_count") / (F.col("user_view_count") + 1))
    items = spark.createDataFrame([(i, "c", 10.0 * (i % 2), 100 - i) for i in range(30)], "item_id long, category string, base_price double, popularity long")
    odd = clustered.withColumn("event_type", F.when(F.col("item_id") % 2 == 1, "purchase").otherwise("view"))
    examples = models.ranker_examples(odd, users, items, F.col("event_type") == "purchase", F.col("event_type") == "purchase")
    scored = models.train_ctr_cvr(examples)
    assert evaluation.auc(scored, "ctr_pred", "ctr_label").first().auc > 0.95
    assert evaluation.bce_joint_loss(scored).first().ctr_loss < 0.69
    unseen = users.select("user_id").crossJoin(items.select("item_id")).join(examples.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    rated = models.fit_ctr_cvr(examples, names=("ctr", "cvr"))(lookups.user_item_features(unseen, users, items))
    odds = {r.odd: r.m for r in rated.groupBy((F.col("item_id") % 2).alias("odd")).agg(F.avg("ctr").alias("m")).collect()}
    assert rated.count() == 60 * 30 - 60 * 12 and odds[1] > 0.8 > 0.2 > odds[0]
    graded = models.train_ltr(models.ltr_examples(odd, users, items, {"view": 1, "purchase": 3}), rounds=5)
    means = {r.relevance: r.m for r in graded.groupBy("relevance").agg(F.avg("ltr_score").alias("m")).collect()}
    assert means[3] > means[1] + 0.05


@pytest.fixture(scope="module")
def lists(spark):
    """Users with a taste of their own level: the level moves all grades of a list, and only the rest decides its order."""
    rng = np.random.default_rng(21)
    rows = []
    for u in range(160):
        level = rng.normal(0, 2)
        for i in range(30):
            quality, noise = rng.normal(size=2)
            grade = int(np.clip(np.round(1.2 + level + quality * abs(noise) ** 0.5), 0, 4))
            rows.append((u, i, grade, [float(level + 0.1 * rng.normal()), float(quality), float(noise)]))
    return spark.createDataFrame(rows, "user_id long, item_id long, relevance int, features array<double>").repartition(4).cache()


def ndcg(scored):
    ranked = retrieval.topk_per_query(scored.withColumnRenamed("user_id", "query_id"), 10, score="ltr_score")
    truth = scored.select(F.col("user_id").alias("query_id"), "item_id", "relevance")
    return evaluation.ranking_metrics(ranked, truth, 10).agg(F.avg("ndcg")).first()[0]


def test_lists_are_ranked_no_worse_than_by_grades(lists):
    known, held = lists.filter("user_id % 2 = 0"), lists.filter("user_id % 2 = 1")
    by_list = ndcg(models.fit_ltr(known, rounds=6, rate=0.3, depth=3)(held))
    by_grade = ndcg(models.fit_grades(known, rounds=6, rate=0.3, depth=3)(held))
    print(by_list, by_grade)
    assert by_list >= by_grade and by_list > 0.85


def test_lambda_gradients_by_brute_force(lists):
    rows = lists.filter("user_id < 4").withColumn("score", F.round(F.col("features")[1] + F.col("item_id") % 3, 1)).cache()
    got = {(r.user_id, r.item_id): (r.gradient, r.curvature) for r in boosting.lambdas(rows, boosting.ideal(rows, "user_id", 5), k=5).collect()}
    for user in range(4):
        mine = sorted((r for r in rows.collect() if r.user_id == user), key=lambda r: (-r.score, r.item_id))
        gain, discount = [2.0**r.relevance - 1 for r in mine], [1 / np.log2(n + 2) if n < 5 else 0.0 for n in range(len(mine))]
        best = sum(g / np.log2(n + 2) for n, g in enumerate(sorted(gain, reverse=True)[:5]))
        for a, row in enumerate(mine):
            g = h = 0.0
            for b, other in enumerate(mine):
                if gain[a] != gain[b] and best:
                    sign, swap = np.sign(gain[a] - gain[b]), abs(gain[a] - gain[b]) * abs(discount[a] - discount[b]) / best
                    rho = 1 / (1 + np.exp(sign * (row.score - other.score)))
                    g, h = g - sign * swap * rho, h + swap * rho * (1 - rho)
            assert got[user, row.item_id] == pytest.approx((g, h), abs=1e-12)


@pytest.mark.parametrize("chunk_rows", [boosting.CHUNK_ROWS, 100, 7])
def test_chunks_learn_the_trees_of_the_lambda_gradients(spark, lists, chunk_rows):
    """Whole users in chunks, and users of 30 rows over many; a missing value, rows without item or user; tables of past rounds go."""
    missing = F.array(F.when(F.col("item_id") == 3, F.lit(float("nan"))).otherwise(F.col("features")[0]), F.col("features")[1], F.col("features")[2])
    few = lists.filter("user_id < 40").withColumn("features", missing).withColumn("item_id", F.when(F.col("item_id") != 5, F.col("item_id")))
    rows = few.union(few.limit(1).withColumn("user_id", F.lit(None).cast("long"))).cache()
    edges, ideals, want = boosting.bin_edges(rows, 3), boosting.ideal(rows, "user_id"), boosting.Ranker(0.3)
    for _ in range(3):
        scored = rows.withColumn("score", want.score("features") if want.trees else F.lit(0.0))
        want.trees.append(boosting.grow(boosting.lambdas(scored, ideals).cache(), edges, 3))
    folder = os.path.join(shared_root(spark).removeprefix("file://"), "souk")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    got = boosting.fit(rows, 3, 0.3, 3, chunk_rows=chunk_rows)
    assert not {x for x in os.listdir(folder) if x.startswith(("chunks", "lambdas"))} - before
    for a, b in zip(got.trees, want.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all()
        assert a.value == pytest.approx(b.value, rel=1e-9, abs=1e-12)


def test_a_tree_of_known_splits(spark):
    rows = spark.createDataFrame([([float(i), float(i % 2)], -1.0 if i < 50 else 2.0, 1.0) for i in range(100)], "features array<double>, gradient double, curvature double")
    tree = boosting.grow(rows, boosting.bin_edges(rows, 2), 2)
    assert tree.feature[0] == 0 and 45 <= tree.threshold[0] <= 52
    found = tree.value[tree.leaves(np.array([[0.0, 0.0], [99.0, 1.0]]))]
    assert 0.9 < found[0] < 1 and -2 < found[1] < -1.8


def test_joint_gradients():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 5)), (rng.random((40, 2)) < 0.4).astype(float)
    for model, labels in ((joint.TwoTasks(np.zeros(5), np.ones(5)), y), (joint.Neighbourhood(np.zeros(5), np.ones(5)), y[:, 0])):
        flat = model.flat + 0.1 * rng.normal(size=model.flat.size)
        found = model.gradient(x, labels, flat)[1:]
        for i in range(len(flat)):
            step = np.zeros(len(flat))
            step[i] = 1e-6
            slope = (model.gradient(x, labels, flat + step)[0] - model.gradient(x, labels, flat - step)[0]) / 2e-6
            assert found[i] == pytest.approx(slope, abs=1e-6)


def test_one_model_for_both_labels_is_no_worse_than_two(spark):
    """Both labels hang on the same product of inputs, and conversions are rare."""
    rng = np.random.default_rng(13)
    rows = []
    for i in range(3000):
        x = rng.normal(size=5)
        z = 1.5 * x[0] * x[1] + x[2] * x[3] - 0.5
        clicked = rng.random() < 1 / (1 + np.exp(-z))
        rows.append((*map(float, x), float(clicked), float(clicked and rng.random() < 1 / (1 + np.exp(2 - z))), i % 4 == 0))
    names = ", ".join(f"{c} double" for c in (*models.CTR_INPUTS, "ctr_label", "cvr_label"))
    table = spark.createDataFrame(rows, f"{names}, held boolean").repartition(4).cache()
    known, held = table.filter("not held"), table.filter("held")
    losses = [evaluation.bce_joint_loss(fit(known)(held)).first().joint_loss for fit in (models.fit_ctr_cvr, models.fit_heads)]
    print(losses)
    assert losses[0] <= losses[1]
    sums = models.fit_ctr_cvr(known)(known).agg(*[F.sum((F.col(f"{h}_pred") - F.col(f"{h}_label")) * F.col(c)) for h in ("ctr", "cvr") for c in models.CTR_INPUTS]).first()
    assert max(map(abs, sums)) < 1e-4


def test_hidden_layer_tells_an_interaction_of_node_and_neighbours(spark):
    rng = np.random.default_rng(17)
    own, around = rng.normal(size=600), rng.normal(size=600)
    rows = [(i, [float(own[i])], [float(around[i])], int(own[i] * around[i] > 0)) for i in range(600)]
    both = spark.createDataFrame(rows, "node_id long, features array<double>, neighbor_mean array<double>, label int").repartition(4)
    scored = models.neighborhood_score(both, 60).join(both.select("node_id", "label"), "node_id")
    flat = models.linear_neighborhood_score(both).join(both.select("node_id", "label"), "node_id")
    found, linear = (evaluation.auc(x.withColumnRenamed("graph_risk", "score")).first().auc for x in (scored, flat))
    assert found > 0.9 > 0.6 > linear


def test_shared_attributes_make_true_neighbourhoods(spark):
    nodes = spark.createDataFrame([(1, [0.0]), (2, [10.0]), (3, [100.0])], "node_id long, features array<double>")
    members = spark.createDataFrame([(u, "shared") for u in (1, 2, 3)], "user_id long, attribute string")
    means = {r.node_id: r.neighbor_mean[0] for r in graph.shared_attr_mean(nodes, members, 1).collect()}
    assert means == {1: 55.0, 2: 50.0, 3: 5.0}


def test_forest_sample_reaches_every_part_of_the_table(spark):
    nodes = spark.range(60_000).select(F.col("id").alias("node_id"), F.array(F.col("id").cast("double")).alias("features"))
    drawn = anomalies.forest_sample(nodes, trees=50, sample=128)
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert sizes == [128] * 50 and drawn.select("node_id").distinct().count() > 0.9 * 50 * 128
