"""Feature views, scalar formats, lookups, data contracts, moderation and graph features."""

import hashlib
import json
import math
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from souk.functions import scalars as S
from souk.operators import aggregates, graph, lookups, moderation, monitoring, quality
from souk.plans import feature_view as fv
from souk.sources import files, online, runs
from souk.sources.logtable import LogTable

LOG = "event_id int, user_id string, item_id string, event_type string, category string, price double, ts timestamp"


def log(spark, rows):
    start = datetime(2024, 1, 1)
    data = [(i, u, item, kind, f"c{i}", float(i), start + timedelta(minutes=i)) for i, (u, item, kind) in enumerate(rows)]
    return spark.createDataFrame(data, LOG).repartition(3)


def test_user_and_item_aggregates(spark):
    df = log(spark, [("u1", "i1", "view"), ("u1", "i1", "purchase"), ("u2", "i1", "purchase"), (None, "i2", "view"), ("u1", "i2", "cart"), ("u1", "i1", "view")])
    users = {r.user_id: tuple(r)[1:] for r in aggregates.user_behavior_aggregates(df).collect()}
    assert users == {"u1": (2, 1, 0.5), "u2": (0, 1, 0.0)}
    items = {r.item_id: tuple(r)[1:] for r in aggregates.item_aggregates(df).collect()}
    assert items == {"i1": ("c0", 0.0, 2), "i2": ("c3", 3.0, 1)}
    assert tuple(aggregates.entity_counts(df, "user_id", "item_id").first()) == (2, 2)


def test_flagship_plan_is_one_shuffle_over_two_columns(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    plan = aggregates.user_behavior_aggregates(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_registry_keeps_the_last_view_and_its_entities():
    registry = fv.FeatureRegistry()
    first = fv.FeatureView("v", (fv.USER,), ())
    second = fv.FeatureView("v", (fv.ITEM,), ())
    registry.register_feature_view(first)
    registry.register_feature_view(second)
    assert registry.feature_views["v"] is second and set(registry.entities) == {"user", "item"}
    assert first == second and first.ttl == timedelta(days=365)
    assert fv.Entity("user", "user_id", "x") == fv.USER and fv.Entity("user", "uid") != fv.USER


def test_historical_features_respect_the_ttl(spark):
    view = fv.user_behavior_view()
    day = datetime(2024, 3, 1)
    snaps = spark.createDataFrame([("u", day, 1, 5), ("u", day + timedelta(days=40), 2, 9)], "user_id string, at timestamp, id int, user_view_count bigint")
    labels = spark.createDataFrame([("u", day + timedelta(days=d)) for d in (1, 35, 41)], "user_id string, seen timestamp")
    got = fv.historical_features(view, snaps, labels, "seen", "at", "id", ["user_view_count"]).orderBy("seen").collect()
    assert [r.user_view_count for r in got] == [5, None, 9]


def test_rate_text_is_half_even(spark):
    values = [0.5, 1 / 32, 3 / 32, 2 / 3, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(S.rate_text(F.col("v"))).collect()] == [f"{v:.4f}" for v in values]


def test_request_key_is_the_hash_of_sorted_json(spark):
    city = 'Zürich "A" \\ \n\U0001F600'
    df = spark.createDataFrame([("u1", city, 20)], "id string, city string, k int")
    got = df.select(S.request_key(F.lit("recommend"), F.col("id"), {"k": F.col("k"), "city": S.json_text(F.col("city"))})).first()[0]
    digest = hashlib.sha256(json.dumps({"k": 20, "city": city}, sort_keys=True).encode()).hexdigest()[:16]
    assert got == f"cache:recommend:u1:{digest}"
    assert df.select(S.request_key(F.lit("recommend"), F.col("id"))).first()[0] == "cache:recommend:u1"


def test_scalar_edges(spark):
    row = spark.range(1).select(
        S.safe_ratio(F.lit(1), F.lit(0)).alias("zero"), S.numeric_cast_default(F.lit("x"), 7).alias("bad"),
        S.numeric_cast_default(F.lit("2.5"), 7).alias("good"), S.relevance_label(F.lit("cart")).alias("cart"),
        S.relevance_label(F.lit(None)).alias("none"), S.parse_event_time(F.lit("nonsense")).alias("time"),
        S.risk_consensus(F.lit(1.0), F.lit(5.0), F.lit(0.5)).alias("risk"), S.hash_bucket(F.lit("a"), 20).alias("slot"),
        *[c.alias(n) for n, c in zip(("ctr", "cvr"), S.ctr_cvr_score(F.lit(None), F.lit(None), F.lit(None)))],
    ).first()
    assert (row.zero, row.bad, row.good, row.cart, row.none, row.time) == (0.0, 7.0, 2.5, 2, 1, None)
    assert row.risk == pytest.approx(0.875) and 0 <= row.slot < 20
    raw = 0.3 * math.log(6) - 0.05 + 0.5
    assert row.ctr == pytest.approx(1 / (1 + math.exp(-raw))) and row.cvr == pytest.approx(1 / (1 + math.exp(-raw * 0.2)))


def test_event_time_with_and_without_zone(spark):
    df = spark.createDataFrame([("2026-05-29T10:00:00Z",), ("2026-05-29T10:00:00",), ("2026-05-29T10:00:00.5",)], "t string")
    got = [r[0] for r in df.select(S.parse_event_time(F.col("t"))).collect()]
    assert got[0] == got[1] and got[2] - got[1] == timedelta(milliseconds=500)


def test_variants_follow_their_weights(spark):
    shares = spark.range(20000).select(S.assign_variant(F.col("id"), "s", {"a": 0.95, "b": 0.05}).alias("v")).groupBy("v").count().collect()
    assert {r.v: r["count"] / 20000 for r in shares}["b"] == pytest.approx(0.05, abs=0.01)


def test_lookup_keeps_order_and_duplicates(spark):
    features = spark.createDataFrame([("u1", 3, 1, 0.33)], "user_id string, user_view_count bigint, user_purchase_count bigint, user_conversion_rate double")
    requests = spark.createDataFrame([(0, "u1"), (1, "nobody"), (2, "u1")], "pos int, user_id string")
    got = lookups.user_feature_lookup(requests, features).orderBy("pos").collect()
    assert [(r.user_id, r.user_view_count, r.user_conversion_rate) for r in got] == [("u1", 3, 0.33), ("nobody", 0, 0.0), ("u1", 3, 0.33)]


class FileStore:
    """A store that appends every put to a file of its own."""

    def __init__(self, folder):
        self.path, self.sizes = os.path.join(folder, f"{os.getpid()}-{id(self)}-{os.urandom(4).hex()}.json"), []
        self.rows = {}

    def put(self, rows):
        self.sizes.append(len(rows))
        self.rows.update(rows)

    def close(self):
        with open(self.path, "w") as out:
            json.dump([self.sizes, self.rows], out)


def test_partition_writer_flushes_in_batches(spark, tmp_path):
    rows = spark.range(0, 2500, 1, 2).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.create_map(F.lit("f"), F.col("id").cast("string")).alias("features"))
    folder = str(tmp_path)
    online.partition_writer(rows, lambda: FileStore(folder))
    parts = [json.load(open(os.path.join(folder, f))) for f in os.listdir(folder)]
    assert sorted(p[0] for p in parts) == [[1000, 250], [1000, 250]]
    assert len({k for p in parts for k in p[1]}) == 2500


def test_prefix_scan_and_invalidate(spark):
    table = spark.createDataFrame([("cache:a:1", {}), ("cache:a:1:ff", {}), ("cache:b:1", {})], "key string, features map<string,string>")
    assert {r.id for r in online.key_scan(table, "cache:a:").collect()} == {"1", "ff"}
    assert [r.key for r in online.drop_prefix(table, "cache:a:1").collect()] == ["cache:b:1"]


def test_sources_resolve_or_explain(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.json(path)
    assert files.resolve_source(spark, files.BatchSource("json", path)).count() == 5
    with pytest.raises(ValueError):
        files.resolve_source(spark, files.BatchSource("postgres"))
    with pytest.raises(ValueError):
        files.resolve_source(spark, files.BatchSource("parquet"))


@pytest.mark.parametrize("nulls,passed", [(1, True), (2, False)])
def test_null_share_at_the_limit(spark, nulls, passed):
    df = spark.createDataFrame([(None if i < nulls else 1.0,) for i in range(100)], "price double")
    assert quality.dq_null_rate(df, ["price"]).first().passed is passed


def test_contract_edges(spark):
    nan = spark.createDataFrame([(float("nan"),), (None,), (5.0,)], "price double")
    assert quality.dq_between(nan, {"price": (0.0, 10.0)}).first().passed
    assert quality.dq_null_rate(nan, ["price"]).first().observed == pytest.approx(2 / 3)
    empty = nan.limit(0)
    assert quality.dq_passed(quality.dq_report(empty, [quality.NotNull("price"), quality.Between("price", 0, 1)])).first().passed
    missing = quality.dq_report(nan, [quality.Exists("user_id"), quality.NotNull("user_id"), quality.Between("user_id", 0, 1)])
    assert [(r.rule, r.passed) for r in missing.collect()] == [("exists", False)]


def review_by_hand(events):
    queue, rejects = {}, {}
    for at, kind, ident, tx, extra in sorted(events):
        if kind == 0:
            queue[tx] = ("pending", None)
        elif tx not in queue:
            rejects[ident] = "not_found"
        elif queue[tx][0] != "pending":
            rejects[ident] = "already_resolved"
        else:
            queue[tx] = (extra.lower(), f"r{ident}")
    return queue, rejects


def test_moderation_matches_a_replay(spark):
    import random

    rnd, start, events = random.Random(1), datetime(2024, 1, 1), []
    for i, minute in enumerate(rnd.sample(range(5000), 400)):
        tx = "hot" if rnd.random() < 0.4 else f"t{rnd.randrange(30)}"
        events.append((start + timedelta(minutes=minute), int(rnd.random() < 0.6), i, tx, rnd.choice(["Approved", "Blocked"])))
    a = spark.createDataFrame([(tx, i, 1.0, at) for at, k, i, tx, _ in events if k == 0], "transaction_id string, alert_id int, amount double, alert_at timestamp")
    d = spark.createDataFrame([(tx, i, x, f"r{i}", at) for at, k, i, tx, x in events if k == 1], "transaction_id string, decision_id int, action string, reviewer_id string, decided_at timestamp")
    queue, rejects = review_by_hand(events)
    assert {r.transaction_id: (r.status, r.moderated_by) for r in moderation.hitl_status(a, d).collect()} == queue
    assert {r.transaction_id for r in moderation.hitl_pending(a, d).collect()} == {t for t, s in queue.items() if s[0] == "pending"}
    assert {r.decision_id: r.reason for r in moderation.hitl_rejects(a, d).collect()} == rejects


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("/a", 0.5), ("/a", 1.0), ("/a", 600.0), ("/metrics", 1.0)], "endpoint string, latency double")
    got = {r.le: r.requests for r in monitoring.latency_histogram(df).collect()}
    assert got["1.0"] == 2 and got["500.0"] == 2 and got["+Inf"] == 3


def test_neighbor_mean_of_a_ring_with_an_isolated_node(spark):
    n = 10
    nodes = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(n + 1)], "node_id long, features array<double>")
    ring = spark.createDataFrame([(i, (i + s) % n) for i in range(n) for s in (1, -1)], "src long, dst long")
    got = {r.node_id: r.neighbor_mean for r in graph.neighbor_mean(nodes, ring, 2).collect()}
    assert got[5] == [5.0, 1.0] and got[0] == [5.0, 1.0] and got[n] == [0.0, 0.0]


def components(edges, users):
    root = {u: u for u in users}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u

    for a, b in edges:
        root[find(a)] = find(b)
    return {frozenset(u for u in users if find(u) == find(r)) for r in users}


def test_shared_attributes_connect_like_all_pairs_and_average_like_them(spark):
    member = [(u, f"a{(u * 7) % 5}") for u in range(12)] + [(u, f"b{u // 4}") for u in range(0, 12, 3)]
    df = spark.createDataFrame(member, "user_id long, attribute string")
    pairs = [(u, v) for u, a in member for v, b in member if a == b and u != v]
    edges = [(r.src, r.dst) for r in graph.shared_attr_edges(df).collect()]
    assert all(a < b for a, b in edges) and len(edges) <= len(member)
    assert components(edges, range(12)) == components(pairs, range(12))
    nodes = spark.createDataFrame([(u, [float(u * u)]) for u in range(13)], "node_id long, features array<double>")
    got = {r.node_id: r.neighbor_mean[0] for r in graph.shared_attr_mean(nodes, df, 1).collect()}
    for u in range(13):
        near = [float(v * v) for x, v in pairs if x == u]
        assert got[u] == pytest.approx(sum(near) / len(near) if near else 0.0)


def test_best_run_uses_the_last_step_and_skips_nan(spark, tmp_path):
    rows = [("e", "r1", "auc", 0.9, 1), ("e", "r1", "auc", 0.5, 2), ("e", "r2", "auc", 0.7, 1), ("e", "r3", "auc", float("nan"), 1), ("e", "r4", "loss", 9.0, 1)]
    path = str(tmp_path / "runs")
    runs.append_metrics(spark.createDataFrame(rows, runs.RUN_METRICS), path)
    assert tuple(runs.best_run(runs.read_metrics(spark, path), "auc").first()) == ("e", "r2", 0.7)


def test_event_log_opens_only_the_days_asked_for(spark, tmp_path):
    path, start = str(tmp_path / "log"), datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=6 * i)) for i in range(40)]
    files.write_event_log(spark.createDataFrame(rows, "id int, ts timestamp"), path)
    some = files.read_event_log(spark, path, start.date() + timedelta(days=2), start.date() + timedelta(days=3))
    assert sorted(r.id for r in some.collect()) == list(range(8, 16))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and len(os.listdir(path)) >= 10


def test_online_table_is_keyed(spark, tmp_path):
    def rows(*pairs):
        return spark.createDataFrame([(k, {"n": v}) for k, v in pairs], "key string, features map<string,string>")

    def stored():
        return sorted((r.key, r.features["n"]) for r in online.read_online(spark, path).collect())

    path = str(tmp_path / "online")
    for _ in range(2):
        online.online_sink(rows(("fv:a:user:1", "1"), ("fv:a:user:2", "2")), path)
        online.online_sink(rows(("fv:b:item:1", "7")), path)
    assert stored() == [("fv:a:user:1", "1"), ("fv:a:user:2", "2"), ("fv:b:item:1", "7")]
    online.online_upsert(rows(("fv:a:user:2", "5"), ("fv:a:user:3", "6")), path)
    assert stored() == [("fv:a:user:1", "1"), ("fv:a:user:2", "5"), ("fv:a:user:3", "6"), ("fv:b:item:1", "7")]
    scan = online.key_scan(online.read_online(spark, path), "fv:a:user:")
    assert sorted(r.id for r in scan.collect()) == ["1", "2", "3"]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "namespace" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.id for r in online.key_scan(online.read_online(spark, path), "fv:a:user:3").collect()] == ["3"]


def test_serving_view_adds_later_increments(spark, tmp_path):
    write = online.write_increments(str(tmp_path / "inc"))
    for number, delta in enumerate([100, 2, 3]):
        write(spark.createDataFrame([("u1", "views", delta), ("u2", "views", delta)], "key string, field string, delta long"), number)
    snapshot = spark.createDataFrame([("u1", {"views": "100", "rate": "0.5"}), ("u3", {"views": "1"})], "key string, features map<string,string>")
    view = online.with_increments(snapshot, online.read_increments(spark, str(tmp_path / "inc"), after=0))
    assert {r.key: r.features for r in view.collect()} == {"u1": {"views": "105", "rate": "0.5"}, "u2": {"views": "5"}, "u3": {"views": "1"}}


def test_online_table_reads_back_with_defaults(spark):
    table = spark.createDataFrame([("fv:user_aggregates:user:u1", {"user_view_count": "3", "user_purchase_count": "x"}), ("fv:item_aggregates:item:i1", {"category": "home"})], "key string, features map<string,string>")
    users = lookups.from_online(table, "user_aggregates", "user", "user_id", lookups.USER_DEFAULTS).collect()
    assert [tuple(r) for r in users] == [("u1", 3.0, 0.0, 0.0)]
    items = lookups.from_online(table, "item_aggregates", "item", "item_id", lookups.ITEM_DEFAULTS).collect()
    assert [tuple(r) for r in items] == [("i1", "home", 0.0, 0.0)]


def log_rows(spark, *pairs):
    return spark.createDataFrame([(k, {"v": v}) for k, v in pairs], "key string, features map<string,string>")


def seen(table, version=None):
    return {r.key: r.features["v"] for r in table.read(version).collect()}


def test_log_table_keeps_versions_apart(spark, tmp_path):
    table = LogTable(spark, str(tmp_path / "t"))
    assert table.version() == 0 and seen(table) == {} and table.compact() == 0
    table.put(log_rows(spark, ("a:1", "1"), ("a:2", "1"), ("b:1", "1")))
    table.put(log_rows(spark, ("a:2", "2"), ("c:1", "2"), (None, "x")))
    before = table.read(2)  # a reader that has opened its version
    table.delete_prefix("a:")
    table.put(log_rows(spark, ("a:1", "4")))
    table.delete(spark.createDataFrame([("c:1",), ("none",)], "key string"))
    assert {r.key: r.features["v"] for r in before.collect()} == seen(table, 2) == {"a:1": "1", "a:2": "2", "b:1": "1", "c:1": "2"}
    assert seen(table, 3) == {"b:1": "1", "c:1": "2"} and seen(table) == {"a:1": "4", "b:1": "1"}
    assert table.compact() == 6 and len(table.entries()) == 1 and seen(table) == {"a:1": "4", "b:1": "1"} and len(seen(table, 2)) == 4
    assert len(table.vacuum()) == 4 and seen(table) == {"a:1": "4", "b:1": "1"}


def test_log_table_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    table, other = LogTable(spark, path), LogTable(spark, path)
    table.put(log_rows(spark, ("a", "1")))
    real = LogTable.version
    late = iter([1])
    table.version = lambda: next(late, None) or real(table)  # has not seen the next commit yet
    other.put(log_rows(spark, ("b", "2")))
    assert table.put(log_rows(spark, ("c", "3"))) == 3 and seen(other) == {"a": "1", "b": "2", "c": "3"}
    merged = table._delta
    table._delta = lambda rows: (merged(rows), other.put(log_rows(spark, ("a", "9"))))[0]  # a put during a compaction
    table.compact()
    assert seen(other) == {"a": "9", "b": "2", "c": "3"} and len(other.entries()) == 2


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    table = LogTable(spark, str(tmp_path / "t"))
    table.put(log_rows(spark, ("a", "1")))
    with pytest.raises(Exception):
        table.put(log_rows(spark, ("a", "2"), ("b", "2")).withColumn("features", F.expr("if(key = 'b', raise_error('lost'), features)")))
    assert table.version() == 1 and seen(table) == {"a": "1"}
