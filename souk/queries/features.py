"""Queries over the feature store: scans, aggregates, online tables, lookups and data contracts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import scalars as S
from souk.operators import aggregates, asof, lookups, quality
from souk.plans import feature_view as fv
from souk.session import scratch_path
from souk.sources import adapters as A
from souk.sources.logtable import LogTable
from souk.sources import files, online
from souk.streaming import counts

INTERACTIONS = """interactions AS (
  SELECT event_id, user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id, event_type,
         'cat_' || (CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 5) AS category, value AS price, ts
  FROM events)"""

USERS = """users AS (
  SELECT user_id, count(*) FILTER (event_type = 'view') AS user_view_count,
         count(*) FILTER (event_type = 'purchase') AS user_purchase_count,
         CASE WHEN count(*) FILTER (event_type = 'view') > 0
              THEN count(*) FILTER (event_type = 'purchase') / count(*) FILTER (event_type = 'view') ELSE 0.0 END
           AS user_conversion_rate
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id)"""

ITEMS = """items AS (
  SELECT item_id, arg_min(category, (ts, event_id)) AS category, arg_min(price, (ts, event_id)) AS base_price,
         count(*) FILTER (event_type = 'view') AS popularity
  FROM interactions GROUP BY item_id)"""

# requests: every signup asks for its user shifted by a third of the id range, so that some are unknown
REQUESTS = """requests AS (
  SELECT event_id AS pos, user_id * 3 AS user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) * 2 AS item_id
  FROM events WHERE event_type = 'signup')"""


def _r(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def users_of(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.user_behavior_aggregates(A.table(spark, d, "events"))


def items_of(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.item_aggregates(A.interactions(spark, d))


def requests_of(spark: SparkSession, d: str) -> DataFrame:
    events = A.table(spark, d, "events").filter(F.col("event_type") == "signup")
    return events.select(
        F.col("event_id").alias("pos"), (F.col("user_id") * 3).alias("user_id"),
        (A.item_of(F.col("props")) * 2).alias("item_id"),
    )


def scan_parquet(spark, d):
    events = A.table(spark, d, "events")
    return files.scan_parquet(spark, f"{d}/events.parquet", events.schema).select("event_id", "user_id", "event_type", "value")


def jsonl_roundtrip(spark, d):
    rows = A.interactions(spark, d).select(
        F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("item_id").cast("string"),
        "event_type", "category", "price", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    path = scratch_path(spark, "interactions-json")
    files.write_jsonl(rows, path)
    back = files.scan_jsonl(spark, path, files.INTERACTIONS)
    return back.withColumn("event_time", S.parse_event_time(F.col("timestamp")).cast("timestamp_ntz")).drop("timestamp")


def resolve_source(spark, d):
    source = files.BatchSource(type="parquet", path=f"{d}/orders.parquet", timestamp_field="o_orderdate")
    return files.resolve_source(spark, source).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.min(source.timestamp_field).alias("first_at")
    )


def _payloads(spark, d):
    """The event log as JSON text; errors become broken payloads and sign-ups lose their user."""
    e = A.table(spark, d, "events")
    user = F.when(F.col("event_type") == "signup", "").otherwise(F.col("user_id").cast("string"))
    text = F.to_json(F.struct(user.alias("user_id"), "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")))
    return e.select("event_id", F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(text).alias("value"))


def parse_events(spark, d):
    return counts.parse_events(_payloads(spark, d)).select(
        "event_id", "user_id", "event_type",
        S.parse_event_time(F.col("timestamp")).cast("timestamp_ntz").alias("event_time"),
    )


def valid_events(spark, d):
    return counts.valid_events(counts.parse_events(_payloads(spark, d))).select("event_id", "user_id", "event_type")


def parse_event_time(spark, d):
    e = A.table(spark, d, "events")
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(plain, F.lit("Z"))).when(F.col("event_id") % 3 == 1, plain).otherwise(F.col("props"))
    return e.select("event_id", S.parse_event_time(text).cast("timestamp_ntz").alias("event_time"))


def user_behavior_aggregates(spark, d):
    return users_of(spark, d)


def item_aggregates(spark, d):
    return items_of(spark, d)


def safe_ratio(spark, d):
    per_item = A.interactions(spark, d).groupBy("item_id", "user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    return per_item.select("item_id", "user_id", S.safe_ratio(F.col("purchases"), F.col("views")).alias("rate"))


def compile_feature_view(spark, d):
    source = files.BatchSource(path=f"{d}/events.parquet", timestamp_field="ts")
    return fv.materialize(spark, fv.user_behavior_view(source))


def fv_transformation(spark, d):
    view = fv.FeatureView(
        name="buyers", entities=(fv.USER,), transformation=lambda df: df.filter(F.col("event_type") == "purchase"),
        features=(fv.Feature("purchases", "INT64", aggregate=F.count(F.lit(1))),
                  fv.Feature("spend", "DOUBLE", aggregate=F.sum("value")),
                  fv.Feature("mean_spend", "DOUBLE", derived=S.safe_ratio(F.col("spend"), F.col("purchases")))),
    )
    return _r(fv.compile_feature_view(view, A.table(spark, d, "events")), 9, "spend", "mean_spend")


def entity_counts(spark, d):
    return aggregates.entity_counts(A.interactions(spark, d), "user_id", "item_id")


def format_feature_map(spark, d):
    return fv.user_online_rows(users_of(spark, d)).select("key", F.explode("features").alias("field", "value"))


def entity_key(spark, d):
    return items_of(spark, d).select("item_id", S.entity_key("item_aggregates", "item", F.col("item_id")).alias("key"))


def _online_table(spark, d):
    path = scratch_path(spark, "online")
    online.online_sink(fv.user_online_rows(users_of(spark, d)), path)
    online.online_sink(fv.item_online_rows(items_of(spark, d)), path)
    return online.read_online(spark, path)


def online_sink(spark, d):
    return _online_table(spark, d).select("key", F.explode("features").alias("field", "value"))


def key_scan(spark, d):
    return online.key_scan(_online_table(spark, d), "fv:item_aggregates:item:")


def _log_table(spark, d) -> LogTable:
    """Users and items, then some users without views, all users whose id starts with 1 deleted, and some of them put back."""
    users, table = fv.user_online_rows(users_of(spark, d)), LogTable(spark, scratch_path(spark, "log-table"))
    number = F.element_at(F.split("key", ":"), -1).cast("bigint")
    table.put(users)
    table.put(fv.item_online_rows(items_of(spark, d)))
    table.put(users.filter(number % 3 == 0).withColumn("features", F.create_map(F.lit("user_view_count"), F.lit("0"))))
    table.delete_prefix("fv:user_aggregates:user:1")
    table.put(users.filter(number % 5 == 0))
    table.delete(users.filter(number % 7 == 0).select("key"))
    return table


def online_upsert(spark, d):
    """The log-structured table after upserts and deletions."""
    return _log_table(spark, d).read().select("key", F.explode("features").alias("field", "value"))


def online_compact(spark, d):
    """The same table from one merged delta."""
    table = _log_table(spark, d)
    table.compact()
    return table.read().select("key", F.explode("features").alias("field", "value"))


def stored_prefix_scan(spark, d):
    """Keys left under a prefix that was deleted in the stored table."""
    return online.key_scan(_log_table(spark, d).read(), "fv:user_aggregates:user:1")


def online_lookup(spark, d):
    """Users' features as serving reads them back: rates carry the four stored decimals."""
    table = _online_table(spark, d)
    users = lookups.from_online(table, "user_aggregates", "user", "user_id", {**lookups.USER_DEFAULTS, "user_age": 18})
    return users.withColumn("user_id", F.col("user_id").cast("bigint"))


def event_log_days(spark, d):
    """Three days of the log, read from its daily folders."""
    path = scratch_path(spark, "event-log")
    files.write_event_log(A.table(spark, d, "events"), path)
    days = files.read_event_log(spark, path, date(2024, 1, 10), date(2024, 1, 12))
    return days.groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 6).alias("value"))


def user_feature_lookup(spark, d):
    return lookups.user_feature_lookup(requests_of(spark, d).select("pos", "user_id"), users_of(spark, d))


def item_feature_lookup(spark, d):
    return lookups.item_feature_lookup(requests_of(spark, d).select("pos", "item_id"), items_of(spark, d))


def user_item_features(spark, d):
    return lookups.user_item_features(requests_of(spark, d), users_of(spark, d), items_of(spark, d))


def cold_start_defaults(spark, d):
    bare = requests_of(spark, d).select("pos", "item_id").join(items_of(spark, d), "item_id", "left")
    return lookups.cold_start_defaults(bare, {"category": "none", "popularity": -1}).select("pos", "item_id", "category", "popularity")


def numeric_cast_default(spark, d):
    e = A.table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.col("props")).when(F.col("event_type") != "signup", F.col("value").cast("string"))
    return e.select("event_id", S.numeric_cast_default(text, 50.0).alias("price"))


def _dirty(spark, d):
    """Prices with the sign-ups' values missing and the errors' values negated."""
    kind = F.col("event_type")
    price = F.when(kind == "error", -F.col("value")).when(kind != "signup", F.col("value"))
    return A.table(spark, d, "events").select("user_id", "event_type", price.alias("price"))


def dq_null_rate(spark, d):
    return _r(quality.dq_null_rate(_dirty(spark, d), ["user_id", "price"]), 6, "observed")


def dq_between(spark, d):
    return quality.dq_between(_dirty(spark, d), {"price": (0.0, 300.0), "user_id": (0, 1e15)})


CONTRACT = [quality.Exists(c) for c in ("user_id", "item_id", "event_type", "price")] + [
    quality.NotNull("user_id"), quality.NotNull("price"), quality.NotNull("item_id"), quality.Between("price", 0.0, 50000.0),
]


def dq_report(spark, d):
    return _r(quality.dq_report(_dirty(spark, d), CONTRACT), 6, "observed")


def dq_passed(spark, d):
    return quality.dq_passed(quality.dq_report(_dirty(spark, d), CONTRACT))


def query_group_sizes(spark, d):
    return aggregates.query_group_sizes(A.table(spark, d, "events"))


def sort_by_query(spark, d):
    return aggregates.sort_by_query(A.table(spark, d, "events").select("user_id", "ts", "event_id"), "user_id", "ts", "event_id")


def hier_rollup(spark, d):
    region, nation, customer, orders = (A.table(spark, d, t) for t in ("region", "nation", "customer", "orders"))
    per_customer = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    rows = (
        per_customer.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    out = aggregates.hier_rollup(rows, ("r_name", "n_name"), revenue=F.sum("revenue"), orders=F.sum("orders"))
    return _r(out, 2, "revenue")


def pit_join(spark, d):
    e = A.interactions(spark, d)
    labels = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", F.col("ts").alias("label_ts"))
    views = e.filter(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("view_id"), "item_id", "price"
    )
    return asof.pit_join(labels, views, "user_id", "label_ts", "seen_at", ["item_id", "price"], "view_id", ttl=timedelta(days=2))


def lambda_merge(spark, d):
    e, cutoff = A.table(spark, d, "events"), F.lit("2024-01-20").cast("timestamp_ntz")
    snapshot = aggregates.user_behavior_aggregates(e.filter(F.col("ts") <= cutoff))
    later = aggregates.user_behavior_aggregates(e.filter(F.col("ts") > cutoff))
    return aggregates.lambda_merge(snapshot, later)


QUERIES = {
    f.__name__: f
    for f in (
        scan_parquet, jsonl_roundtrip, resolve_source, parse_events, valid_events, parse_event_time, user_behavior_aggregates,
        item_aggregates, safe_ratio, compile_feature_view, fv_transformation, entity_counts, format_feature_map, entity_key,
        online_sink, key_scan, online_upsert, online_compact, stored_prefix_scan, online_lookup, event_log_days, user_feature_lookup, item_feature_lookup, user_item_features, cold_start_defaults,
        numeric_cast_default, dq_null_rate, dq_between, dq_report, dq_passed, query_group_sizes, sort_by_query, hier_rollup,
        pit_join, lambda_merge,
    )
}

_USER_FIELDS = """
  SELECT 'fv:user_aggregates:user:' || user_id AS key, unnest(['user_view_count', 'user_purchase_count', 'user_conversion_rate']) AS field,
         unnest([CAST(user_view_count AS VARCHAR), CAST(user_purchase_count AS VARCHAR), printf('%.4f', user_conversion_rate)]) AS value
  FROM users"""
_ITEM_FIELDS = """
  SELECT 'fv:item_aggregates:item:' || item_id AS key, unnest(['category', 'base_price', 'popularity']) AS field,
         unnest([category, CAST(base_price AS VARCHAR), CAST(popularity AS VARCHAR)]) AS value
  FROM items"""
_LOG_TABLE = f"""f AS ({_USER_FIELDS}),
  k AS (SELECT *, CAST(regexp_extract(key, '[0-9]+$') AS BIGINT) AS n FROM f),
  left_ AS (SELECT key, field, value FROM k WHERE n % 7 <> 0 AND (n % 5 = 0 OR (n % 3 <> 0 AND NOT starts_with(key, 'fv:user_aggregates:user:1')))
    UNION ALL SELECT DISTINCT key, 'user_view_count', '0' FROM k WHERE n % 7 <> 0 AND n % 5 <> 0 AND n % 3 = 0 AND NOT starts_with(key, 'fv:user_aggregates:user:1'))"""
_DIRTY = """dirty AS (
  SELECT user_id, event_type, CASE WHEN event_type = 'error' THEN -value WHEN event_type <> 'signup' THEN value END AS price FROM events)"""
_CONTRACT = """checks AS (
  SELECT 0 AS rule_no, 'exists' AS rule, 'user_id' AS column_name, 1.0::DOUBLE AS observed, true AS passed
  UNION ALL SELECT 1, 'exists', 'item_id', 0.0, false
  UNION ALL SELECT 2, 'exists', 'event_type', 1.0, true
  UNION ALL SELECT 3, 'exists', 'price', 1.0, true
  UNION ALL SELECT 4, 'not_null', 'user_id', round(count(*) FILTER (user_id IS NULL) / count(*), 6), count(*) FILTER (user_id IS NULL) / count(*) <= 0.01 FROM dirty
  UNION ALL SELECT 5, 'not_null', 'price', round(count(*) FILTER (price IS NULL) / count(*), 6), count(*) FILTER (price IS NULL) / count(*) <= 0.01 FROM dirty
  UNION ALL SELECT 7, 'between', 'price', CAST(count(*) FILTER (price < 0 OR price > 50000) AS DOUBLE), count(*) FILTER (price < 0 OR price > 50000) = 0 FROM dirty)"""

ORACLE = {
    "scan_parquet": "SELECT event_id, user_id, event_type, value FROM events",
    "jsonl_roundtrip": f"""WITH {INTERACTIONS} SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(item_id AS VARCHAR) AS item_id, event_type, category, price, ts AS event_time FROM interactions""",
    "resolve_source": "SELECT o_orderstatus, count(*) AS orders, min(o_orderdate) AS first_at FROM orders GROUP BY 1",
    "parse_events": """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
        CASE WHEN event_type <> 'error' THEN event_type END AS event_type, CASE WHEN event_type <> 'error' THEN ts END AS event_time FROM events""",
    "valid_events": "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')",
    "parse_event_time": "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN ts END AS event_time FROM events",
    "user_behavior_aggregates": f"WITH {USERS} SELECT * FROM users",
    "item_aggregates": f"WITH {INTERACTIONS}, {ITEMS} SELECT * FROM items",
    "safe_ratio": f"""WITH {INTERACTIONS}, c AS (SELECT item_id, user_id, count(*) FILTER (event_type = 'view') AS v,
        count(*) FILTER (event_type = 'purchase') AS p FROM interactions GROUP BY 1, 2)
        SELECT item_id, user_id, CASE WHEN v > 0 THEN p / v ELSE 0.0 END AS rate FROM c""",
    "compile_feature_view": f"WITH {USERS} SELECT * FROM users",
    "fv_transformation": """SELECT user_id, count(*) AS purchases, round(sum(value), 9) AS spend, round(sum(value) / count(*), 9) AS mean_spend
        FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "entity_counts": f"WITH {INTERACTIONS} SELECT count(DISTINCT user_id) AS n_user_id, count(DISTINCT item_id) AS n_item_id FROM interactions",
    "format_feature_map": f"WITH {USERS} {_USER_FIELDS}",
    "entity_key": f"WITH {INTERACTIONS} SELECT DISTINCT item_id, 'fv:item_aggregates:item:' || item_id AS key FROM interactions",
    "online_sink": f"WITH {INTERACTIONS}, {USERS}, {ITEMS} {_USER_FIELDS} UNION ALL {_ITEM_FIELDS}",
    "online_upsert": f"WITH {INTERACTIONS}, {USERS}, {ITEMS}, {_LOG_TABLE} SELECT * FROM left_ UNION ALL {_ITEM_FIELDS}",
    "online_compact": f"WITH {INTERACTIONS}, {USERS}, {ITEMS}, {_LOG_TABLE} SELECT * FROM left_ UNION ALL {_ITEM_FIELDS}",
    "stored_prefix_scan": f"""WITH {USERS}, {_LOG_TABLE} SELECT DISTINCT key, regexp_extract(key, '[0-9]+$') AS id FROM left_
      WHERE starts_with(key, 'fv:user_aggregates:user:1')""",
    "key_scan": f"WITH {INTERACTIONS} SELECT DISTINCT 'fv:item_aggregates:item:' || item_id AS key, CAST(item_id AS VARCHAR) AS id FROM interactions",
    "online_lookup": f"""WITH {USERS} SELECT user_id, user_view_count, user_purchase_count,
        CAST(printf('%.4f', user_conversion_rate) AS DOUBLE) AS user_conversion_rate, 18::BIGINT AS user_age FROM users""",
    "event_log_days": """SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events, round(sum(value), 6) AS value FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY 1, 2""",
    "user_feature_lookup": f"""WITH {REQUESTS}, {USERS} SELECT pos, r.user_id, coalesce(user_view_count, 0) AS user_view_count,
        coalesce(user_purchase_count, 0) AS user_purchase_count, coalesce(user_conversion_rate, 0.0) AS user_conversion_rate
        FROM requests r LEFT JOIN users u ON r.user_id = u.user_id""",
    "item_feature_lookup": f"""WITH {INTERACTIONS}, {REQUESTS}, {ITEMS} SELECT pos, r.item_id, coalesce(category, 'unknown') AS category,
        coalesce(base_price, 0.0) AS base_price, coalesce(popularity, 0) AS popularity FROM requests r LEFT JOIN items i ON r.item_id = i.item_id""",
    "user_item_features": f"""WITH {INTERACTIONS}, {REQUESTS}, {USERS}, {ITEMS} SELECT pos, r.user_id, r.item_id,
        coalesce(user_view_count, 0) AS user_view_count, coalesce(user_purchase_count, 0) AS user_purchase_count,
        coalesce(user_conversion_rate, 0.0) AS user_conversion_rate, coalesce(category, 'unknown') AS category,
        coalesce(base_price, 0.0) AS base_price, coalesce(popularity, 0) AS popularity
        FROM requests r LEFT JOIN users u ON r.user_id = u.user_id LEFT JOIN items i ON r.item_id = i.item_id""",
    "cold_start_defaults": f"""WITH {INTERACTIONS}, {REQUESTS}, {ITEMS} SELECT pos, r.item_id, coalesce(category, 'none') AS category,
        coalesce(popularity, -1) AS popularity FROM requests r LEFT JOIN items i ON r.item_id = i.item_id""",
    "numeric_cast_default": """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 50.0 ELSE value END AS price FROM events""",
    "dq_null_rate": f"""WITH {_DIRTY} SELECT 0 AS rule_no, 'not_null' AS rule, 'user_id' AS column_name,
        round(count(*) FILTER (user_id IS NULL) / count(*), 6) AS observed, count(*) FILTER (user_id IS NULL) / count(*) <= 0.01 AS passed FROM dirty
        UNION ALL SELECT 1, 'not_null', 'price', round(count(*) FILTER (price IS NULL) / count(*), 6), count(*) FILTER (price IS NULL) / count(*) <= 0.01 FROM dirty""",
    "dq_between": f"""WITH {_DIRTY} SELECT 0 AS rule_no, 'between' AS rule, 'price' AS column_name,
        CAST(count(*) FILTER (price < 0 OR price > 300) AS DOUBLE) AS observed, count(*) FILTER (price < 0 OR price > 300) = 0 AS passed FROM dirty
        UNION ALL SELECT 1, 'between', 'user_id', CAST(count(*) FILTER (user_id < 0 OR user_id > 1e15) AS DOUBLE), count(*) FILTER (user_id < 0 OR user_id > 1e15) = 0 FROM dirty""",
    "dq_report": f"WITH {_DIRTY}, {_CONTRACT} SELECT * FROM checks",
    "dq_passed": f"WITH {_DIRTY}, {_CONTRACT} SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS errors FROM checks",
    "query_group_sizes": "SELECT user_id, count(*) AS group_size FROM events GROUP BY 1 ORDER BY 1",
    "sort_by_query": "SELECT user_id, ts, event_id FROM events ORDER BY 1, 2, 3",
    "hier_rollup": """SELECT r_name, n_name, CAST(grouping(r_name) + grouping(n_name) AS INTEGER) AS level, round(sum(o_totalprice), 2) AS revenue,
        count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""",
    "pit_join": f"""WITH {INTERACTIONS}, l AS (SELECT event_id, user_id, ts AS label_ts FROM interactions WHERE event_type = 'purchase'),
        f AS (SELECT user_id, ts, item_id, price FROM interactions WHERE event_type = 'view'),
        j AS (SELECT l.*, f.ts AS matched_ts, f.item_id, f.price, f.ts >= l.label_ts - INTERVAL 2 DAYS AS fresh
              FROM l ASOF LEFT JOIN f ON l.user_id = f.user_id AND l.label_ts >= f.ts)
        SELECT event_id, user_id, label_ts, CASE WHEN fresh THEN matched_ts END AS matched_ts, CASE WHEN fresh THEN item_id END AS item_id,
        CASE WHEN fresh THEN price END AS price FROM j""",
    "lambda_merge": f"WITH {USERS} SELECT * FROM users",
}
