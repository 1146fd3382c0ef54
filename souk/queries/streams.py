"""Streaming queries, run over everything available; each returns the state or the rows it wrote."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.scalars import request_key
from souk.operators.aggregates import lambda_merge, user_behavior_aggregates
from souk.queries.features import USERS
from souk.queries.operations import _queue
from souk.queries.statistics import METRICS, _decision
from souk.session import rocksdb_state, scratch_path
from souk.sources import adapters as A
from souk.sources import online, streams
from souk.streaming import cache, counts, review


def _payload_stream(spark, d) -> DataFrame:
    """The event log as a stream of JSON text; error events arrive broken."""
    events = streams.table_stream(spark, d, "events")
    text = F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), "event_type"))
    return events.select(F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(text).alias("value"))


def _latest_state(table: DataFrame, key: str) -> DataFrame:
    """The last written row per key of an update-mode table with one folder per micro-batch."""
    rest = [c for c in table.columns if c not in (key, "batch")]
    return table.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("s")).select(key, "s.*")


def _drained(stream: DataFrame, name: str) -> DataFrame:
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, name)
    streams.drain(stream, lambda rows, n: rows.write.mode("overwrite").parquet(f"{path}/batch={n}"))
    return spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def stream_source(spark, d):
    return streams.drain_to_table(streams.table_stream(spark, d, "events").select("event_id", "user_id", "ts"), "source")


def stream_user_counts(spark, d):
    state = _latest_state(_drained(counts.stream_user_counts(_payload_stream(spark, d)), "counts"), "user_id")
    return state.withColumn("user_id", F.col("user_id").cast("bigint"))


def online_incr_sink(spark, d):
    path = scratch_path(spark, "increments")
    write = online.write_increments(path)
    streams.drain(_payload_stream(spark, d), lambda rows, n: write(counts.counter_deltas(rows), n), "append")
    return online.read_increments(spark, path)


def stream_lambda_merge(spark, d):
    """A snapshot of everything up to a cutoff, and streamed increments after it."""
    cutoff = F.lit("2024-01-20").cast("timestamp_ntz")
    snapshot = user_behavior_aggregates(A.table(spark, d, "events").filter(F.col("ts") <= cutoff))
    late = streams.table_stream(spark, d, "events").filter(F.col("ts") > cutoff)
    text = late.select(F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), "event_type")).alias("value"))
    delta = _latest_state(_drained(counts.stream_user_counts(text), "late-counts"), "user_id")
    return lambda_merge(snapshot, delta.withColumn("user_id", F.col("user_id").cast("bigint")))


def stream_window_counts(spark, d):
    """Six-hour counts of the windows that are final once all events have arrived."""
    out = counts.stream_window_counts(streams.table_stream(spark, d, "events"), width="6 hours")
    return streams.drain_to_table(out, "windows").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n"
    )


def stream_window_join(spark, d):
    """Purchases within six hours after the same user viewed any item."""
    log = A.as_interactions(streams.table_stream(spark, d, "events"))
    views = log.filter(F.col("event_type") == "view").select("user_id", F.col("item_id").alias("viewed"), F.col("event_id").alias("view_id"), F.col("ts").alias("left_ts"))
    log2 = A.as_interactions(streams.table_stream(spark, d, "events"))
    buys = log2.filter(F.col("event_type") == "purchase").select("user_id", F.col("item_id").alias("bought"), F.col("event_id").alias("buy_id"), F.col("ts").alias("right_ts"))
    out = counts.stream_window_join(views, buys, ("user_id",), within="6 HOURS")
    return streams.drain_to_table(out, "conversions").select("user_id", "viewed", "bought", "view_id", "buy_id")


def ttl_dedup(spark, d):
    """Per endpoint and user, the requests that are computed when a response lives for a day."""
    endpoint = F.concat(F.lit("/"), "event_type")
    requests = streams.table_stream(spark, d, "events").select(request_key(endpoint, F.col("user_id")).alias("key"), "ts", "event_id")
    newest = A.table(spark, d, "events").agg(F.max("ts").alias("ts")).filter("ts is not null")
    last = newest.select(*[(F.col("ts") + F.expr("interval 1 hour")).alias("ts") if c == "ts" else F.lit(None).cast(t).alias(c) for c, t in requests.dtypes])
    computed = streams.drain_whole(requests, lambda rows: cache.ttl_dedup(rows, ttl=timedelta(days=1)), last, "dedup")
    return computed.select("key", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


def stream_guardrail(spark, d):
    observed = streams.table_stream(spark, d, "events").select(
        F.when(F.col("user_id") % 2 == 0, "control").otherwise("treatment").alias("variant"), F.col("value").alias("metric")
    )
    state = _drained(review.stream_guardrail(observed), "guardrail")
    last = _latest_state(state.withColumn("test", F.lit("all")), "test").drop("test")
    return last.withColumn("z", F.round("z", 6))


def stream_hitl(spark, d):
    events = lambda: streams.table_stream(spark, d, "events")
    item = A.item_of(F.col("props"))
    alerts = events().filter((F.col("event_type") == "purchase") & (F.col("value") > 30)).select(
        item.alias("transaction_id"), F.col("event_id").alias("alert_id"), "user_id", F.col("value").alias("amount"), F.col("ts").alias("alert_at")
    )
    decisions = events().filter(F.col("event_type") == "signup").select(
        item.alias("transaction_id"), F.col("event_id").alias("decision_id"),
        F.when(F.col("user_id") % 3 == 0, "Approved").otherwise("Blocked").alias("action"), F.col("user_id").alias("reviewer_id"), F.col("ts").alias("decided_at")
    )
    with rocksdb_state(spark):
        queue = _latest_state(_drained(review.stream_hitl(alerts, decisions), "queue"), "transaction_id")
    return queue.withColumn("alert_at", F.col("alert_at").cast("timestamp_ntz"))


QUERIES = {
    f.__name__: f
    for f in (
        stream_source, stream_user_counts, online_incr_sink, stream_lambda_merge, stream_window_counts, stream_window_join,
        ttl_dedup, stream_guardrail, stream_hitl,
    )
}

ORACLE = {
    "stream_source": "SELECT event_id, user_id, ts FROM events",
    "stream_user_counts": f"WITH {USERS} SELECT * FROM users WHERE user_view_count + user_purchase_count > 0",
    "online_incr_sink": """SELECT 'fv:user_aggregates:user:' || user_id AS key, CASE event_type WHEN 'view' THEN 'user_view_count' ELSE 'user_purchase_count' END AS field,
      count(*) AS value FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2""",
    "stream_lambda_merge": f"WITH {USERS} SELECT * FROM users",
    "stream_window_counts": """WITH w AS (SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
      SELECT window_start, window_start + INTERVAL 6 HOURS AS window_end, event_type, n FROM w
      WHERE window_start + INTERVAL 6 HOURS <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTES FROM events)""",
    "stream_window_join": """WITH i AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id FROM events)
      SELECT v.user_id, v.item_id AS viewed, b.item_id AS bought, v.event_id AS view_id, b.event_id AS buy_id FROM i v JOIN i b ON v.user_id = b.user_id
      AND b.ts >= v.ts AND b.ts <= v.ts + INTERVAL 6 HOURS WHERE v.event_type = 'view' AND b.event_type = 'purchase'""",
    "ttl_dedup": """WITH RECURSIVE r AS (SELECT 'cache:/' || event_type || ':' || user_id AS key, ts, event_id FROM events),
      chain AS (SELECT key, min(ts) AS ts FROM r GROUP BY key UNION ALL
        SELECT c.key, min(r.ts) FROM chain c JOIN r ON r.key = c.key AND r.ts >= c.ts + INTERVAL 1 DAY GROUP BY c.key)
      SELECT r.key, r.ts, r.event_id FROM chain JOIN r ON r.key = chain.key AND r.ts = chain.ts""",
    "stream_guardrail": f"""WITH {METRICS}, g AS (SELECT count(*) FILTER (variant = 'control') AS nc, count(*) FILTER (variant = 'treatment') AS nt,
      (avg(metric) FILTER (variant = 'treatment') - avg(metric) FILTER (variant = 'control')) /
      sqrt(var_pop(metric) FILTER (variant = 'control') / count(*) FILTER (variant = 'control') + var_pop(metric) FILTER (variant = 'treatment') / count(*) FILTER (variant = 'treatment')) AS z FROM metrics)
      SELECT nc AS n_control, nt AS n_treatment, round(z, 6) AS z, {_decision()} AS decision FROM g""",
    "stream_hitl": f"""WITH {_queue(30)} SELECT CAST(l.transaction_id AS VARCHAR) AS transaction_id, CAST(alert_id AS VARCHAR) AS alert_id, CAST(user_id AS VARCHAR) AS user_id,
      amount, alert_at, coalesce(lower(action), 'pending') AS status, CAST(reviewer_id AS VARCHAR) AS moderated_by
      FROM latest l LEFT JOIN effective e ON l.transaction_id = e.transaction_id""",
}
