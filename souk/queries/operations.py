"""Queries over moderation, request metrics, run tracking, graph features and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import scalars as S
from souk.operators import aggregates, graph, moderation, monitoring, sketches
from souk.queries.features import INTERACTIONS
from souk.session import scratch_path
from souk.sources import adapters as A
from souk.sources import runs

FEATURES = len(A.NODE_FEATURES)


def _r(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def latest_alert(spark, d):
    return moderation.latest_alert(A.alerts(spark, d))


def hitl_status(spark, d):
    return moderation.hitl_status(A.alerts(spark, d), A.decisions(spark, d))


def hitl_pending(spark, d):
    return moderation.hitl_pending(A.alerts(spark, d, floor=200.0), A.decisions(spark, d))


def hitl_rejects(spark, d):
    return moderation.hitl_rejects(A.alerts(spark, d, floor=100.0), A.decisions(spark, d))


def red_metrics(spark, d):
    return monitoring.red_metrics(A.request_log(spark, d))


def latency_histogram(spark, d):
    return _r(monitoring.latency_histogram(A.request_log(spark, d)), 6, "total_latency")


def latency_histogram_seconds(spark, d):
    log = A.request_log(spark, d).withColumn("latency", F.col("latency") / 1000)
    out = monitoring.latency_histogram(log, ("method", "endpoint"), buckets=monitoring.SECOND_BUCKETS)
    return _r(out, 6, "total_latency")


def latency_p99(spark, d):
    return _r(monitoring.latency_p99(A.request_log(spark, d)), 6, "p99")


def latency_p99_days(spark, d):
    """The tail latency from stored day sketches, and whether its exact rank is within the stated error."""
    log, path = A.request_log(spark, d).filter(F.col("endpoint") != monitoring.UNMEASURED), scratch_path(spark, "latency-days")
    sketches.write_quantile_days(log, path, F.to_date("ts"), ["endpoint"], "latency")
    found = sketches.merged_quantile(sketches.read_days(spark, path), ["endpoint"], 0.99)
    ranks = log.join(found, "endpoint").groupBy("endpoint", "n").agg(
        F.avg((F.col("latency") < F.col("quantile")).cast("double")).alias("below"), F.avg((F.col("latency") <= F.col("quantile")).cast("double")).alias("upto")
    )
    near = (F.col("below") <= 0.99 + sketches.RANK_ERROR) & (F.col("upto") >= 0.99 - sketches.RANK_ERROR)
    return ranks.select("endpoint", "n", near.alias("within_error"))


def entity_counts_days(spark, d):
    """Distinct users and items of three days and of all, from stored day sketches, beside the exact counts."""
    log, path = A.interactions(spark, d), scratch_path(spark, "entity-days")
    sketches.write_count_days(log, path, F.to_date("ts"), ["user_id", "item_id"])
    spans = {"all": (None, None), "three": (date(2024, 1, 10), date(2024, 1, 12))}
    out = []
    for span, (first, last) in spans.items():
        rows = log if first is None else log.filter(F.to_date("ts").between(F.lit(first), F.lit(last)))
        exact = aggregates.entity_counts(rows, "user_id", "item_id").select(F.inline(F.array(*[
            F.struct(F.lit(e).alias("entity"), F.col(f"n_{e}").alias("exact")) for e in ("user_id", "item_id")
        ])))
        merged = sketches.merged_counts(sketches.read_days(spark, path, first, last))
        near = F.abs(F.col("distinct") - F.col("exact")) <= sketches.COUNT_ERROR * F.col("exact")
        out.append(exact.join(merged, "entity").select(F.lit(span).alias("span"), "entity", "exact", near.alias("within_error")))
    return out[0].union(out[1])


def request_key(spark, d):
    log = A.request_log(spark, d)
    key = S.request_key(F.lit("recommend"), F.col("user_id"), {"k": F.lit("20"), "city": S.json_text(F.col("endpoint"))})
    return log.select("event_id", key.alias("key"), S.request_key(F.col("endpoint"), F.col("user_id")).alias("plain_key"))


def _metrics_table(spark, d) -> DataFrame:
    """Per user and day a logged metric, as if every user were a run and every event type an experiment."""
    rows = A.table(spark, d, "events").groupBy(
        F.col("event_type").alias("experiment"), F.col("user_id").cast("string").alias("run_id"),
        F.dayofmonth("ts").alias("step"),
    ).agg(F.round(F.sum("value"), 4).alias("value")).withColumn("metric", F.lit("auc"))
    path = scratch_path(spark, "runs")
    runs.append_metrics(rows.filter(F.col("step") <= 15), path)
    runs.append_metrics(rows.filter(F.col("step") > 15), path)
    return runs.read_metrics(spark, path)


def metrics_table(spark, d):
    return _metrics_table(spark, d)


def best_run(spark, d):
    return runs.best_run(_metrics_table(spark, d), "auc")


def shared_attr_edges(spark, d):
    return graph.shared_attr_edges(A.customer_parts(spark, d))


def neighbor_mean(spark, d):
    """Means on a log scale, where rounding does not meet exact halves."""
    edges = graph.both_directions(graph.shared_attr_edges(A.customer_parts(spark, d)))
    out = graph.neighbor_mean(A.customer_nodes(spark, d), edges, FEATURES)
    return out.select("node_id", *[F.round(F.log1p(F.col("neighbor_mean")[i]), 8).alias(n) for i, n in enumerate(A.NODE_FEATURES)])


def shared_attr_mean(spark, d):
    out = graph.shared_attr_mean(A.customer_nodes(spark, d), A.customer_parts(spark, d), FEATURES)
    return out.select("node_id", *[F.round(F.log1p(F.col("neighbor_mean")[i]), 8).alias(n) for i, n in enumerate(A.NODE_FEATURES)])


def risk_consensus(spark, d):
    x = F.col("value") / 100
    rows = A.table(spark, d, "events").select("event_id", S.risk_consensus(S.sigmoid(x - 1), x, x * x).alias("risk"))
    return _r(rows, 6, "risk")


QUERIES = {
    f.__name__: f
    for f in (
        latest_alert, hitl_status, hitl_pending, hitl_rejects, red_metrics, latency_histogram, latency_histogram_seconds,
        latency_p99, latency_p99_days, entity_counts_days, request_key, metrics_table, best_run, shared_attr_edges, neighbor_mean, shared_attr_mean, risk_consensus,
    )
}


def _queue(floor: int) -> str:
    return f"""alerts AS (SELECT CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS transaction_id, event_id AS alert_id, user_id, value AS amount, ts AS alert_at
        FROM events WHERE event_type = 'purchase' AND value > {floor}),
      decisions AS (SELECT CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS transaction_id, event_id AS decision_id,
        CASE WHEN user_id % 3 = 0 THEN 'Approved' ELSE 'Blocked' END AS action, user_id AS reviewer_id, ts AS decided_at FROM events WHERE event_type = 'signup'),
      latest AS (SELECT * FROM alerts QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY alert_at DESC, alert_id DESC) = 1),
      effective AS (SELECT d.transaction_id, action, reviewer_id FROM decisions d JOIN latest l ON d.transaction_id = l.transaction_id AND decided_at >= alert_at
        QUALIFY row_number() OVER (PARTITION BY d.transaction_id ORDER BY decided_at, decision_id) = 1)"""


LOG = """log AS (SELECT event_id, user_id, CASE WHEN event_type = 'signup' THEN 'POST' ELSE 'GET' END AS method,
      CASE WHEN event_type = 'click' THEN '/metrics' ELSE '/' || event_type END AS endpoint,
      CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS http_status, value AS latency FROM events)"""


def _histogram(keys: str, value: str, bounds: tuple) -> str:
    lines = [f"SELECT {keys}, '{b}' AS le, count(*) FILTER ({value} <= {b}) AS requests FROM measured GROUP BY {keys}" for b in bounds]
    lines.append(f"SELECT {keys}, '+Inf', count(*) FROM measured GROUP BY {keys}")
    return f"""WITH {LOG}, measured AS (SELECT * FROM log WHERE endpoint <> '/metrics'), h AS ({' UNION ALL '.join(lines)}),
      t AS (SELECT {keys}, round(sum({value}), 6) AS total_latency, count(*) AS total_requests FROM measured GROUP BY {keys})
      SELECT * FROM h JOIN t USING ({keys})"""


RUNS = """runs AS (SELECT event_type AS experiment, CAST(user_id AS VARCHAR) AS run_id, 'auc' AS metric, round(sum(value), 4) AS value,
      CAST(day(ts) AS INTEGER) AS step FROM events GROUP BY event_type, user_id, day(ts))"""
PAIRS = "pairs AS (SELECT DISTINCT o_custkey AS u, l_partkey AS a FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
EDGES = f"{PAIRS}, hub AS (SELECT a, min(u) AS src FROM pairs GROUP BY 1), edges AS (SELECT DISTINCT src, u AS dst FROM pairs JOIN hub USING (a) WHERE u > src)"
_STATS = [
    "CAST(count(*) AS DOUBLE)", "sum(o_totalprice)", "avg(o_totalprice)", "max(o_totalprice)", "min(o_totalprice)",
    "CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE)", "CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE)",
    "CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE)", "CAST(count(*) FILTER (o_orderpriority LIKE '1%') AS DOUBLE)",
    "CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS DOUBLE)",
]
NODES = (
    "stats AS (SELECT o_custkey, " + ", ".join(f"{s} AS {n}" for s, n in zip(_STATS, A.NODE_FEATURES)) + " FROM orders GROUP BY 1), "
    "nodes AS (SELECT c_custkey AS node_id, " + ", ".join(f"coalesce({n}, 0.0) AS {n}" for n in A.NODE_FEATURES)
    + " FROM customer LEFT JOIN stats ON c_custkey = o_custkey)"
)

ORACLE = {
    "latest_alert": f"WITH {_queue(30)} SELECT * FROM latest",
    "hitl_status": f"""WITH {_queue(30)} SELECT l.*, coalesce(lower(action), 'pending') AS status, reviewer_id AS moderated_by
      FROM latest l LEFT JOIN effective e ON l.transaction_id = e.transaction_id""",
    "hitl_pending": f"WITH {_queue(200)} SELECT * FROM latest WHERE transaction_id NOT IN (SELECT transaction_id FROM effective)",
    "hitl_rejects": f"""WITH {_queue(100)}, j AS (SELECT d.*, a.alert_id FROM decisions d ASOF LEFT JOIN alerts a ON d.transaction_id = a.transaction_id AND d.decided_at >= a.alert_at),
      r AS (SELECT *, row_number() OVER (PARTITION BY transaction_id, alert_id ORDER BY decided_at, decision_id) AS i FROM j)
      SELECT transaction_id, decision_id, action, reviewer_id, decided_at, CASE WHEN alert_id IS NULL THEN 'not_found' ELSE 'already_resolved' END AS reason
      FROM r WHERE alert_id IS NULL OR i > 1""",
    "red_metrics": f"WITH {LOG} SELECT method, endpoint, http_status, count(*) AS requests FROM log WHERE endpoint <> '/metrics' GROUP BY 1, 2, 3",
    "latency_histogram": _histogram("endpoint", "latency", monitoring.MILLISECOND_BUCKETS),
    "latency_histogram_seconds": _histogram("method, endpoint", "(latency / 1000)", monitoring.SECOND_BUCKETS),
    "latency_p99": f"WITH {LOG} SELECT endpoint, round(quantile_cont(latency, 0.99), 6) AS p99 FROM log WHERE endpoint <> '/metrics' GROUP BY 1",
    "latency_p99_days": f"WITH {LOG} SELECT endpoint, count(latency) AS n, true AS within_error FROM log WHERE endpoint <> '/metrics' GROUP BY 1",
    "entity_counts_days": f"""WITH {INTERACTIONS}, c AS (SELECT 'all' AS span, user_id, item_id FROM interactions UNION ALL
        SELECT 'three', user_id, item_id FROM interactions WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12')
      SELECT span, 'user_id' AS entity, count(DISTINCT user_id) AS exact, true AS within_error FROM c GROUP BY 1
      UNION ALL SELECT span, 'item_id', count(DISTINCT item_id), true FROM c GROUP BY 1""",
    "request_key": f"""WITH {LOG} SELECT event_id, 'cache:recommend:' || user_id || ':' || substr(sha256('{{"city": "' || endpoint || '", "k": 20}}'), 1, 16) AS key,
      'cache:' || endpoint || ':' || user_id AS plain_key FROM log""",
    "metrics_table": f"WITH {RUNS} SELECT * FROM runs",
    "best_run": f"""WITH {RUNS}, l AS (SELECT experiment, run_id, arg_max(value, step) AS value FROM runs GROUP BY 1, 2)
      SELECT experiment, run_id, value FROM l QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY value DESC, run_id) = 1""",
    "shared_attr_edges": f"WITH {EDGES} SELECT src, dst FROM edges",
    "neighbor_mean": f"WITH {EDGES}, {NODES}, both_ AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges), "
    "m AS (SELECT src, " + ", ".join(f"avg({n}) AS {n}" for n in A.NODE_FEATURES) + " FROM both_ JOIN nodes ON dst = node_id GROUP BY 1) "
    "SELECT node_id, " + ", ".join(f"round(ln(1 + coalesce(m.{n}, 0.0)), 8) AS {n}" for n in A.NODE_FEATURES)
    + " FROM nodes LEFT JOIN m ON node_id = src",
    "shared_attr_mean": f"WITH {PAIRS}, {NODES}, m AS (SELECT x.u AS src, " + ", ".join(f"avg({n}) AS {n}" for n in A.NODE_FEATURES)
    + " FROM pairs x JOIN pairs y ON x.a = y.a AND x.u <> y.u JOIN nodes ON y.u = node_id GROUP BY 1) "
    "SELECT node_id, " + ", ".join(f"round(ln(1 + coalesce(m.{n}, 0.0)), 8) AS {n}" for n in A.NODE_FEATURES)
    + " FROM nodes LEFT JOIN m ON node_id = src",
    "risk_consensus": """WITH s AS (SELECT event_id, value / 100 AS x FROM events)
      SELECT event_id, round(0.4 / (1 + exp(1 - x)) + 0.35 * least(x, 1.0) + 0.25 * least(x * x, 1.0), 6) AS risk FROM s""",
}
