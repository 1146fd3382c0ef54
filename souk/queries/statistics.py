"""Queries over experiments, causal estimates, drift and forecast errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import scalars as S
from souk.operators import causal, drift, evaluation, experiments, series
from souk.sources import adapters as A

DID_START = "1998-06-01"
IMPACT_START = "2000-01-01"
#: Sample sizes per arm at which the guardrail looks; the last is beyond any arm, so that look has every row.
LOOKS = [50, 100, 150, 200, 1000, 4000, 100000, 1 << 62]


def _r(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def pool_arms(spark, d):
    units = A.experiment_units(spark, d).select("unit_id", F.round("y", 6).alias("y"), "variant")
    arm = {v: units.filter(F.col("variant") == v).drop("variant") for v in ("control", "treatment")}
    return experiments.pool_arms(arm["control"], arm["treatment"])


WELCH = ("control_mean", "treatment_mean", "relative_lift_pct", "t_statistic", "df", "p_value")


def ab_welch(spark, d):
    return _r(experiments.ab_welch(A.experiment_units(spark, d)), 6, *WELCH)


def ab_cupac(spark, d):
    return _r(experiments.ab_cupac(A.experiment_units(spark, d)), 6, *WELCH, "theta", "variance_reduction_pct")


def seq_guardrail(spark, d):
    return _r(experiments.seq_guardrail(A.metric_stream(spark, d)), 6, "z")


def seq_guardrail_prefix(spark, d):
    return _r(experiments.seq_guardrail_prefix(A.metric_stream(spark, d), ["ts", "event_id"], LOOKS), 6, "z")


def did_dummies(spark, d):
    flags = S.did_dummies(F.col("time"), F.col("treated"), F.lit(DID_START).cast("timestamp_ntz"))
    return A.did_panel(spark, d).select("time", "target", *[c.alias(n) for n, c in flags.items()])


def did_ols(spark, d):
    out = causal.did_ols(A.did_panel(spark, d), F.lit(DID_START).cast("timestamp_ntz"))
    return _r(_r(out, 4, "effect"), 6, "t_statistic", "p_value", "r_squared")


def ols_fit(spark, d):
    beta = causal.ols_fit(A.daily_revenue(spark, d), "revenue", ["n_orders"])
    return beta.select(F.round(F.col("beta")[0], 2).alias("intercept"), F.round(F.col("beta")[1], 2).alias("slope"))


def _pre_post(spark, d):
    days, start = A.daily_revenue(spark, d), F.lit(IMPACT_START).cast("timestamp_ntz")
    return days.filter(F.col("day") < start), days.filter(F.col("day") >= start)


def causal_impact(spark, d):
    out = causal.causal_impact(*_pre_post(spark, d), "revenue", ["n_orders"])
    out = _r(out, 2, "actual_cumulative", "counterfactual_cumulative", "absolute_uplift")
    return _r(out, 5, "relative_lift_pct", "t_statistic", "df", "p_value")


def pointwise_effect(spark, d):
    out = causal.pointwise_effect(*_pre_post(spark, d), "revenue", ["n_orders"], "day")
    return _r(_r(out, 3, "actual"), 1, "counterfactual", "effect", "cumulative_effect")


def psi(spark, d):
    columns = ["l_extendedprice", "l_quantity", "l_discount"]
    return _r(drift.psi(A.price_samples(spark, d), "is_expected", columns), 6, "psi")


def ks_two_sample(spark, d):
    return _r(drift.ks_two_sample(A.price_samples(spark, d), "is_expected", "l_extendedprice"), 9, "ks_statistic", "p_value")


def forecast_error(spark, d):
    """Error of the previous month's value as a forecast, per brand. A brand has one row per month."""
    sales = A.monthly_brand_sales(spark, d)
    naive = sales.withColumn("y_hat", F.lag("y").over(Window.partitionBy("series_id").orderBy("t")))
    return _r(evaluation.forecast_error(naive.filter(F.col("y_hat").isNotNull()), keys=["series_id"]), 4, "mse", "mape")


def basis_expand(spark, d):
    months = A.monthly_brand_sales(spark, d).select("series_id", "t", S.basis_expand(F.col("t")).alias("x"))
    names = ["one", "t1", "t2", "cos1", "sin1", "cos2", "sin2"]
    return months.select("series_id", "t", *[F.round(F.col("x")[i], 6).alias(n) for i, n in enumerate(names)])


def series_windows(spark, d):
    windows = series.series_windows(A.monthly_brand_sales(spark, d))
    flat = F.posexplode(F.concat("backcast", "forecast")).alias("pos", "y")
    return windows.select("series_id", "t", flat)


def auc(spark, d):
    scored = A.table(spark, d, "events").select(
        F.col("value").alias("score"), (F.col("event_type") == "purchase").cast("int").alias("label")
    )
    return _r(evaluation.auc(scored), 9, "auc")


QUERIES = {
    f.__name__: f
    for f in (
        pool_arms, ab_welch, ab_cupac, seq_guardrail, seq_guardrail_prefix, did_dummies, did_ols, ols_fit, causal_impact,
        pointwise_effect, psi, ks_two_sample, forecast_error, basis_expand, series_windows, auc,
    )
}

STEPS = 4000


def p_value(t: str, df: str) -> str:
    """SQL for the two-sided Student-t p-value: Simpson's rule on the cosine form of the density."""
    weight = f"(CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    angle = f"atan(abs({t}) / sqrt({df}))"
    area = f"list_sum([{weight} * pow(cos(i * {angle} / {STEPS}), {df} - 1) for i in range(0, {STEPS} + 1)]) * {angle} / {STEPS} / 3"
    return f"(1 - 2 / sqrt(pi()) * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) * {area})"


UNITS = """units AS (
  SELECT user_id AS unit_id, CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant,
         sum(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value ELSE 0.0 END) AS y,
         sum(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 0.0 ELSE value END) AS x_pre
  FROM events GROUP BY user_id)"""


def _welch(source: str, y: str) -> str:
    """CTEs from per-unit rows to a tested difference ``w``."""
    return f"""m AS (SELECT avg({y}) FILTER (variant = 'control') AS mc, avg({y}) FILTER (variant = 'treatment') AS mt,
        var_samp({y}) FILTER (variant = 'control') / count({y}) FILTER (variant = 'control') AS a,
        var_samp({y}) FILTER (variant = 'treatment') / count({y}) FILTER (variant = 'treatment') AS b,
        count({y}) FILTER (variant = 'control') AS nc, count({y}) FILTER (variant = 'treatment') AS nt FROM {source}),
      w AS (SELECT *, (mc - mt) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (nc - 1) + b * b / (nt - 1)) AS dof FROM m)"""


_WELCH_OUT = f"""round(mc, 6) AS control_mean, round(mt, 6) AS treatment_mean,
      round(CASE WHEN mc > 0 THEN (mt - mc) / mc * 100 ELSE 0.0 END, 6) AS relative_lift_pct, round(t, 6) AS t_statistic,
      round(dof, 6) AS df, round({p_value('t', 'dof')}, 6) AS p_value, {p_value('t', 'dof')} < 0.05 AS significant"""

METRICS = "metrics AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant, value AS metric, ts, event_id FROM events)"


def _decision(alias: str = "") -> str:
    return """CASE WHEN nc < 50 OR nt < 50 THEN 'GATHERING_DATA' WHEN z <= -2.58 THEN 'STOP_DEGRADATION'
      WHEN z >= 2.58 THEN 'STOP_SUCCESS' ELSE 'CONTINUE' END"""


PANEL = """panel AS (SELECT c_nationkey % 2 AS treated, o_orderdate AS time, o_totalprice AS target,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN 1 ELSE 0 END AS post FROM orders JOIN customer ON o_custkey = c_custkey)"""
DAYS = "days AS (SELECT o_orderdate AS day, sum(o_totalprice) AS revenue, CAST(count(*) AS DOUBLE) AS n_orders FROM orders GROUP BY 1)"
IMPACT = f"""{DAYS}, fit AS (SELECT regr_slope(revenue, n_orders) AS s, regr_intercept(revenue, n_orders) AS i FROM days WHERE day < TIMESTAMP '{IMPACT_START}'),
      post AS (SELECT day, revenue AS y, i + s * n_orders AS c FROM days, fit WHERE day >= TIMESTAMP '{IMPACT_START}')"""
SALES = """sales AS (SELECT p_brand AS series_id, CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS t, sum(l_quantity) AS y
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
SAMPLES = "samples AS (SELECT l_shipdate < TIMESTAMP '1998-06-01' AS early, l_extendedprice, l_quantity, l_discount FROM lineitem)"

_PSI = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(sum((a - e) * ln(a / e)), 6) AS psi, sum((a - e) * ln(a / e)) >= 0.2 AS retrain FROM (
      SELECT bin, greatest(sum(CASE WHEN early THEN 1 ELSE 0 END) / (SELECT count(*) FROM samples WHERE early), 0.0001) AS e,
             greatest(sum(CASE WHEN early THEN 0 ELSE 1 END) / (SELECT count(*) FROM samples WHERE NOT early), 0.0001) AS a
      FROM (SELECT early, CASE WHEN {c} >= q[1] - 0.0001 AND {c} <= q[11] + 0.0001
                               THEN least(len(list_filter(q[2:10], lambda x: x <= {c})), 9) END AS bin
            FROM samples, (SELECT quantile_cont({c}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM samples WHERE early))
      WHERE bin IS NOT NULL GROUP BY bin)"""
    for c in ("l_extendedprice", "l_quantity", "l_discount")
)

ORACLE = {
    "pool_arms": f"WITH {UNITS} SELECT unit_id, round(y, 6) AS y, variant FROM units",
    "ab_welch": f"WITH {UNITS}, {_welch('units', 'y')} SELECT {_WELCH_OUT} FROM w",
    "ab_cupac": f"""WITH {UNITS}, th AS (SELECT CASE WHEN var_pop(x_pre) > 0 THEN covar_samp(y, x_pre) / var_pop(x_pre) ELSE 0.0 END AS theta, avg(x_pre) AS mx FROM units),
      adj AS (SELECT variant, y, y - theta * (x_pre - mx) AS z, theta FROM units, th), {_welch('adj', 'z')}
      SELECT {_WELCH_OUT}, (SELECT round(max(theta), 6) FROM adj) AS theta,
      (SELECT round((var_pop(y) - var_pop(z)) / var_pop(y) * 100, 6) FROM adj) AS variance_reduction_pct FROM w""",
    "seq_guardrail": f"""WITH {METRICS}, g AS (SELECT count(*) FILTER (variant = 'control') AS nc, count(*) FILTER (variant = 'treatment') AS nt,
      (avg(metric) FILTER (variant = 'treatment') - avg(metric) FILTER (variant = 'control')) /
      sqrt(var_pop(metric) FILTER (variant = 'control') / count(*) FILTER (variant = 'control') + var_pop(metric) FILTER (variant = 'treatment') / count(*) FILTER (variant = 'treatment')) AS z FROM metrics)
      SELECT nc AS n_control, nt AS n_treatment, round(z, 6) AS z, {_decision()} AS decision FROM g""",
    "seq_guardrail_prefix": f"""WITH {METRICS}, r AS (SELECT variant, metric, row_number() OVER (PARTITION BY variant ORDER BY ts, event_id) AS i FROM metrics),
      looks AS (SELECT CAST(unnest({LOOKS}) AS BIGINT) AS look),
      g AS (SELECT look, count(*) FILTER (variant = 'control') AS nc, count(*) FILTER (variant = 'treatment') AS nt,
      (avg(metric) FILTER (variant = 'treatment') - avg(metric) FILTER (variant = 'control')) /
      sqrt(var_pop(metric) FILTER (variant = 'control') / count(*) FILTER (variant = 'control') + var_pop(metric) FILTER (variant = 'treatment') / count(*) FILTER (variant = 'treatment')) AS z
      FROM looks JOIN r ON i <= look GROUP BY look)
      SELECT look, nc AS n_control, nt AS n_treatment, round(z, 6) AS z, {_decision()} AS decision FROM g""",
    "did_dummies": f"WITH {PANEL} SELECT time, target, post, treated, post * treated AS interaction FROM panel",
    "did_ols": f"""WITH {PANEL}, cell AS (SELECT post, treated, count(*) AS n, avg(target) AS m, var_pop(target) * count(*) AS ss FROM panel GROUP BY 1, 2),
      f AS (SELECT sum(m * CASE WHEN post = treated THEN 1 ELSE -1 END) AS effect, sum(ss) AS ssr, sum(n) AS n, sum(1.0 / n) AS inv FROM cell),
      g AS (SELECT effect, effect / sqrt(ssr / (n - 4) * inv) AS t, CAST(n - 4 AS DOUBLE) AS dof, 1 - ssr / (SELECT var_pop(target) * count(*) FROM panel) AS r2 FROM f)
      SELECT round(effect, 4) AS effect, round(t, 6) AS t_statistic, dof AS df, round(r2, 6) AS r_squared, round({p_value('t', 'dof')}, 6) AS p_value,
      {p_value('t', 'dof')} < 0.05 AS significant FROM g""",
    "ols_fit": f"WITH {DAYS} SELECT round(regr_intercept(revenue, n_orders), 2) AS intercept, round(regr_slope(revenue, n_orders), 2) AS slope FROM days",
    "causal_impact": f"""WITH {IMPACT}, m AS (SELECT sum(y) AS act, sum(c) AS pred, avg(y) AS my, avg(c) AS mc, var_samp(y) / count(*) AS a, var_samp(c) / count(*) AS b, count(*) AS n FROM post),
      w AS (SELECT *, (my - mc) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n - 1) + b * b / (n - 1)) AS dof FROM m)
      SELECT round(act, 2) AS actual_cumulative, round(pred, 2) AS counterfactual_cumulative, round(act - pred, 2) AS absolute_uplift,
      round((act - pred) / pred * 100, 5) AS relative_lift_pct, round(t, 5) AS t_statistic, round(dof, 5) AS df,
      round({p_value('t', 'dof')}, 5) AS p_value, {p_value('t', 'dof')} < 0.05 AS significant FROM w""",
    "pointwise_effect": f"""WITH {IMPACT} SELECT day, round(y, 3) AS actual, round(c, 1) AS counterfactual, round(y - c, 1) AS effect,
      round(sum(y - c) OVER (ORDER BY day), 1) AS cumulative_effect FROM post""",
    "psi": f"WITH {SAMPLES} {_PSI}",
    "ks_two_sample": f"""WITH {SAMPLES}, v AS (SELECT l_extendedprice AS x, count(*) FILTER (early) AS e, count(*) FILTER (NOT early) AS a FROM samples GROUP BY 1),
      r AS (SELECT sum(e) OVER (ORDER BY x) / sum(e) OVER () - sum(a) OVER (ORDER BY x) / sum(a) OVER () AS gap FROM v)
      SELECT round(d, 9) AS ks_statistic, n AS n_expected, m AS n_actual,
        round(CASE WHEN z < 0.2 THEN 1.0 ELSE (SELECT sum((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * z * z)) FROM range(1, 51) t(k)) END, 9) AS p_value
      FROM (SELECT d, n, m, d * sqrt(CAST(n AS DOUBLE) * m / (n + m)) AS z FROM (SELECT max(abs(gap)) AS d,
        (SELECT CAST(sum(e) AS BIGINT) FROM v) AS n, (SELECT CAST(sum(a) AS BIGINT) FROM v) AS m FROM r))""",
    "forecast_error": f"""WITH {SALES}, n AS (SELECT series_id, y, lag(y) OVER (PARTITION BY series_id ORDER BY t) AS y_hat FROM sales)
      SELECT series_id, round(avg((y - y_hat) * (y - y_hat)), 4) AS mse, round(avg(abs((y - y_hat) / (y + 1e-5))) * 100, 4) AS mape
      FROM n WHERE y_hat IS NOT NULL GROUP BY 1""",
    "basis_expand": f"""WITH {SALES} SELECT series_id, t, 1.0::DOUBLE AS one, CAST(t AS DOUBLE) AS t1, CAST(t * t AS DOUBLE) AS t2,
      round(cos(2 * pi() * t / 12), 6) AS cos1, round(sin(2 * pi() * t / 12), 6) AS sin1,
      round(cos(4 * pi() * t / 12), 6) AS cos2, round(sin(4 * pi() * t / 12), 6) AS sin2 FROM sales""",
    "series_windows": f"""WITH {SALES}, w AS (SELECT series_id, t, list(y) OVER (PARTITION BY series_id ORDER BY t RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS past,
      list(y) OVER (PARTITION BY series_id ORDER BY t RANGE BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS ahead FROM sales),
      k AS (SELECT series_id, t, list_concat(past, ahead) AS v FROM w WHERE len(past) = 24 AND len(ahead) = 6)
      SELECT series_id, t, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, unnest(v) AS y FROM k""",
    "auc": """WITH v AS (SELECT value, count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type <> 'purchase') AS n FROM events GROUP BY 1),
      r AS (SELECT p, n, sum(n) OVER (ORDER BY value) - n AS below FROM v)
      SELECT round(CAST(sum(p * (below + n / 2)) AS DOUBLE) / (sum(p) * sum(n)), 9) AS auc, CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n) AS BIGINT) AS n_neg FROM r""",
}
