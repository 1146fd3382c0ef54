"""Experiment, causal and drift operators against NumPy and against effects put into the data."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.functions.student_t import p_two_sided
from souk.operators import causal, drift, evaluation, experiments, series, sketches


def frame(spark, columns):
    names = list(columns)
    rows = [tuple(v.item() if hasattr(v, "item") else v for v in row) for row in zip(*columns.values())]
    return spark.createDataFrame(rows, names).repartition(5)


def arms(spark, control, treatment):
    return frame(spark, {"variant": ["control"] * len(control) + ["treatment"] * len(treatment),
                         "y": np.concatenate([control, treatment])})


@pytest.mark.parametrize("t,df,p", [(2.228139, 10, 0.05), (12.7062047, 1, 0.05), (0.0, 5, 1.0), (2.5758293, 1e9, 0.01)])
def test_p_value_of_known_quantiles(t, df, p):
    assert p_two_sided(t, df) == pytest.approx(p, abs=1e-6)
    assert p_two_sided(-t, df) == pytest.approx(p, abs=1e-6)


def test_p_value_without_degrees_of_freedom():
    assert math.isnan(p_two_sided(1.0, 0.0))


def test_welch_matches_closed_form(spark):
    rng = np.random.default_rng(1)
    c, t = rng.normal(50, 10, 300), rng.normal(53, 20, 200)
    row = experiments.ab_welch(arms(spark, c, t)).first()
    a, b = c.var(ddof=1) / len(c), t.var(ddof=1) / len(t)
    assert row.t_statistic == pytest.approx((c.mean() - t.mean()) / math.sqrt(a + b))
    assert row.df == pytest.approx((a + b) ** 2 / (a**2 / (len(c) - 1) + b**2 / (len(t) - 1)))
    assert row.relative_lift_pct == pytest.approx((t.mean() - c.mean()) / c.mean() * 100)


def test_welch_without_spread_or_with_negative_control(spark):
    same = experiments.ab_welch(arms(spark, np.full(5, 2.0), np.full(5, 2.0))).first()
    assert same.t_statistic is None and same.p_value is None and same.significant is False
    assert experiments.ab_welch(arms(spark, np.array([-1.0, -2.0]), np.array([1.0, 2.0]))).first().relative_lift_pct == 0.0


def test_cupac_matches_adjusted_arrays(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(50, 10, 2000)
    y = 1.05 * x + rng.normal(0, 5, 2000) + np.repeat([0.0, 1.0], 1000)
    df = frame(spark, {"variant": ["control"] * 1000 + ["treatment"] * 1000, "y": y, "x_pre": x})
    plain, got = experiments.ab_welch(df).first(), experiments.ab_cupac(df).first()
    theta = np.cov(y, x)[0, 1] / np.var(x)
    z = y - theta * (x - x.mean())
    c, t = z[:1000], z[1000:]
    assert got.theta == pytest.approx(theta)
    assert got.t_statistic == pytest.approx((c.mean() - t.mean()) / math.sqrt(c.var(ddof=1) / 1000 + t.var(ddof=1) / 1000))
    assert got.variance_reduction_pct == pytest.approx((y.var() - z.var()) / y.var() * 100)
    assert got.variance_reduction_pct > 70 and got.p_value < plain.p_value


def test_cupac_with_constant_covariate_is_welch(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(5, 1, 40)
    df = frame(spark, {"variant": ["control"] * 20 + ["treatment"] * 20, "y": y, "x_pre": np.ones(40)})
    assert experiments.ab_cupac(df).first().t_statistic == pytest.approx(experiments.ab_welch(df).first().t_statistic)


def test_guardrail_stops_a_bad_treatment_at_every_look(spark):
    rng = np.random.default_rng(42)
    c, t = rng.normal(5.0, 1.0, 200), rng.normal(4.2, 1.0, 200)
    df = frame(spark, {"variant": ["control"] * 200 + ["treatment"] * 200, "seq": list(range(200)) * 2, "metric": np.concatenate([c, t])})
    looks = {r.look: r for r in experiments.seq_guardrail_prefix(df, ["seq"], [49, 50, 100, 150, 200]).collect()}
    assert looks[49].decision == "GATHERING_DATA" and looks[49].z is None
    for size in (50, 100, 150, 200):
        z = (t[:size].mean() - c[:size].mean()) / math.sqrt(c[:size].var() / size + t[:size].var() / size)
        assert looks[size].z == pytest.approx(z) and looks[size].decision == "STOP_DEGRADATION"


@pytest.mark.parametrize("kind", ["even", "ties", "text", "nulls"])
def test_guardrail_prefixes_sort_only_where_a_look_falls(spark, kind):
    rng = np.random.default_rng(8)
    n = 4000
    at = {"even": rng.permutation(n).astype(float), "ties": np.floor(rng.exponential(2, n)), "text": rng.permutation(n), "nulls": rng.permutation(n).astype(float)}[kind]
    arm, metric = np.where(rng.random(n) < 0.5, "control", "treatment"), rng.normal(3, 2, n)
    rows = [(str(a), f"{int(x):05d}" if kind == "text" else None if kind == "nulls" and x < 30 else float(x), i, float(m)) for i, (a, x, m) in enumerate(zip(arm, at, metric))]
    df = spark.createDataFrame(rows, f"variant string, at {'string' if kind == 'text' else 'double'}, id long, metric double").repartition(5)
    looks = [60, 500, 501, 1200, 5000]
    got = {r.look: r for r in experiments.seq_guardrail_prefix(df, ["at", "id"], looks).collect()}
    arms = {a: [r[3] for r in sorted((r for r in rows if r[0] == a), key=lambda r: (r[1] is not None, r[1] or (r[1] if r[1] is not None else 0), r[2]))] for a in ("control", "treatment")}
    for look in looks:
        c, t = (np.array(arms[a][:look]) for a in ("control", "treatment"))
        assert (got[look].n_control, got[look].n_treatment) == (len(c), len(t))
        assert got[look].z == pytest.approx((t.mean() - c.mean()) / math.sqrt(c.var() / len(c) + t.var() / len(t)))
    if kind == "even":
        buckets, _ = experiments.look_buckets(df, ["at", "id"], looks)
        assert buckets.filter("split").agg(F.sum("n")).first()[0] < 0.1 * n


def test_guardrail_with_zero_spread_continues(spark):
    df = frame(spark, {"variant": ["control"] * 60 + ["treatment"] * 60, "metric": np.ones(120)})
    assert experiments.seq_guardrail(df).first().decision == "CONTINUE"


def test_merged_moments_do_not_cancel(spark):
    x = np.random.default_rng(4).normal(1e9, 1.0, 900)
    df = frame(spark, {"part": np.arange(900) % 7, "x": x})
    parts = df.groupBy("part").agg(experiments.moments_of(F.col("x")).alias("m"))
    m = parts.agg(experiments.merged_moments(F.collect_list("m")).alias("m")).first().m
    assert m.n == 900 and m.m2 / 900 == pytest.approx(x.var(), rel=1e-6)


def test_did_is_the_regression(spark):
    rng = np.random.default_rng(42)
    day, group = np.tile(np.arange(30), 2), np.repeat([0, 1], 30)
    y = 100 + group * 10 + rng.normal(0, 2, 60) + 15 * ((day >= 14) & (group == 1))
    row = causal.did_ols(frame(spark, {"time": day, "treated": group, "target": y}), F.lit(14)).first()
    post = (day >= 14).astype(int)
    X = np.column_stack([np.ones(60), group, post, group * post])
    beta, ssr = np.linalg.lstsq(X, y, rcond=None)[0], None
    ssr = ((y - X @ beta) ** 2).sum()
    se = math.sqrt(ssr / 56 * np.linalg.inv(X.T @ X)[3, 3])
    assert row.effect == pytest.approx(beta[3]) and abs(row.effect - 15) < 2
    assert row.t_statistic == pytest.approx(beta[3] / se) and row.significant
    assert row.r_squared == pytest.approx(1 - ssr / ((y - y.mean()) ** 2).sum())


def test_impact_recovers_the_lift_and_matches_pinv(spark):
    rng = np.random.default_rng(42)
    pre, post = rng.normal(50, 5, (100, 2)), rng.normal(50, 5, (30, 2))
    y0 = pre @ [1.5, 0.5] + rng.normal(0, 2, 100)
    y1 = (post @ [1.5, 0.5]) * 1.15 + rng.normal(0, 2, 30)
    a = frame(spark, {"a": pre[:, 0], "b": pre[:, 1], "y": y0})
    b = frame(spark, {"t": range(30), "a": post[:, 0], "b": post[:, 1], "y": y1})
    X = np.column_stack([np.ones(100), pre])
    beta = np.linalg.pinv(X.T @ X) @ X.T @ y0
    fit = causal.ols_fit(a, "y", ["a", "b"]).first().beta
    assert fit == pytest.approx(list(beta), rel=1e-6)
    row = causal.causal_impact(a, b, "y", ["a", "b"]).first()
    predicted = np.column_stack([np.ones(30), post]) @ beta
    assert row.relative_lift_pct == pytest.approx((y1.sum() - predicted.sum()) / predicted.sum() * 100)
    assert abs(row.relative_lift_pct - 15) < 2 and row.significant
    path = causal.pointwise_effect(a, b, "y", ["a", "b"], "t").orderBy("t").collect()
    assert [r.cumulative_effect for r in path] == pytest.approx(list(np.cumsum(y1 - predicted)))


def test_collinear_covariates_have_a_solution(spark):
    x = np.arange(20.0)
    df = frame(spark, {"a": x, "b": 2 * x, "y": 3 * x + 1})
    beta = causal.ols_fit(df, "y", ["a", "b"]).first().beta
    assert beta[1] + 2 * beta[2] == pytest.approx(3, abs=1e-6)


def numpy_psi(expected, actual, bins=10):
    edges = np.percentile(expected, np.linspace(0, 100, bins + 1))
    edges[0], edges[-1] = edges[0] - 1e-4, edges[-1] + 1e-4
    e = np.clip(np.histogram(expected, edges)[0] / len(expected), 1e-4, 1)
    a = np.clip(np.histogram(actual, edges)[0] / len(actual), 1e-4, 1)
    return ((a - e) * np.log(a / e)).sum()


@pytest.mark.parametrize("kind", ["stable", "shifted", "same", "ties"])
def test_psi_matches_numpy(spark, kind):
    rng = np.random.default_rng(42)
    e = rng.normal(100, 15, 5000)
    a = {"stable": rng.normal(101, 15.5, 2000), "shifted": rng.normal(115, 20, 2000), "same": e.copy(), "ties": None}[kind]
    if kind == "ties":
        e, a = np.repeat([1.0, 2.0, 3.0], [4000, 10, 5]), np.repeat([1.0, 3.0, 9.0], [50, 30, 20])
    df = frame(spark, {"early": [True] * len(e) + [False] * len(a), "x": np.concatenate([e, a])})
    row = drift.psi(df, "early", ["x"]).first()
    assert row.psi == pytest.approx(numpy_psi(e, a), abs=1e-9)
    assert row.retrain == (numpy_psi(e, a) >= 0.2)
    if kind == "same":
        assert row.psi == 0


def test_psi_ignores_nan_and_null(spark):
    df = spark.createDataFrame([(True, float("nan")), (True, None), (False, 1.0)] + [(i % 2 == 0, float(i)) for i in range(40)], "early boolean, x double")
    assert math.isfinite(drift.psi(df, "early", ["x"]).first().psi)


def test_ks_matches_numpy(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 50, 700).astype(float), rng.integers(5, 60, 300).astype(float)
    df = frame(spark, {"early": [True] * 700 + [False] * 300, "x": np.concatenate([a, b])})
    grid = np.arange(61)
    gap = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert drift.ks_two_sample(df, "early", "x").first().ks_statistic == pytest.approx(gap)


def test_ks_p_value_at_known_points(spark):
    # 5 % and 1 % points of Kolmogorov's distribution, equal samples, and hardly any distance
    points = [(1.3580986, 0.05), (1.6276236, 0.01), (0.0, 1.0), (0.25, 1.0), (None, None)]
    df = spark.createDataFrame([(d and d / 50**0.5, 100, 100, p) for d, p in points], "d double, n bigint, m bigint, p double")
    for row in df.select("p", drift.ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("got")).collect():
        assert row.got is None if row.p is None else row.got == pytest.approx(row.p, abs=1e-6)


def test_auc_counts_pairs(spark):
    rng = np.random.default_rng(6)
    score, label = rng.integers(0, 20, 300).astype(float), rng.integers(0, 2, 300)
    pos, neg = score[label == 1], score[label == 0]
    exact = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert evaluation.auc(frame(spark, {"score": score, "label": label})).first().auc == pytest.approx(exact)


def test_auc_of_one_class_is_null(spark):
    assert evaluation.auc(frame(spark, {"score": [0.1, 0.2], "label": [1, 1]})).first().auc is None


def test_challenger_must_be_strictly_better(spark):
    df = frame(spark, {"model": ["a"] * 4 + ["b"] * 4, "score": [0.1, 0.2, 0.3, 0.4] * 2, "label": [0, 1, 0, 1] * 2})
    assert evaluation.champion_challenger(df, "a", "b").first().promote is False


def test_info_nce_in_blocks_matches_numpy(spark):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(90, 8)), rng.normal(size=(90, 8))
    rows = [(0 if i < 70 else 1, i, u[i].tolist(), v[i].tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "batch_id int, pair_id int, user_vec array<double>, item_vec array<double>")
    got = {r.batch_id: r.info_nce for r in evaluation.info_nce(df, left_rows=16, right_rows=10).collect()}
    for batch, part in ((0, slice(0, 70)), (1, slice(70, 90))):
        s = u[part] @ v[part].T / 0.07
        top = s.max(axis=1, keepdims=True)
        loss = np.mean(top[:, 0] + np.log(np.exp(s - top).sum(axis=1)) - np.diag(s))
        assert got[batch] == pytest.approx(loss)


def test_bce_is_finite_for_certain_predictions(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0, 1.0)], "ctr_label double, ctr_pred double, cvr_label double, cvr_pred double")
    row = evaluation.bce_joint_loss(df).first()
    assert (row.ctr_loss, row.cvr_loss, row.joint_loss) == (100.0, 100.0, 150.0)


def test_ranking_metrics_of_a_perfect_and_a_reversed_list(spark):
    truth = spark.createDataFrame([("q", f"i{g}", g) for g in (3, 2, 1)], "query_id string, item_id string, relevance int")
    perfect = spark.createDataFrame([("q", "i3", 1), ("q", "i2", 2), ("q", "i1", 3)], "query_id string, item_id string, rank int")
    assert evaluation.ranking_metrics(perfect, truth, 3).first().ndcg == pytest.approx(1.0)
    assert evaluation.ranking_metrics(perfect.filter("rank = 3"), truth, 3).first().recall == pytest.approx(1 / 3)


def test_series_windows_across_chunk_borders(spark):
    n = 100
    df = frame(spark, {"series_id": ["a"] * n + ["b"] * 29, "t": list(range(-10, n - 10)) + list(range(29)), "y": np.arange(n + 29.0)})
    small = {(r.series_id, r.t): (r.backcast, r.forecast) for r in series.series_windows(df, chunk=24).collect()}
    whole = {(r.series_id, r.t): (r.backcast, r.forecast) for r in series.series_windows(df, chunk=4096).collect()}
    assert small == whole and len(small) == n - 29
    assert small[("a", 20)] == (list(np.arange(7.0, 31.0)), list(np.arange(31.0, 37.0)))


def test_forecast_recovers_trend_and_season(spark):
    t = np.arange(30)
    y = 5 + 0.3 * t + 0.01 * t**2 + 2 * np.cos(2 * np.pi * t / 12) - np.sin(4 * np.pi * t / 12)
    df = frame(spark, {"series_id": ["s"] * 24, "t": t[:24], "y": y[:24]})
    got = {r.t: r.y_hat for r in series.forecast_basis(df).collect()}
    assert sorted(got) == list(range(24, 30))
    assert [got[i] for i in range(24, 30)] == pytest.approx(list(y[24:]), abs=1e-2)


def test_forecast_error_formula(spark):
    row = evaluation.forecast_error(frame(spark, {"y": [2.0, 4.0], "y_hat": [1.0, 5.0]})).first()
    assert row.mse == 1.0 and row.mape == pytest.approx((1 / 2.00001 + 1 / 4.00001) / 2 * 100)


def test_p_values_with_very_many_degrees_of_freedom():
    import math

    from souk.functions.student_t import p_two_sided

    for t in (0.1, 0.5, 1.96, 4.0):
        normal = math.erfc(t / math.sqrt(2))
        assert all(abs(p_two_sided(t, df) - normal) < 1e-9 for df in (1e10, 1e12))
        assert abs(p_two_sided(t, 0.999e6) - p_two_sided(t, 1.001e6)) < 1e-9


def test_day_sketches_merge_and_replace_their_day(spark, tmp_path):
    rng, path = np.random.default_rng(6), str(tmp_path / "q")
    x, day = rng.gamma(2, 10, 30_000), rng.integers(1, 6, 30_000)
    df = spark.createDataFrame([(f"2024-01-0{d}", "abc"[i % 3], float(v), i % 5000) for i, (d, v) in enumerate(zip(day, x))], "d string, k string, x double, id long")
    sketches.write_quantile_days(df, path, F.to_date("d"), ["k"], "x")
    whole = sketches.merged_quantile(sketches.read_days(spark, path), ["k"], 0.99).collect()
    for r in whole:
        own = x[np.arange(30_000) % 3 == "abc".index(r.k)]
        assert r.n == len(own) and abs((own <= r.quantile).mean() - 0.99) <= sketches.RANK_ERROR
    sketches.write_quantile_days(df.filter("d = '2024-01-03' and x < 5"), path, F.to_date("d"), ["k"], "x")  # a day is counted anew
    part = sketches.merged_quantile(sketches.read_days(spark, path, date(2024, 1, 3), date(2024, 1, 3)), [], 0.5).first()
    assert part.n == ((day == 3) & (x < 5)).sum() and part.quantile < 5
    counts = str(tmp_path / "c")
    sketches.write_count_days(df, counts, F.to_date("d"), ["id", "k"])
    got = {r.entity: r.distinct for r in sketches.merged_counts(sketches.read_days(spark, counts, date(2024, 1, 2), date(2024, 1, 4))).collect()}
    exact = len({i % 5000 for i in range(30_000) if 2 <= day[i] <= 4})
    assert abs(got["id"] - exact) <= sketches.COUNT_ERROR * exact and got["k"] == 3
