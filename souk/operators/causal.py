"""Quasi-experiments: difference-in-differences, least squares by Gram sums, counterfactual impact."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.scalars import did_dummies
from souk.functions.vectors import dot
from souk.operators.experiments import welch_columns, with_p_value
from souk.operators.ordered import running_totals


def did_ols(panel: DataFrame, start: Column, time: str = "time", group: str = "treated", target: str = "target",
            keys: Sequence[str] = ()) -> DataFrame:
    """Effect of the interaction term, with its test and R².

    The regression has one parameter per cell, so its fit is the four cell means: the effect is their
    double difference and the residual is the spread within cells. One aggregation over the panel.
    """
    flags = did_dummies(F.col(time), F.col(group), start)
    y = F.col(target)
    cells = {}
    for post in (0, 1):
        for treated in (0, 1):
            cells[f"{post}{treated}"] = F.when((flags["post"] == post) & (flags["treated"] == treated), y)
    sums = panel.groupBy(*keys).agg(
        *[F.count(x).alias(f"n{c}") for c, x in cells.items()],
        *[F.avg(x).alias(f"m{c}") for c, x in cells.items()],
        *[F.var_pop(x).alias(f"v{c}") for c, x in cells.items()],
        F.count(y).alias("n"), F.var_pop(y).alias("v"),
    )
    residual = sum((F.col(f"n{c}") * F.col(f"v{c}") for c in cells), F.lit(0.0))
    inverse = sum((F.lit(1.0) / F.nullif(F.col(f"n{c}"), F.lit(0)) for c in cells), F.lit(0.0))
    df = (F.col("n") - 4).cast("double")
    effect = (F.col("m11") - F.col("m01")) - (F.col("m10") - F.col("m00"))
    se = F.sqrt(residual / F.when(df > 0, df) * inverse)
    fitted = sums.select(
        *keys, effect.alias("effect"), F.when(se > 0, effect / se).alias("t_statistic"), df.alias("df"),
        F.when(F.col("v") > 0, F.lit(1.0) - residual / (F.col("v") * F.col("n"))).alias("r_squared"),
    )
    return with_p_value(fitted)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve_normal(gram: pd.Series, moment: pd.Series) -> pd.Series:
    """Minimum-norm least-squares weights from X'X (row-major) and X'y, one small system per row."""
    out = []
    for g, m in zip(gram, moment):
        m = np.asarray(m, float)
        out.append(None if not len(m) else np.linalg.pinv(np.asarray(g, float).reshape(len(m), len(m))) @ m)
    return pd.Series(out, dtype=object)


def gram_sums(features: Sequence[Column], y: Column) -> tuple[Column, Column]:
    """X'X (row-major) and X'y as aggregates; symmetric entries are summed once."""
    p = len(features)
    upper = {(i, j): F.sum(features[i] * features[j]) for i in range(p) for j in range(i, p)}
    gram = F.array(*[upper[min(i, j), max(i, j)] for i in range(p) for j in range(p)])
    return gram, F.array(*[F.sum(f * y) for f in features])


def ols_fit(df: DataFrame, target: str, covariates: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares weights with intercept per key: ``(keys, beta array)``; only (p+1)² sums leave the tasks."""
    rows = df.dropna(subset=[target, *covariates])
    features = [F.lit(1.0), *[F.col(c).cast("double") for c in covariates]]
    gram, moment = gram_sums(features, F.col(target).cast("double"))
    sums = rows.groupBy(*keys).agg(gram.alias("gram"), moment.alias("moment"))
    return sums.select(*keys, solve_normal("gram", "moment").alias("beta"))


def counterfactual(pre: DataFrame, post: DataFrame, target: str, covariates: Sequence[str]) -> DataFrame:
    """``post`` with the value predicted from the fit on ``pre``, and the difference to the actual one."""
    beta = ols_fit(pre, target, covariates).select("beta")
    x = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in covariates])
    predicted = post.withColumn("_beta", beta.scalar()).withColumn("counterfactual", dot(x, F.col("_beta")))
    return predicted.withColumn("effect", F.col(target) - F.col("counterfactual")).drop("_beta")


def causal_impact(pre: DataFrame, post: DataFrame, target: str, covariates: Sequence[str]) -> DataFrame:
    """Cumulative and relative effect after an intervention, with Welch's t of actual against predicted."""
    rows = counterfactual(pre, post, target, covariates)
    y, c = F.col(target), F.col("counterfactual")
    sums = rows.agg(
        F.sum(y).alias("actual"), F.sum(c).alias("predicted"), F.sum("effect").alias("uplift"),
        F.avg(y).alias("my"), F.var_samp(y).alias("vy"), F.avg(c).alias("mc"), F.var_samp(c).alias("vc"),
        F.count(y).alias("n"),
    )
    test = welch_columns(F.col("my"), F.col("vy"), F.col("n"), F.col("mc"), F.col("vc"), F.col("n"))
    actual, predicted = F.col("actual"), F.col("predicted")
    relative = F.when(predicted != 0, (actual - predicted) / predicted * 100).otherwise(F.lit(0.0))
    return with_p_value(
        sums.select(
            actual.alias("actual_cumulative"), predicted.alias("counterfactual_cumulative"),
            F.col("uplift").alias("absolute_uplift"), relative.alias("relative_lift_pct"),
            test["t_statistic"].alias("t_statistic"), test["df"].alias("df"),
        )
    )


def pointwise_effect(pre: DataFrame, post: DataFrame, target: str, covariates: Sequence[str], time: str) -> DataFrame:
    """Actual, predicted, difference and running difference per time step."""
    rows = counterfactual(pre, post, target, covariates).select(
        time, F.col(target).alias("actual"), "counterfactual", "effect"
    )
    summed = running_totals(rows, [], [time], ["effect"])
    return summed.select(time, "actual", "counterfactual", "effect", F.col("effect_run").alias("cumulative_effect"))
