"""Time-series windows and per-series forecasts on a trend and Fourier basis."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.scalars import SEASON_PERIOD, basis_expand
from souk.functions.vectors import dot
from souk.operators.causal import gram_sums

# History and horizon lengths.
BACKCAST, FORECAST = 24, 6
CHUNK = 4096


def series_windows(points: DataFrame, series: str = "series_id", t: str = "t", y: str = "y",
                   backcast: int = BACKCAST, forecast: int = FORECAST, chunk: int = CHUNK) -> DataFrame:
    """``(series, t, backcast[], forecast[])`` for every anchor ``t`` with complete windows on both sides.

    ``t`` is a whole step number, unique per series. A long series is cut into chunks; points near a border
    are copied to the neighbouring chunk, so no window needs a whole series in one task.
    """
    if chunk < max(backcast, forecast):
        raise ValueError("chunk must be at least as long as the windows")
    own = F.floor(F.col(t) / chunk)
    reach = F.array_distinct(
        F.array(F.floor((F.col(t) - forecast) / chunk), own, F.floor((F.col(t) + backcast - 1) / chunk))
    )
    spread = points.select(series, t, y, own.alias("_own"), F.explode(reach).alias("_chunk"))
    inside = Window.partitionBy(series, "_chunk").orderBy(t)
    past, ahead = inside.rangeBetween(-(backcast - 1), 0), inside.rangeBetween(1, forecast)
    windows = spread.select(
        series, t, "_own", "_chunk",
        F.collect_list(y).over(past).alias("backcast"), F.collect_list(y).over(ahead).alias("forecast"),
    )
    full = (F.size("backcast") == backcast) & (F.size("forecast") == forecast)
    return windows.filter((F.col("_own") == F.col("_chunk")) & full).select(series, t, "backcast", "forecast")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve_ridge(gram: pd.Series, moment: pd.Series, ridge: pd.Series) -> pd.Series:
    """Weights of many small ridge systems at once."""
    if not len(gram):
        return pd.Series([], dtype=object)
    m = np.stack(moment.to_numpy())
    g = np.stack(gram.to_numpy()).reshape(len(m), m.shape[1], m.shape[1])
    g = g + ridge.to_numpy()[:, None, None] * np.eye(m.shape[1])
    return pd.Series(list(np.linalg.solve(g, m[..., None])[..., 0]))


def forecast_basis(points: DataFrame, series: str = "series_id", t: str = "t", y: str = "y", backcast: int = BACKCAST,
                   forecast: int = FORECAST, ridge: float = 1e-6, period: float = SEASON_PERIOD) -> DataFrame:
    """``(series, t, y_hat)`` for the ``forecast`` steps after each series' last point.

    Fits the basis to the last ``backcast`` steps. Steps are counted from the start of that history, so the
    fit is well conditioned; its Gram sums are a plain aggregation and only p x p systems are solved.
    """
    last = points.filter(F.col(y).isNotNull()).groupBy(series).agg(F.max(t).alias("_last"))
    recent = points.join(last, series).withColumn("_step", F.col(t) - F.col("_last") + (backcast - 1)).filter(
        (F.col("_step") >= 0) & F.col(y).isNotNull()
    )
    basis = basis_expand(F.col("_step"), period)
    size = 3 + 4
    rows = recent.withColumn("_x", basis)
    gram, moment = gram_sums([F.col("_x")[i] for i in range(size)], F.col(y).cast("double"))
    fits = rows.groupBy(series).agg(gram.alias("gram"), moment.alias("moment"), F.max("_last").alias("_last"))
    weights = fits.select(series, "_last", solve_ridge("gram", "moment", F.lit(float(ridge))).alias("_w"))
    steps = weights.select(series, "_last", "_w", F.explode(F.sequence(F.lit(1), F.lit(forecast))).alias("_h"))
    return steps.select(
        series, (F.col("_last") + F.col("_h")).alias(t),
        dot(basis_expand(F.col("_h") + (backcast - 1), period), F.col("_w")).alias("y_hat"),
    )
