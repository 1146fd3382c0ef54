"""Experiment read-outs from sufficient statistics: raw rows are only ever aggregated."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.student_t import t_p_value
from souk.operators.ordered import running_totals
from souk.session import cut_lineage

# Significance level, guardrail bound and smallest arm.
ALPHA = 0.05
GUARDRAIL_Z = 2.58
GUARDRAIL_MIN_ROWS = 50
GATHERING, CONTINUE = "GATHERING_DATA", "CONTINUE"
STOP_DEGRADATION, STOP_SUCCESS = "STOP_DEGRADATION", "STOP_SUCCESS"


def pool_arms(control: DataFrame, treatment: DataFrame) -> DataFrame:
    """Both arms as one long table with a ``variant`` label."""
    return control.withColumn("variant", F.lit("control")).unionByName(
        treatment.withColumn("variant", F.lit("treatment"))
    )


def _of_arm(variant: Column, arm: str, value: Column) -> Column:
    return F.when(variant == arm, value)


def welch_columns(mean_c: Column, var_c: Column, n_c: Column, mean_t: Column, var_t: Column, n_t: Column) -> dict[str, Column]:
    """t (first arm minus second) and Welch-Satterthwaite degrees of freedom; null where undefined."""
    a, b = var_c / F.nullif(n_c, F.lit(0)), var_t / F.nullif(n_t, F.lit(0))
    se2 = a + b
    usable = (n_c > 1) & (n_t > 1) & (se2 > 0)
    return {
        "t_statistic": F.when(usable, (mean_c - mean_t) / F.sqrt(se2)),
        "df": F.when(usable, se2 * se2 / (a * a / (n_c - 1) + b * b / (n_t - 1))),
    }


def with_p_value(df: DataFrame) -> DataFrame:
    """Adds ``p_value`` and ``significant`` next to ``t_statistic`` and ``df``."""
    tested = df.withColumn("p_value", t_p_value("t_statistic", "df"))
    return tested.withColumn("significant", F.coalesce(F.col("p_value") < ALPHA, F.lit(False)))


def _arm_moments(df: DataFrame, value: Column, keys: Sequence[str]) -> DataFrame:
    v = F.col("variant")
    measures = []
    for arm, tag in (("control", "c"), ("treatment", "t")):
        x = _of_arm(v, arm, value)
        measures += [F.avg(x).alias(f"mean_{tag}"), F.var_samp(x).alias(f"var_{tag}"), F.count(x).alias(f"n_{tag}")]
    return df.groupBy(*keys).agg(*measures)


def _welch_result(moments: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    mean_c, mean_t = F.col("mean_c"), F.col("mean_t")
    welch = welch_columns(mean_c, F.col("var_c"), F.col("n_c"), mean_t, F.col("var_t"), F.col("n_t"))
    lift = F.when(mean_c > 0, (mean_t - mean_c) / mean_c * 100).otherwise(F.lit(0.0))
    return with_p_value(
        moments.select(
            *keys, mean_c.alias("control_mean"), mean_t.alias("treatment_mean"), lift.alias("relative_lift_pct"),
            welch["t_statistic"].alias("t_statistic"), welch["df"].alias("df"), *extra,
        )
    )


def ab_welch(df: DataFrame, y: str = "y", keys: Sequence[str] = ()) -> DataFrame:
    """Welch's t-test of control against treatment per key, in one aggregation."""
    return _welch_result(_arm_moments(df, F.col(y), keys), keys)


def ab_cupac(df: DataFrame, y: str = "y", x: str = "x_pre", keys: Sequence[str] = ()) -> DataFrame:
    """Welch's t-test after removing what a pre-period covariate predicts.

    The adjusted outcome is ``y - theta (x - mean x)`` with ``theta = cov_samp(y, x) / var_pop(x)`` over
    both arms. Its moments follow from the joint moments of y and x, so one aggregation is enough:
    var(y') = var(y) - 2 theta cov(y, x) + theta² var(x).
    """
    pairs = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
    measures = [
        F.covar_samp(y, x).alias("cov_s"), F.covar_pop(y, x).alias("cov_p"), F.var_pop(x).alias("vx"),
        F.var_pop(y).alias("vy"), F.avg(x).alias("mx"),
    ]
    for arm, tag in (("control", "c"), ("treatment", "t")):
        ya, xa = _of_arm(F.col("variant"), arm, F.col(y)), _of_arm(F.col("variant"), arm, F.col(x))
        measures += [
            F.count(ya).alias(f"n_{tag}"), F.avg(ya).alias(f"my_{tag}"), F.avg(xa).alias(f"mx_{tag}"),
            F.var_samp(ya).alias(f"vy_{tag}"), F.var_samp(xa).alias(f"vx_{tag}"), F.covar_samp(ya, xa).alias(f"cov_{tag}"),
        ]
    sums = pairs.groupBy(*keys).agg(*measures)
    theta = F.col("theta")
    sums = sums.withColumn("theta", F.when(F.col("vx") > 0, F.col("cov_s") / F.col("vx")).otherwise(F.lit(0.0)))

    def adjusted_variance(vy: str, vx: str, cov: str) -> Column:
        return F.greatest(F.col(vy) - theta * F.col(cov) * 2 + theta * theta * F.col(vx), F.lit(0.0))

    moments = sums.select(
        *keys, "theta", "n_c", "n_t",
        *[(F.col(f"my_{a}") - theta * (F.col(f"mx_{a}") - F.col("mx"))).alias(f"mean_{a}") for a in "ct"],
        *[adjusted_variance(f"vy_{a}", f"vx_{a}", f"cov_{a}").alias(f"var_{a}") for a in "ct"],
        F.when(F.col("vy") > 0, (F.col("vy") - adjusted_variance("vy", "vx", "cov_p")) / F.col("vy") * 100)
        .otherwise(F.lit(0.0)).alias("variance_reduction_pct"),
    )
    return _welch_result(moments, keys, ["theta", "variance_reduction_pct"])


def guardrail_columns(
    n_c: Column, mean_c: Column, varp_c: Column, n_t: Column, mean_t: Column, varp_t: Column, z_bound: float = GUARDRAIL_Z
) -> dict[str, Column]:
    """z score on population variances, and the decision; z is null until both arms are large enough."""
    enough = (n_c >= GUARDRAIL_MIN_ROWS) & (n_t >= GUARDRAIL_MIN_ROWS)
    se = F.sqrt(varp_c / F.nullif(n_c, F.lit(0)) + varp_t / F.nullif(n_t, F.lit(0)))
    z = F.when(enough & (se > 0), (mean_t - mean_c) / se)
    decision = (
        F.when(~enough, F.lit(GATHERING)).when(z <= -z_bound, F.lit(STOP_DEGRADATION))
        .when(z >= z_bound, F.lit(STOP_SUCCESS)).otherwise(F.lit(CONTINUE))
    )
    return {"z": z, "decision": decision}


def seq_guardrail(df: DataFrame, metric: str = "metric", keys: Sequence[str] = (), z_bound: float = GUARDRAIL_Z) -> DataFrame:
    """Early-stopping decision over everything seen so far, per key."""
    measures = []
    for arm, tag in (("control", "c"), ("treatment", "t")):
        x = _of_arm(F.col("variant"), arm, F.col(metric))
        measures += [F.count(x).alias(f"n_{tag}"), F.avg(x).alias(f"m_{tag}"), F.var_pop(x).alias(f"v_{tag}")]
    sums = df.groupBy(*keys).agg(*measures)
    rule = guardrail_columns(*[F.col(f"{s}_{a}") for a in "ct" for s in ("n", "m", "v")], z_bound)
    return sums.select(*keys, F.col("n_c").alias("n_control"), F.col("n_t").alias("n_treatment"),
                       rule["z"].alias("z"), rule["decision"].alias("decision"))


def merged_moments(parts: Column) -> Column:
    """(n, mean, m2) of the union of samples given as an array of (n, mean, m2); m2 is the sum of squared deviations.

    Deviations are taken from the merged mean, so large means do not cancel.
    """
    n = F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, p: s + p["n"])
    total = F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["n"] * p["mean"])
    mean = total / F.nullif(n, F.lit(0))
    m2 = F.aggregate(
        parts, F.lit(0.0), lambda s, p: s + p["m2"] + p["n"] * (p["mean"] - mean) * (p["mean"] - mean)
    )
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def moments_of(value: Column) -> Column:
    """(n, mean, m2) of a column, ready for ``merged_moments``."""
    n = F.count(value)
    return F.struct(n.alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
                    F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"))


#: Buckets of the order's range in which moments are kept, and rows are sorted only where a look falls inside.
LOOK_BUCKETS = 1000


def _bucket(df: DataFrame, column: str) -> Column:
    """A whole number that never falls as the column rises: its place between the smallest and largest value."""
    kind = dict(df.dtypes)[column]
    if kind in ("timestamp", "timestamp_ntz", "date"):
        value = F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        value = F.col(column).cast("double")
    else:
        return F.lit(0).cast("bigint")  # all in one: the order of text and others is left to the sort
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    if ends.low is None:
        return F.lit(0).cast("bigint")
    place = F.width_bucket(value, F.lit(ends.low), F.lit(ends.high), F.lit(LOOK_BUCKETS))
    return F.when(F.isnan(value), LOOK_BUCKETS + 2).otherwise(F.coalesce(place, F.lit(-1))).cast("bigint")


def look_buckets(df: DataFrame, order: Sequence[str], looks: Sequence[int], metric: str = "metric") -> tuple[DataFrame, DataFrame]:
    """Per arm and bucket the number of rows, their moments and the rows before them, ``split`` where a look falls inside; and the
    rows with their ``bucket``. An arm has at most about ``LOOK_BUCKETS`` rows in the first table."""
    rows = df.select("variant", *order, F.col(metric).alias("metric"), _bucket(df, order[0]).alias("bucket"))
    sums = rows.groupBy("variant", "bucket").agg(F.count(F.lit(1)).alias("n"), moments_of(F.col("metric")).alias("part"))
    before = F.sum("n").over(Window.partitionBy("variant").orderBy("bucket")) - F.col("n")
    placed = sums.withColumn("before", before)
    inside = [(F.col("before") < size) & (F.col("before") + F.col("n") > size) for size in looks]
    return placed.withColumn("split", reduce(operator.or_, inside, F.lit(False))), rows


def seq_guardrail_prefix(
    df: DataFrame, order: Sequence[str], looks: Sequence[int], metric: str = "metric", z_bound: float = GUARDRAIL_Z
) -> DataFrame:
    """The guardrail at each cumulative sample size per arm: ``(look, z, decision)``.

    ``order`` must identify a row within its arm. Buckets of its first column that lie between two looks give their moments
    as a whole; only the rows of buckets with a look inside are put in order, by a range-partitioned running count.
    """
    looks = sorted(looks)
    buckets, rows = look_buckets(df, order, looks, metric)
    buckets = cut_lineage(buckets)

    def first_look(position: Column) -> Column:
        found = F.lit(None).cast("bigint")
        for size in reversed(looks):
            found = F.when(position <= size, F.lit(size).cast("bigint")).otherwise(found)
        return found

    whole = buckets.filter(~F.col("split")).select("variant", first_look(F.col("before") + F.col("n")).alias("look"), "part")
    opened = rows.join(buckets.filter("split").select("variant", "bucket", "before"), ["variant", "bucket"])
    placed = running_totals(opened.withColumn("one", F.lit(1)), ["variant", "bucket"], order, ["one"])
    single = placed.withColumn("look", first_look(F.col("before") + F.col("one_run"))).filter("look is not null")
    per_look = whole.filter("look is not null").union(
        single.groupBy("variant", "look").agg(moments_of(F.col("metric")).alias("part")).select("variant", "look", "part")
    )
    # one row per arm from here on, holding at most one entry per look and bucket
    per_arm = per_look.groupBy("variant").agg(F.collect_list(F.struct("look", "part")).alias("parts"))
    at_look = per_arm.withColumn("look", F.explode(F.array(*[F.lit(size).cast("bigint") for size in looks])))
    seen = F.filter("parts", lambda p: p["look"] <= F.col("look"))
    merged = at_look.select("variant", "look", merged_moments(F.transform(seen, lambda p: p["part"])).alias("m"))
    arms = merged.groupBy("look").agg(
        *[F.max(F.when(F.col("variant") == arm, F.col("m"))).alias(tag) for arm, tag in (("control", "c"), ("treatment", "t"))]
    )
    n = {a: F.coalesce(F.col(f"{a}.n"), F.lit(0)) for a in "ct"}
    parts = [c for a in "ct" for c in (n[a], F.col(f"{a}.mean"), F.col(f"{a}.m2") / F.nullif(n[a], F.lit(0)))]
    rule = guardrail_columns(*parts, z_bound)
    return arms.select("look", n["c"].alias("n_control"), n["t"].alias("n_treatment"),
                       rule["z"].alias("z"), rule["decision"].alias("decision"))
