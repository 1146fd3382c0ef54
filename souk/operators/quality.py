"""Data-contract checks: all rules of a contract are evaluated in one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_SHARE = 0.01  # fixed value: default largest share of nulls


@dataclass(frozen=True)
class Exists:
    column: str


@dataclass(frozen=True)
class NotNull:
    column: str
    max_share: float = NULL_SHARE


@dataclass(frozen=True)
class Between:
    column: str
    low: float
    high: float


def _missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a fractional column."""
    is_float = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return F.col(column).isNull() | F.isnan(column) if is_float else F.col(column).isNull()


def _breaches(df: DataFrame, rule: NotNull | Between) -> Column:
    if isinstance(rule, NotNull):
        return F.count_if(_missing(df, rule.column))
    value = F.col(rule.column)
    return F.count_if(~_missing(df, rule.column) & ((value < rule.low) | (value > rule.high)))


def _verdict(rule: NotNull | Between, breaches: Column, rows: Column) -> tuple[Column, Column]:
    if isinstance(rule, NotNull):
        share = F.when(rows > 0, breaches / rows).otherwise(F.lit(0.0))
        return share, share <= rule.max_share
    return breaches.cast("double"), breaches == 0


def dq_report(df: DataFrame, rules: Sequence[Exists | NotNull | Between]) -> DataFrame:
    """One row per applicable rule: ``(rule_no, rule, column_name, observed, passed)``.

    ``observed`` is the share of nulls, the number of values out of bounds, or 1/0 for presence. Value
    rules on a column that is missing are skipped; the presence rule reports it.
    """
    checks = [(i, r) for i, r in enumerate(rules) if isinstance(r, Exists) or r.column in df.columns]
    values = [(i, r) for i, r in checks if not isinstance(r, Exists)]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *[_breaches(df, r).alias(f"b{i}") for i, r in values])
    lines = []
    for i, rule in checks:
        if isinstance(rule, Exists):
            there = rule.column in df.columns
            observed, passed = F.lit(float(there)), F.lit(there)
        else:
            observed, passed = _verdict(rule, F.col(f"b{i}"), F.col("n"))
        name = {Exists: "exists", NotNull: "not_null", Between: "between"}[type(rule)]
        lines.append(
            F.struct(F.lit(i).alias("rule_no"), F.lit(name).alias("rule"), F.lit(rule.column).alias("column_name"),
                     observed.alias("observed"), passed.alias("passed"))
        )
    return totals.select(F.inline(F.array(*lines)))


def dq_passed(report: DataFrame) -> DataFrame:
    """One row: whether every rule holds, and how many do not."""
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"), F.count_if(~F.col("passed")).alias("errors")
    )


def dq_null_rate(df: DataFrame, columns: Sequence[str], max_share: float = NULL_SHARE) -> DataFrame:
    return dq_report(df, [NotNull(c, max_share) for c in columns])


def dq_between(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return dq_report(df, [Between(c, low, high) for c, (low, high) in bounds.items()])
