"""Feature lookups by key, with cold-start defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.scalars import numeric_cast_default
from souk.sources.online import under

# Features of ids that were never materialised.
USER_DEFAULTS = {"user_view_count": 0, "user_purchase_count": 0, "user_conversion_rate": 0.0}
ITEM_DEFAULTS = {"category": "unknown", "base_price": 0.0, "popularity": 0}


def cold_start_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Nulls of the named columns replaced by their defaults."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType)) for name, value in defaults.items()
    }
    return df.withColumns(filled)


def from_online(table: DataFrame, view: str, entity: str, identifier: str, defaults: Mapping[str, object]) -> DataFrame:
    """Typed features of an online ``(key, features)`` table: text fields as stored, numbers parsed.

    A field that is absent or does not parse takes its default; one with a whole default is a bigint.
    """
    prefix = f"fv:{view}:{entity}:"
    fields = []
    for name, default in defaults.items():
        text = F.col("features")[name]
        if isinstance(default, str):
            value = F.coalesce(text, F.lit(default))
        else:
            value = numeric_cast_default(text, default).cast("bigint" if isinstance(default, int) else "double")
        fields.append(value.alias(name))
    return under(table, prefix).select(
        F.substring_index("key", ":", -1).alias(identifier), *fields
    )


def _lookup(requests: DataFrame, features: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    kept = features.select(key, *defaults)
    return cold_start_defaults(requests.join(kept, key, "left"), defaults)


def user_feature_lookup(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Every request row with its user's features.

    Duplicates stay; carry a position column in ``requests`` to keep their order. A user requested very
    often is a skewed left side, which adaptive execution splits.
    """
    return _lookup(requests, features, "user_id", USER_DEFAULTS)


def item_feature_lookup(requests: DataFrame, features: DataFrame) -> DataFrame:
    return _lookup(requests, features, "item_id", ITEM_DEFAULTS)


def user_item_features(candidates: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Candidate pairs with the features of their user and their item."""
    return item_feature_lookup(user_feature_lookup(candidates, users), items)
