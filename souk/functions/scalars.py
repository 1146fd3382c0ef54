"""Scalar expressions. Every function takes and returns Columns, so all of it runs inside codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score weights, label grades and defaults that results depend on.
RELEVANCE = {"view": 1, "cart": 2, "purchase": 3}
RELEVANCE_OTHER = 1
LTR_POPULARITY_WEIGHT = 0.1
LTR_CONVERSION_WEIGHT = 2.0
LTR_PRICE_WEIGHT = 0.001
CTR_POPULARITY_WEIGHT = 0.3
CTR_PRICE_WEIGHT = 0.001
CTR_BIAS = 0.5
CVR_BASE = 0.1
CVR_USER_WEIGHT = 2.0
RANKER_DEFAULT_POPULARITY = 5.0
RANKER_DEFAULT_PRICE = 50.0
RANKER_DEFAULT_CONVERSION = 0.05
RISK_GRAPH_WEIGHT = 0.40
RISK_RECONSTRUCTION_WEIGHT = 0.35
RISK_ISOLATION_WEIGHT = 0.25
SEASON_PERIOD = 12.0


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, or 0.0 where ``whole`` is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def count_text(value: Column) -> Column:
    return value.cast("string")


def rate_text(value: Column, digits: int = 4) -> Column:
    """Fixed-point text; ties go to the even digit, as in C and Python formatting."""
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def format_feature_map(fields: Mapping[str, Column]) -> Column:
    """A ``map<string,string>`` from field name to already formatted text."""
    return F.create_map(*[part for name, text in fields.items() for part in (F.lit(name), text)])


def entity_key(view: str, entity: str, identifier: Column) -> Column:
    """``fv:<view>:<entity>:<id>``."""
    return F.concat_ws(":", F.lit("fv"), F.lit(view), F.lit(entity), identifier.cast("string"))


def valid_event(user_id: Column, event_type: Column) -> Column:
    """True when both fields are present and not empty."""
    def filled(value: Column) -> Column:
        return value.isNotNull() & (value.cast("string") != "")

    return filled(user_id) & filled(event_type)


def parse_event_time(text: Column) -> Column:
    """ISO-8601 text, with or without a zone suffix, to a timestamp; null when it does not parse."""
    return F.try_to_timestamp(text)


def numeric_cast_default(text: Column, default: float) -> Column:
    """Text to double; ``default`` where the field is absent or not a number."""
    return F.coalesce(text.try_cast("double"), F.lit(float(default)))


def relevance_label(
    event_type: Column, grades: Mapping[str, int] = RELEVANCE, other: int = RELEVANCE_OTHER
) -> Column:
    """Graded relevance of an event type."""
    label = F.lit(other)
    for name, grade in grades.items():
        label = F.when(event_type == name, F.lit(grade)).otherwise(label)
    return label.cast("int")


def ltr_features(views: Column, purchases: Column, conversion: Column, price: Column, popularity: Column) -> Column:
    """The ten ranking features: five inputs, two products, three unused slots."""
    inputs = [views, purchases, conversion, price, popularity, price * conversion, popularity * views]
    return F.array(*[c.cast("double") for c in inputs], *[F.lit(0.0)] * 3)


def ltr_linear_score(popularity: Column, conversion: Column, price: Column) -> Column:
    return popularity * LTR_POPULARITY_WEIGHT + conversion * LTR_CONVERSION_WEIGHT - price * LTR_PRICE_WEIGHT


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def ctr_cvr_score(popularity: Column, price: Column, conversion: Column) -> tuple[Column, Column]:
    """Click and conversion probabilities; null inputs take the ranker's defaults."""
    popularity = F.coalesce(popularity.cast("double"), F.lit(RANKER_DEFAULT_POPULARITY))
    price = F.coalesce(price.cast("double"), F.lit(RANKER_DEFAULT_PRICE))
    conversion = F.coalesce(conversion.cast("double"), F.lit(RANKER_DEFAULT_CONVERSION))
    click = F.log1p(popularity) * CTR_POPULARITY_WEIGHT - price * CTR_PRICE_WEIGHT + CTR_BIAS
    return sigmoid(click), sigmoid(click * (conversion * CVR_USER_WEIGHT + CVR_BASE))


def hash_bucket(value: Column, buckets: int) -> Column:
    """Stable feature hashing into ``buckets`` slots."""
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def hash_bucket_md5(value: Column, buckets: int) -> Column:
    """Feature hashing by the first 32 bits of md5, reproducible outside Spark."""
    return F.pmod(md5_int(value.cast("string")), F.lit(buckets)).cast("int")


def md5_int(text: Column) -> Column:
    """First 32 bits of the md5 of ``text`` as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def json_text(value: Column) -> Column:
    """``value`` as an ASCII JSON string literal."""
    escapes = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def escape(ch: Column) -> Column:
        units = F.lower(F.hex(F.encode(ch, "UTF-16BE")))
        out = F.when(ch.rlike("^[ -~]$"), ch).otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))
        for plain, escaped in escapes.items():
            out = F.when(ch == F.lit(plain), F.lit(escaped)).otherwise(out)
        return out

    chars = F.transform(F.split(value, ""), escape)
    return F.concat(F.lit('"'), F.array_join(chars, ""), F.lit('"'))


def request_key(endpoint: Column, identifier: Column, params: Mapping[str, Column] | None = None) -> Column:
    """``cache:<endpoint>:<id>`` plus 16 hex digits of sha256 over the sorted JSON of the parameters.

    ``params`` maps a name to JSON text: a number cast to string, or ``json_text(column)``.
    """
    key = F.concat_ws(":", F.lit("cache"), endpoint, identifier.cast("string"))
    if not params:
        return key
    members = []
    for name in sorted(params):
        members += [F.lit(", " if members else ""), F.lit(f'"{name}": '), params[name].cast("string")]
    digest = F.sha2(F.concat(F.lit("{"), *members, F.lit("}")), 256)
    return F.concat(key, F.lit(":"), F.substring(digest, 1, 16))


def did_dummies(time: Column, group: Column, start: Column) -> dict[str, Column]:
    """Post, treated and interaction indicators."""
    post = (time >= start).cast("int")
    treated = group.cast("int")
    return {"post": post, "treated": treated, "interaction": post * treated}


def risk_consensus(graph: Column, reconstruction: Column, isolation: Column) -> Column:
    """Weighted risk with the two unbounded scores limited to 1."""
    return (
        graph * RISK_GRAPH_WEIGHT
        + F.least(reconstruction, F.lit(1.0)) * RISK_RECONSTRUCTION_WEIGHT
        + F.least(isolation, F.lit(1.0)) * RISK_ISOLATION_WEIGHT
    )


def basis_expand(t: Column, period: float = SEASON_PERIOD, harmonics: int = 2) -> Column:
    """Quadratic trend and Fourier terms of step ``t``: 1, t, t², then cos and sin per harmonic."""
    t = t.cast("double")
    angle = t * F.lit(2.0) * F.pi() / F.lit(period)
    waves = [fn(angle * F.lit(float(h))) for h in range(1, harmonics + 1) for fn in (F.cos, F.sin)]
    return F.array(F.lit(1.0), t, t * t, *waves)


def assign_variant(unit: Column, salt: str, weights: Mapping[str, float]) -> Column:
    """Deterministic variant of a unit: an md5 slot in 0..9999 against cumulative weights."""
    slot = F.pmod(md5_int(F.concat(F.lit(salt + "-"), unit.cast("string"))), F.lit(10000))
    total, reached = sum(weights.values()), 0.0
    names = list(weights)
    choice = F.lit(names[-1])
    bounds = []
    for name in names[:-1]:
        reached += weights[name]
        bounds.append((name, round(10000 * reached / total)))
    for name, bound in reversed(bounds):
        choice = F.when(slot < bound, F.lit(name)).otherwise(choice)
    return choice
