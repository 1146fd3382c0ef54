"""Toxicity by a weighted finite-state grammar over clauses.

Words map to labels: insult, threat, target, negation, report, modal, intensifier, quotation mark or none. Small weighted
transducers read a clause's labels; each has states (how long ago its own label came), arcs, and weights on the arcs of matches,
that is of insults and threats:

* an intensifier before a match raises it, a negation lowers it ("not an idiot");
* a report verb before it, or quotation marks around it, lower it ("he was called an idiot");
* a threat needs a modal before it to count in full;
* a target within reach, on either side, raises a match.

``Composed`` is their composition: it reads once, its states are tuples, and the weights on an arc multiply. A clause weighs the
sum of its matches, each the weight of its insult times that of the composition's arc. A logistic curve, fitted on labelled
rows, maps a text's heaviest clause and its total to a score. Only texts in which a trigger word occurs are parsed at all.

Insults are learned: words that stand in many *different* contexts (neighbouring words) of toxic rows, and hardly
ever elsewhere. Counting contexts instead of rows keeps copies of one toxic text from teaching all their words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Hashable, Iterable
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.common import map_batches

#: Labelled rows that the fit may use: those of smallest hash. They bound the words that the grammar learns.
FIT_ROWS = 20_000
#: A learned insult needs so many contexts in toxic rows, and so many times the share it has in other rows.
CONTEXTS, LIFT = 5, 8.0
#: Fixed symbols of the grammar.
THREATS = frozenset("kill murder hurt beat stab shoot strangle burn destroy hang lynch rape slaughter punch smash drown".split())
TARGETS = frozenset(
    "you your yours yourself u ur he him his she her they them their these those people everyone all du dich dir ihr euch sie tu toi "
    "te vous ton ta tes usted ustedes tú".split()
)
NEGATIONS = frozenset("not no never neither nor without isn aren wasn weren don doesn didn won wouldn hardly nicht kein keine nie pas jamais nunca".split())
REPORTS = frozenset(
    "said says say called calls wrote writes quoted quotes quote reported reports claimed claims alleged allegedly accused tweeted shouted "
    "according word words term sagte dit dijo".split()
)
MODALS = frozenset("will shall should must gonna going want wanna let ll deserve deserves hope need".split())
INTENSIFIERS = frozenset("so such very really fucking damn bloody total complete utter absolute absolutely".split())
#: Words between the parts of a pattern at most, and the factors of the transducers.
REACH = 4
TARGETED, INTENSE, NEGATED, REPORTED = 1.25, 1.15, 0.15, 0.3
THREAT_WEIGHT, BARE_THREAT = 1.0, 0.05
#: Score from which a text counts as toxic.
CUT = 0.7

_CLAUSE = re.compile(r"[.!?;:\n]+")
_TOKEN = re.compile(r"\w+|[\"“”«»„]")
_QUOTES = frozenset('"“”«»„')


#: What a token is to the transducers; a word may be several at once.
QUOTE, INSULT, THREAT, TARGET, NEGATION, REPORT, MODAL, INTENSIFIER = (1 << i for i in range(8))
MATCH = INSULT | THREAT
_LABELS = ((NEGATION, NEGATIONS), (REPORT, REPORTS), (MODAL, MODALS), (INTENSIFIER, INTENSIFIERS))


class Transducer(Protocol):
    """A deterministic machine over token labels: every arc leads to a state and carries the weight of a match on it."""

    start: Hashable

    def arc(self, state: Hashable, labels: int) -> tuple[Hashable, float]: ...


@dataclass(frozen=True)
class Recall:
    """Weighs matches of ``of`` by whether a token of ``label`` came at most ``REACH`` tokens before. States are the tokens since."""

    label: int
    near: float
    far: float = 1.0
    of: int = MATCH
    start: int = REACH + 1

    def arc(self, state: int, labels: int) -> tuple[int, float]:
        weight = (self.near if state <= REACH else self.far) if labels & self.of else 1.0
        return 1 if labels & self.label else min(state + 1, REACH + 1), weight


@dataclass(frozen=True)
class Reported:
    """Weighs matches in reported speech: after a word that reports, or between quotation marks."""

    near: float
    start: tuple[int, bool] = (REACH + 1, False)

    def arc(self, state: tuple[int, bool], labels: int) -> tuple[tuple[int, bool], float]:
        since, quoted = state
        weight = self.near if labels & MATCH and (since <= REACH or quoted) else 1.0
        return (1 if labels & REPORT else min(since + 1, REACH + 1), quoted ^ bool(labels & QUOTE)), weight


class Composed:
    """The composition of transducers that read the same tokens: states are tuples, weights multiply.

    Arcs are made when a text first takes them and kept, so reading a token is one look-up.
    """

    def __init__(self, *parts: Transducer):
        self._parts = parts
        self.start = tuple(p.start for p in parts)
        self._arcs: dict[tuple[Hashable, int], tuple[Hashable, float]] = {}

    def arc(self, state: tuple, labels: int) -> tuple[tuple, float]:
        found = self._arcs.get((state, labels))
        if found is None:
            steps = [part.arc(one, labels) for part, one in zip(self._parts, state)]
            found = self._arcs[state, labels] = tuple(to for to, _ in steps), math.prod(w for _, w in steps)
        return found

    def weights(self, labels: Iterable[int]) -> list[float]:
        """The weight on the arc of each token."""
        state, out = self.start, []
        for one in labels:
            state, weight = self.arc(state, one)
            out.append(weight)
        return out


#: Insults and threats, strengthened by intensifiers, threats by modals, weakened by negation and reported speech.
CLAUSE = Composed(Recall(INTENSIFIER, INTENSE), Recall(NEGATION, NEGATED), Reported(REPORTED), Recall(MODAL, THREAT_WEIGHT, BARE_THREAT, THREAT))
#: A target may stand before a match or after it, so this one reads the clause from both ends.
AIM = Composed(Recall(TARGET, TARGETED))


@dataclass(frozen=True)
class Grammar:
    """Insult weights in (0, 1]; the other symbols are fixed."""

    insults: dict[str, float]

    def triggers(self) -> frozenset[str]:
        return frozenset(self.insults) | THREATS

    def labels(self, word: str) -> int:
        if word in _QUOTES:
            return QUOTE
        kind = INSULT if self.insults.get(word) else THREAT if word in THREATS else TARGET if word in TARGETS else 0
        return kind | sum(label for label, words in _LABELS if word in words)

    def clause_weight(self, words: list[str]) -> float:
        """Weight of the composed transducers over one clause: the sum over its matches."""
        labels = [self.labels(word) for word in words]
        before, after = AIM.weights(labels), AIM.weights(labels[::-1])[::-1]
        return sum(
            (self.insults.get(word) or 1.0) * weight * max(aimed, ahead)
            for word, one, weight, aimed, ahead in zip(words, labels, CLAUSE.weights(labels), before, after) if one & MATCH
        )

    def features(self, text: str, triggers: frozenset[str]) -> tuple[float, float]:
        """The heaviest clause's weight, and the total over clauses."""
        lowered = text.lower()
        if triggers.isdisjoint(lowered.split()) and triggers.isdisjoint(_TOKEN.findall(lowered)):
            return 0.0, 0.0
        weights = []
        for clause in _CLAUSE.split(lowered):
            words = _TOKEN.findall(clause)
            if not triggers.isdisjoint(words):
                weights.append(self.clause_weight(words))
        return (max(weights), sum(weights)) if weights else (0.0, 0.0)


def inputs(heaviest: float, total: float) -> tuple[float, float]:
    """What the curve reads: saturating forms, so that one targeted insult already tells."""
    return 1 - math.exp(-3 * heaviest), math.log1p(total)


def held_out(key: Column) -> Column:
    """Rows that no fit may see: CRC-32 of the key as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _sample(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("toxic")).filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id"))
    )
    one = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64("id"), "id").limit(rows)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = FIT_ROWS) -> tuple[Grammar, list[float]]:
    """The grammar's insults and the curve's coefficients, from labelled rows that are not held out.

    The sample is at most ``rows`` rows, so it may be broadcast, and its features may come to the driver. Without
    labelled rows of both kinds the grammar has no insults and the curve is the fixed prior.
    """
    sample = _sample(labels, key, label, rows)
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("text is not null").join(F.broadcast(sample), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.first("toxic").alias("toxic")
    )
    words = F.expr("split(lower(text), '[^\\\\p{L}\\\\p{N}_]+')")
    terms = texts.select("id", "toxic", words.alias("w")).select(
        "id", "toxic",
        F.explode(F.transform("w", lambda w, i: F.struct(
            w.alias("term"),
            F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("context"),
        ))).alias("t"),
    ).select("id", "toxic", "t.term", "t.context").filter(F.length("term") >= 3).distinct()
    bad = terms.filter("toxic = 1").groupBy("term").agg(F.count_distinct("context").alias("bad")).filter(F.col("bad") >= CONTEXTS)
    good = terms.filter("toxic = 0").groupBy("term").agg(F.count("*").alias("good"))
    sizes = sample.groupBy().agg(F.sum("toxic").alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")).first()
    n_bad, n_good = sizes["bad"] or 0, sizes["good"] or 0
    if not n_bad or not n_good:
        return Grammar({}), [-3.0, 0.0, 0.0]
    lift = (F.col("bad") + 0.0) / n_bad / ((F.coalesce("good", F.lit(0)) + 0.5) / n_good)
    learned = bad.join(good, "term", "left").select("term", "bad", lift.alias("lift")).filter(F.col("lift") >= LIFT)
    top = learned.collect()  # words of a bounded sample, on many contexts and mostly in toxic ones
    grammar = Grammar({r["term"]: min(1.0, math.log(r["lift"]) / math.log(LIFT * 8)) for r in top})
    seen = _features(texts.select("id", "text", "toxic"), grammar, "text").select("toxic", *FEATURES).collect()
    x = np.array([(1.0, *inputs(r[FEATURES[0]], r[FEATURES[1]])) for r in seen])
    y = np.array([float(r["toxic"]) for r in seen])
    return grammar, _fit(x, y)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> list[float]:
    """Newton steps of a ridge logistic regression on three columns."""
    if not len(y):
        return [-3.0, 0.0, 0.0]
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


FEATURES = ("__souk_heaviest", "__souk_total")


def _features(rows: DataFrame, grammar: Grammar, text: str) -> DataFrame:
    """All columns of ``rows`` and the two features of the column ``text``."""

    def start():
        triggers = grammar.triggers()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([grammar.features(t.as_py() or "", triggers) for t in batch.column(text)])
            return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[:, j]) for j in range(2))], [*batch.schema.names, *FEATURES])

        return step

    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in FEATURES)])
    return map_batches(rows, start, schema)


def _score(curve: list[float]) -> Column:
    raw = F.lit(curve[0]) + curve[1] * (1 - F.exp(-3 * F.col(FEATURES[0]))) + curve[2] * F.log1p(FEATURES[1])
    return 1 / (1 + F.exp(-raw))


def score(docs: DataFrame, grammar: Grammar, curve: list[float], key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` in 0 to 1 and ``predicted`` (1 from ``cut``).

    A null or empty text has no clauses and gets the curve's prior. Repeated rows give repeated rows, a null key
    stays null, other columns are ignored. Rows stay in their tasks.
    """
    found = _features(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), grammar, "text")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _score(curve).alias("score")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int")
    )


def keep_clean(docs: DataFrame, grammar: Grammar, curve: list[float], text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` with a score below ``cut``, with all their columns.

    Null and empty texts have the curve's prior and stay unless that is toxic; equal rows go or stay together, rows with a null
    key are judged like others, and an empty table gives no rows.
    """
    return _features(docs, grammar, text).filter(_score(curve) < cut).select(*docs.columns)
