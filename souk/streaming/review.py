"""Review queue and guardrail over live streams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues, ValueState

from souk.operators.experiments import seq_guardrail

TX = "transaction_id"
PENDING = "pending"
ALERT, DECISION = 0, 1
ENTRY = "alert_id string, user_id string, amount double, alert_at bigint, status string, moderated_by string"
QUEUE = f"{TX} string, {ENTRY}"
QUEUE_ROW = Row(*[field.split()[0] for field in QUEUE.split(", ")])
ALERT_STATE = "at bigint, id bigint, who string, amount double"
DECISION_STATE = "at bigint, id bigint, action string, who string"


def stream_guardrail(observations: DataFrame, metric: str = "metric") -> DataFrame:
    """The early-stopping decision kept up to date: state is a count, mean and spread per arm."""
    return seq_guardrail(observations, metric)


def review_events(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Alerts and decisions in one stream, with the event time in ``time`` and, in microseconds, in ``at``.

    Microseconds reach Python without a zone conversion per group.
    """
    text, none = "string", F.lit(None)
    a = alerts.select(
        F.col(TX).cast(text), F.lit(ALERT).alias("kind"), F.col("alert_at").cast("timestamp").alias("time"),
        F.col("alert_id").cast("bigint").alias("id"), F.col("user_id").cast(text).alias("who"), F.col("amount").cast("double"),
        none.cast(text).alias("action"),
    )
    d = decisions.select(
        F.col(TX).cast(text), F.lit(DECISION).alias("kind"), F.col("decided_at").cast("timestamp").alias("time"),
        F.col("decision_id").cast("bigint").alias("id"), F.col("reviewer_id").cast(text).alias("who"), none.cast("double").alias("amount"),
        "action",
    )
    return a.unionByName(d).withColumn("at", F.unix_micros("time"))


class Review(StatefulProcessor):
    """One queue entry per transaction: the latest alert by event time, and the first decision made since.

    State is the alert, the decision in force, and a list of the decisions that a late alert could still bring into force.
    Nothing older than the watermark arrives any more, so a decision behind it can only be in force if it is the first since
    the alert; a timer lets the others go when the watermark passes them, and the whole entry once it is resolved. State
    time-to-live goes by the clock and not by event time, so timers do its work.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._alert = handle.getValueState("alert", ALERT_STATE)
        self._first = handle.getValueState("first", DECISION_STATE)
        self._held = handle.getListState("held", DECISION_STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        return self._settled(key, rows, timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        return self._settled(key, (), timerValues)

    def _settled(self, key: tuple, rows: Iterable[Row], timers: TimerValues) -> Iterator[Row]:
        before = tuple(tuple(s) if s is not None else None for s in (self._alert.get(), self._first.get()))
        alert, first = before
        made = [tuple(d) for d in self._held.get()] + ([first] if first else [])
        for row in rows:
            if row.kind == DECISION:
                made.append((row.at, row.id, row.action or "", row.who))
            elif alert is None or (row.at, row.id) > alert[:2]:
                alert = (row.at, row.id, row.who, row.amount)
        watermark = timers.getCurrentWatermarkInMs() * 1000
        made = sorted({d for d in made if alert is None or d[0] >= alert[0]}, key=lambda d: (d[:3], d[3] or ""))
        first = made[0] if alert is not None and made else None
        held = [d for d in made if d[0] >= watermark and d != first]
        if (alert is None or (first is not None and first[0] < watermark)) and not held:
            for state in (self._alert, self._first, self._held):
                state.clear()
            self._wake(None)
        else:
            self._store(self._alert, alert)
            self._store(self._first, first)
            self._held.put(held) if held else self._held.clear()
            waits = [d[0] for d in ([first] if first else []) + held]
            self._wake(max(max(waits), watermark) // 1000 + 1 if waits else None)  # when all of them are settled
        if alert is not None and before != (alert, first):
            status = (first[2].lower() or PENDING, first[3]) if first else (PENDING, None)
            yield QUEUE_ROW(key[0], str(alert[1]), alert[2], alert[3], alert[0], *status)

    @staticmethod
    def _store(state: ValueState, value: tuple | None) -> None:
        state.clear() if value is None else state.update(value)

    def _wake(self, at: int | None) -> None:
        """One timer per transaction."""
        known = list(self._handle.listTimers())
        for old in known:
            if old != at:
                self._handle.deleteTimer(old)
        if at is not None and at not in known:
            self._handle.registerTimer(at)


def stream_hitl(alerts: DataFrame, decisions: DataFrame, late: str = "1 day") -> DataFrame:
    """Queue entries changed by each micro-batch, equal to the batch queue whatever order rows within ``late`` arrive in.

    An older alert never replaces a newer one, and a decision may come before its alert. State is one entry per
    transaction, dropped once it is resolved and the watermark has passed its decision; pending entries stay. It needs
    the RocksDB state store, which ``build_session`` sets and ``rocksdb_state`` lends to other sessions.
    """
    events = review_events(alerts, decisions).filter(F.col("time").isNotNull()).withWatermark("time", late)
    entries = events.groupBy(TX).transformWithState(Review(), QUEUE, "Update", "EventTime")
    return entries.withColumn("alert_at", F.timestamp_micros("alert_at"))
