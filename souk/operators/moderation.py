"""Human review of fraud alerts: an alert log and a decision log, and the state they imply."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.asof import pit_join

TX = "transaction_id"


def latest_alert(alerts: DataFrame) -> DataFrame:
    """The last alert per transaction; a re-trigger replaces the earlier entry."""
    rest = [c for c in alerts.columns if c != TX]
    last = F.max_by(F.struct(*rest), F.struct("alert_at", "alert_id")).alias("last")
    return alerts.groupBy(TX).agg(last).select(TX, *[F.col(f"last.{c}").alias(c) for c in rest])


def effective_decisions(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per transaction with a decided latest alert: the first decision made since that alert."""
    since = latest_alert(alerts).select(TX, "alert_at").join(decisions, TX).filter(
        F.col("decided_at") >= F.col("alert_at")
    )
    first = F.min_by(F.struct("action", "reviewer_id", "decided_at"), F.struct("decided_at", "decision_id"))
    return since.groupBy(TX).agg(first.alias("d")).select(TX, "d.*")


def hitl_status(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Current queue: every transaction's latest alert with its status and reviewer."""
    decided = effective_decisions(alerts, decisions).select(
        TX, F.lower("action").alias("status"), F.col("reviewer_id").alias("moderated_by")
    )
    return latest_alert(alerts).join(decided, TX, "left").withColumn(
        "status", F.coalesce("status", F.lit("pending"))
    )


def hitl_pending(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Latest alerts nobody has decided yet."""
    return latest_alert(alerts).join(effective_decisions(alerts, decisions).select(TX), TX, "left_anti")


def hitl_rejects(alerts: DataFrame, decisions: DataFrame, slot: timedelta = timedelta(minutes=10)) -> DataFrame:
    """Decisions that changed nothing, with the reason: ``not_found`` or ``already_resolved``.

    A decision belongs to the alert in force when it was made; the first one per alert is effective.
    """
    placed = pit_join(decisions, alerts, TX, "decided_at", "alert_at", ["alert_id"], "alert_id", slot=slot)
    first = placed.filter(F.col("alert_id").isNotNull()).groupBy(TX, "alert_id").agg(
        F.min(F.struct("decided_at", "decision_id"))["decision_id"].alias("first_id")
    )
    judged = placed.join(first, [TX, "alert_id"], "left")
    reason = F.when(F.col("alert_id").isNull(), F.lit("not_found")).when(
        F.col("decision_id") != F.col("first_id"), F.lit("already_resolved")
    )
    return judged.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*decisions.columns, "reason")
