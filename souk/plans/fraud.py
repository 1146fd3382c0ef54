"""The three fraud scores and their consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.scalars import risk_consensus
from souk.operators.anomalies import isolation_forest, recon_error
from souk.operators.graph import neighbor_mean, shared_attr_mean
from souk.operators.models import neighborhood_score
from souk.session import cut_lineage


def fraud_ensemble(nodes: DataFrame, edges: DataFrame, dim: int, node: str = "node_id", shared: bool = False) -> DataFrame:
    """``(node, graph_risk, recon_error, isolation, risk)`` for every node.

    With ``shared``, ``edges`` are memberships ``(user_id, attribute)``, and neighbours are all who share an attribute.
    """
    nodes = cut_lineage(nodes)  # three models read it
    around = shared_attr_mean(nodes, edges, dim, node) if shared else neighbor_mean(nodes, edges, dim, node)
    scores = neighborhood_score(around, node=node).join(recon_error(nodes, node=node), node)
    scores = scores.join(isolation_forest(nodes, node=node), node)
    return scores.withColumn("risk", risk_consensus(F.col("graph_risk"), F.col("recon_error"), F.col("isolation")))
