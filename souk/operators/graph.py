"""Graph features over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def neighbor_mean(nodes: DataFrame, edges: DataFrame, dim: int, node: str = "node_id", features: str = "features") -> DataFrame:
    """Adds ``neighbor_mean``: the mean feature vector of a node's neighbours, zeros without any.

    The join reads each edge once and the means are partial sums, so a hub costs no more than its edges.
    """
    far = edges.join(nodes.select(F.col(node).alias("dst"), features), "dst")
    means = far.groupBy("src").agg(*[F.avg(F.col(features)[i]).alias(f"m{i}") for i in range(dim)])
    vector = means.select(F.col("src").alias(node), F.array(*[f"m{i}" for i in range(dim)]).alias("neighbor_mean"))
    zeros = F.array(*[F.lit(0.0)] * dim)
    return nodes.join(vector, node, "left").withColumn("neighbor_mean", F.coalesce("neighbor_mean", zeros))


def shared_attr_edges(memberships: DataFrame, user: str = "user_id", attribute: str = "attribute") -> DataFrame:
    """Edges ``(src, dst)`` with src < dst that connect all users of an attribute.

    Every user is linked to the attribute's smallest user. That keeps exactly the groups that linking all
    pairs would give, with one edge per membership, so an attribute shared by millions needs no cut-off.
    """
    hubs = memberships.groupBy(attribute).agg(F.min(user).alias("src"))
    linked = memberships.join(hubs, attribute).filter(F.col(user) > F.col("src"))
    return linked.select("src", F.col(user).alias("dst")).distinct()


def both_directions(edges: DataFrame) -> DataFrame:
    there, back = F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select(F.inline(F.array(there, back)))


def shared_attr_mean(nodes: DataFrame, memberships: DataFrame, dim: int, node: str = "node_id",
                     features: str = "features", user: str = "user_id", attribute: str = "attribute") -> DataFrame:
    """Adds ``neighbor_mean`` over all users sharing an attribute, counted once per shared attribute.

    Equals the mean over every pair's edge, but goes through per-attribute sums: the sum over the others is
    the attribute's total minus the node itself.
    """
    members = memberships.join(nodes.select(F.col(node).alias(user), features), user)
    x = [F.col(features)[i] for i in range(dim)]
    totals = members.groupBy(attribute).agg(
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)], F.count(F.lit(1)).alias("size")
    )
    around = members.join(totals, attribute).groupBy(user).agg(
        F.sum(F.col("size") - 1).alias("degree"), *[F.sum(F.col(f"s{i}") - c).alias(f"o{i}") for i, c in enumerate(x)]
    )
    vector = around.filter(F.col("degree") > 0).select(
        F.col(user).alias(node), F.array(*[F.col(f"o{i}") / F.col("degree") for i in range(dim)]).alias("neighbor_mean")
    )
    zeros = F.array(*[F.lit(0.0)] * dim)
    return nodes.join(vector, node, "left").withColumn("neighbor_mean", F.coalesce("neighbor_mean", zeros))
