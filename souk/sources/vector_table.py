"""Vector index tables: ``(item_id, embedding)`` rows holding unit vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.vectors import l2_normalize


def write_vectors(items: DataFrame, path: str, item_id: str = "item_id", embedding: str = "embedding") -> None:
    """Normalise and store; the float array keeps the table half the size of doubles."""
    items.select(
        F.col(item_id).alias("item_id"), l2_normalize(F.col(embedding)).cast("array<float>").alias("embedding")
    ).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
