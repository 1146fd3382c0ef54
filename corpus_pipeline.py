"""The corpus pipeline: documents to tokens in five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.llm import bpe, leaks, lines, minhash, toxicity
from souk.llm.common import table, written
from souk.llm.queries import vocabulary

#: Near copies share at least this many of a hundred shingles of so many words.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic rows; see ``toxicity.keep_clean`` for nulls, repeats and empty tables."""
    grammar, curve = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, grammar, curve)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines of many sites out; see ``lines.without_boilerplate``."""
    return lines.without_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays; see ``minhash.keep_one``."""
    return minhash.keep_one(docs, k=SHINGLE, percent=PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go; see ``leaks.remove_leaking``."""
    return leaks.remove_leaking(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests per row; see ``bpe.bpe_digests``."""
    return bpe.bpe_digests(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", tokenize),
]

#: The grammar's learned curve, signatures, edit distances and tokens are beyond SQL; tests compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
