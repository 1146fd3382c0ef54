import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns with names that clash."""
    rows = [
        (1, "one two three four five six seven eight", "en", "a", 39), (2, None, None, None, None), (3, "", "en", "b", 0),
        (None, "some words without an id here and there now", "en", "c", 1), (None, None, None, None, None), (4, LONG, "en", "a", len(LONG)),
        (5, LONG, "de", "b", len(LONG)), (6, "same row", "en", "a", 8), (6, "same row", "en", "a", 8), (7, "same id", "en", "a", 7),
        (7, "another text of the same id", "en", "a", 9), (8, " \n\t ", "en", "a", 4), (9, "é ü 漢字 \U0001f600 ́", "fr", "a", 9),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    clashes = ("id", "doc", "line", "blob", "band", "a", "b", "component", "n", "part", "late", "site", "h1", "first", "score", "marks", "start")
    return df.select("*", *[F.lit("clash").alias(c) for c in clashes])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
