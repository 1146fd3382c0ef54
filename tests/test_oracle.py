"""Every registered query against its SQL on the smallest data folder."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_entry_runs(spark, con):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "user_view_count", "user_purchase_count", "user_conversion_rate"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [r.asDict() for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    result = con.execute(ORACLES[name])
    duck_types = {c[0]: str(c[1]) for c in result.description}
    duck_rows = [dict(zip(duck_types, r)) for r in result.fetchall()]
    assert compare(rows, types, duck_rows, duck_types) is None
