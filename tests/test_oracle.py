"""Every registered query against its DuckDB oracle at sf0.001 (the driver uses sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest
from tests.conftest import SF001
from valuepay.oracle import SQL
from valuepay.queries import registered

KEYS = sorted(registered())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(SQL) == set(registered())
    assert set(registered()) <= set(E.queries())


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "value_segment" in df.columns
