"""Every demo against its DuckDB oracle on the smallest tables (the driver
runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from feedyard.demos import registry  # noqa: E402
from feedyard.demos.registry import load_all  # noqa: E402
from feedyard.sources.fixtures import TABLES  # noqa: E402

load_all()
QUERIES, ORACLES = dict(registry.QUERIES), dict(registry.ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "feed" in df.columns and "app_number" in df.columns
