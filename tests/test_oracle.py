"""Every registered query against its DuckDB oracle on the smallest driver tables (the
driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from rankforge import queries as registered

sys_tools = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")
import sys  # noqa: E402

sys.path.insert(0, sys_tools)
from check_oracle import TABLES, digest  # noqa: E402

QUERIES = registered.QUERIES
ORACLE = registered.ORACLE_SQL


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.columns == ["encounter_name", "player_name", "class", "rDPS", "aDPS", "ranked_date",
                           "duration_fmt", "guild_name", "server_name"]
    assert out.count() >= 0
