"""Every registered query with an SQL oracle must match DuckDB at sf0.001."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest  # noqa: E402

from conftest import SF001  # noqa: E402
from lodestar.sources.tables import TABLES  # noqa: E402

_SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_registered_has_callable():
    qs = E.queries()
    assert set(_SQL) <= set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", sorted(_SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    s_cols, s_hash, _ = digest(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(_SQL[name])
    d_cols, d_hash, _ = digest([x[0] for x in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert s_hash == d_hash


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "subject_id" in df.columns
