"""Every registered query against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from reelspark.plans import extensions as _e  # noqa: F401
from reelspark.plans import more as _m  # noqa: F401
from reelspark.plans import queries as _q  # noqa: F401
from reelspark.plans import registry
from reelspark.plans import review as _r  # noqa: F401

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(smallest):
    con = duckdb.connect()
    for f in os.listdir(smallest):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{smallest}/{f}'")
    return con


def _plain(rows):
    clean = lambda x: None if isinstance(x, float) and math.isnan(x) else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted((tuple(clean(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, smallest, name):
    df = QUERIES[name](spark, smallest)
    got = _plain(tuple(r) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    want = duck.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == _plain(want)
