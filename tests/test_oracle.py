"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from tidepool.plans.registry import oracle_sql, queries
from conftest import SF_SMALL
from tidepool.sources.views import TABLES


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) - set(oracle_sql()) == set()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    res = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, df.collect()) == _rows(cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "rnk", "item_id", "cnt"]
    assert df.count() > 0
