"""Driver contract: entry(), queries() and oracle_sql(), checked against
DuckDB on the smallest driver tables (same check the driver runs at sf0.01)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ordermill import oracle, registry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "total_revenue", "top_category", "top_category_revenue"]
    assert df.count() > 0


LIBRARY = sorted(registry.queries())


def test_every_query_has_an_oracle():
    assert set(LIBRARY) == set(oracle.oracle_sql())
    assert set(LIBRARY) <= set(entry.queries())


@pytest.mark.parametrize("name", LIBRARY)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(srows, scols) == _rows(drows, dcols)
