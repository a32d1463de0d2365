"""Every registered query against its independent SQL statement (DuckDB) at sf0.001."""

from __future__ import annotations

import datetime
import os

import pytest

import __spark_entry__ as E
from cafetal.plans import catalog, oracle
from tests.conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")
pd = pytest.importorskip("pandas")

TABLES = ["lineitem", "supplier", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, float) and v == 0.0:
        return 0.0
    if isinstance(v, datetime.datetime):
        return pd.Timestamp(v)
    if isinstance(v, datetime.date):
        return pd.Timestamp(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes, pd.Timestamp)):
        return v.item()
    return v


def canon(pdf):
    pdf = pdf[sorted(pdf.columns)]
    out = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


SQL, QUERIES = oracle.oracle_sql(), catalog.queries()      # of the climate layers


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got) == canon(want)


def test_entry_registers_them(spark):
    assert set(QUERIES) <= set(E.queries()) and SQL.items() <= E.oracle_sql().items()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pk_gold", "lat", "lon", "dias_evaluados", "dias_optimos", "pct_optimos",
                          "score_final"]
    assert df.count() == 8        # 10 grid points at sf0.001, 8 inside the gold region
    assert os.path.isdir(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 86


def test_oracle_sees_rules_the_operators_could_share(spark, con):
    """Figures that follow from the given tables alone."""
    n = con.execute("SELECT count(DISTINCT l_suppkey) FROM lineitem").fetchall()[0][0]
    points = QUERIES["silver"](spark, SF_SMALL).select("lat", "lon").distinct().count()
    assert points == n                                      # a point per supplier, never folded
    assert QUERIES["vpd"](spark, SF_SMALL).filter("vpd_kpa < 0").count() == 0
