"""The SQL of this subpackage against its queries."""

from __future__ import annotations

import duckdb
import pytest

from cafetal.llm import registry
from tests.conftest import SF_MID


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, SF_MID).toPandas()
    assert sorted(map(tuple, got[sorted(got)].itertuples(index=False))) == sorted(
        map(tuple, want[sorted(want)].itertuples(index=False)))
