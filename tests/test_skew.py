"""A grid point holding a third of all rows: results stay exact and whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from cafetal.operators import gold as G
from cafetal.operators import mapdata as M
from cafetal.operators import silver as S
from cafetal.sources.fixture import bronze_fixture
from tests.conftest import SF_MID, rows


def _hot_bronze(spark):
    b = bronze_fixture(spark, SF_MID)
    n = b.count()
    # copy every row of the data onto one point, shifted by whole days so keys stay unique,
    # until that point holds about a third of all rows
    hot = (b.select("fecha", "temp_k", "dew_k", "lluvia_m", "rad_j_m2", "evap_pot_m")
             .withColumn("fecha", F.date_add("fecha", F.lit(40000)))
             .withColumn("latitud", F.lit(4.999607)).withColumn("longitud", F.lit(-75.599525))
             .limit(n // 2))
    return b.unionByName(hot), n


def test_hot_point_gold_is_exact(spark):
    b, n = _hot_bronze(spark)
    silver = S.to_silver(b)
    direct = rows(G.ranking(silver))
    via_cube = rows(G.gold_tables(silver)["ranking"])
    assert direct == via_cube
    hot = [r for r in direct if (r[1], r[2]) == (4.999607, -75.599525)]
    assert len(hot) == 1 and hot[0][3] > n // 3
    es_direct = rows(G.seasonality(silver))
    es_cube = rows(G.gold_tables(silver)["seasonality"])
    assert es_direct == es_cube


def test_rank_numbers_with_many_ties_are_a_permutation(spark):
    b, _ = _hot_bronze(spark)
    rk = G.ranking(S.to_silver(b)).withColumn("score_final", F.lit(50.0))   # all tied
    feed = M.map_feed(rk).collect()
    assert sorted(r.puesto for r in feed) == list(range(1, len(feed) + 1))
    assert sum(r.elite for r in feed) == 5
