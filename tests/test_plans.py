"""Physical-plan properties that matter at scale."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from cafetal.operators import mapdata as M
from cafetal.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    """The formatted physical plan, as ``df.explain("formatted")`` prints it."""
    from cafetal.plans.explain import plan_text
    return plan_text(df)


def test_summary_has_no_cartesian_product(spark):
    plan = _plan(catalog.q_executive_summary(spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_grid_match_is_an_equi_join(spark):
    plan = _plan(catalog.q_grid_match(spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_quality_filter_reaches_the_scan(spark, scratch):
    from cafetal.sources import io
    from cafetal.operators import silver as S
    from cafetal.sources.fixture import bronze_fixture
    path = io.write_parquet(bronze_fixture(spark, SF_SMALL), scratch("b"))
    s = S.to_silver(spark.read.parquet(path))
    plan = _plan(s)
    assert "PushedFilters: [IsNotNull(temp_k), IsNotNull(dew_k)" in plan
    assert "GreaterThanOrEqual(lluvia_m,0.0)" in plan


def test_ranking_scan_prunes_columns(spark):
    plan = _plan(catalog.q_ranking(spark, SF_SMALL))
    assert "l_orderkey" not in plan and "l_returnflag" not in plan


def test_global_row_number_matches_single_partition_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id"))
    order = [F.col("k").desc(), F.col("id").asc()]
    got = {(r.k, r.id): r.puesto for r in M.global_row_number(df.repartition(13), order).collect()}
    want = {(r.k, r.id): r.rn for r in
            df.select("k", "id", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
    assert got == want


def test_aggregates_are_partial_before_every_shuffle(spark):
    for name in ("ranking", "seasonality", "point_seasonality", "thermal_amplitude", "monthly_anomaly"):
        plan = _plan(catalog.queries()[name](spark, SF_SMALL))
        assert "partial_count" in plan or "partial_sum" in plan or "partial_max" in plan, name


def test_explain_layer_returns_formatted_plans(spark):
    from cafetal.plans.explain import explain_layer, plan_facts
    plans = explain_layer(spark, SF_SMALL, "gold")
    assert set(plans) >= {"ranking_counts", "point_month_join", "top20_point_month"}
    assert "TakeOrderedAndProject" in plans["top20_point_month"]
    facts = plan_facts(plans["executive_summary"])
    assert facts["nested_loop_joins"] == 0 and facts["python_udfs"] == 0


def test_analyzed_plan_tells_what_operators_did(spark):
    from cafetal.plans.explain import analyzed_plan
    text = analyzed_plan(catalog.q_ranking_counts(spark, SF_SMALL))
    assert text.startswith("rows returned: 8") and "Scan parquet" in text and "shuffleRecordsWritten=" in text
    assert "numOutputRows=" in text.split("Scan parquet")[1]
