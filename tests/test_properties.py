"""Property tests: rounding and moments on generated values (one Spark job per example)."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

hyp = pytest.importorskip("hypothesis")
st = pytest.importorskip("hypothesis.strategies")
from hypothesis import HealthCheck, given, settings  # noqa: E402

from cafetal.functions import rnd, stddev_from_moments  # noqa: E402

FINITE = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FINITE, min_size=1, max_size=300), st.integers(min_value=0, max_value=6))
def test_rnd_equals_decimal_round_of_scaled_double(spark, xs, d):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    ref = F.round(F.col("v") * F.lit(float(10 ** d)), 0) / F.lit(float(10 ** d))
    assert df.filter(~rnd("v", d).eqNullSafe(ref)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([0, 25, 50, 75, 100]), min_size=2, max_size=400))
def test_stddev_from_moments_matches_statistics(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    m = df.agg(F.count("x").alias("n"), F.sum("x").alias("s1"), F.sum(F.col("x") * F.col("x")).alias("s2"))
    got = m.select(stddev_from_moments("n", "s1", "s2")).first()[0]
    assert got == pytest.approx(statistics.stdev(xs), rel=1e-12, abs=1e-12)
