"""Column functions: rounding, keys, scores, moments, physics."""

from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import functions as F

from cafetal.functions import (comfort_day, comfort_score, composite_key, icc_percent_label,
                               icc_score, optimal_day, relative_humidity, rh_clip, rnd,
                               stddev_from_moments, vpd_kpa)


def _one(spark, expr, schema, values):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_rnd_scales_then_rounds_half_away_from_zero(spark):
    got = _one(spark, rnd("v", 2), "v double", [1.005, 2.675, -1.005, 0.125, -0.125, 1.0049999, None])
    # 1.005 * 100 is the double 100.49999999999999 -> 100 (a decimal round gives 1.01);
    # 2.675 * 100 rounds to the double 267.5 -> 268
    assert got == [1.0, 2.68, -1.0, 0.13, -0.13, 1.0, None]


def test_rnd_matches_round_of_scaled_value(spark):
    vals = [i / 1000 + 0.0005 for i in range(-2000, 2000)]
    got = _one(spark, rnd("v", 3), "v double", vals)
    want = [math.copysign(math.floor(abs(v * 1000) + 0.5), v) / 1000 for v in vals]
    assert got == want


def test_composite_key_null_part_is_empty(spark):
    df = spark.createDataFrame([(4.1, None, 3), (None, -75.2, None)], "a double, b double, c int")
    got = [r[0] for r in df.select(composite_key("a", "b", "c")).collect()]
    assert got == ["4.1||3", "|-75.2|"]


@pytest.mark.parametrize("t,rh,rain,rad,score,opt", [
    (17.0, 70.0, 3.0, 10.0, 100, 1),        # every limit is inclusive
    (23.0, 85.0, 3.0, 10.0, 100, 1),
    (16.99, 70.0, 3.0, 10.0, 75, 0),
    (20.0, 85.01, 2.99, 10.0, 50, 0),
    (None, None, None, None, 0, 0),          # NULL measures score 0
    (20.0, None, 5.0, 9.99, 50, 0),
])
def test_comfort_score_limits(spark, t, rh, rain, rad, score, opt):
    df = spark.createDataFrame([(t, rh, rain, rad)],
                               "temp_c double, rh_pct double, rain_mm double, rad_mj_m2 double")
    r = df.select(comfort_score().alias("s"), optimal_day().alias("o"),
                  comfort_day(comfort_score()).alias("c")).first()
    assert (r.s, r.o, r.c) == (score, opt, 1 if score >= 75 else 0)


def test_stddev_from_moments_matches_sample_stddev(spark):
    xs = [0, 25, 25, 50, 75, 100, 100, 100, 0, 25]
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    m = df.agg(F.count("x").alias("n"), F.sum("x").alias("s1"), F.sum(F.col("x") * F.col("x")).alias("s2"))
    got = m.select(stddev_from_moments("n", "s1", "s2")).first()[0]
    assert got == pytest.approx(statistics.stdev(xs), rel=1e-12)
    one = spark.createDataFrame([(1, 25, 625)], "n long, s1 long, s2 long")
    assert one.select(stddev_from_moments("n", "s1", "s2")).first()[0] is None


def test_relative_humidity_and_clip(spark):
    df = spark.createDataFrame([(293.15, 293.15), (293.15, 283.15), (290.0, 291.0)], "t double, d double")
    got = df.select(relative_humidity("t", "d").alias("rh")).collect()
    assert got[0].rh == pytest.approx(100.0)
    assert 50 < got[1].rh < 60
    assert got[2].rh > 100           # not clipped in silver
    clipped = df.select(rh_clip(relative_humidity("t", "d"))).collect()
    assert max(r[0] for r in clipped) == pytest.approx(100.0)


def test_icc_score_and_label(spark):
    df = spark.createDataFrame([(20.0, 0.5, 75.0, 1.0), (16.0, 0.9, 50.0, -1.0), (30.0, 2.0, None, 0.0)],
                               "temp_c double, vpd_kpa double, rh_pct double, balance_mm double")
    got = df.select(icc_score().alias("i")).select("i", icc_percent_label("i").alias("p")).collect()
    assert [(r.i, r.p) for r in got] == [(40, "100.0%"), (15, "37.5%"), (5, "12.5%")]


def test_vpd_is_zero_at_saturation(spark):
    df = spark.createDataFrame([(20.0, 100.0), (20.0, 50.0)], "t double, rh double")
    got = [r[0] for r in df.select(vpd_kpa("t", "rh")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(0.61094 * math.exp(17.625 * 20 / (243.04 + 20)) * 0.5, abs=1e-4)


def test_rnd_agrees_with_decimal_round_of_the_scaled_double(spark):
    vals = ([i / 1000 + 0.0005 for i in range(-3000, 3000)]
            + [0.5, -0.5, 1.5, -1.5, 2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370495.5,
               -4503599627370495.5, 1e300, float("inf"), float("-inf"), -0.004, 0.0])
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for d in (0, 2, 4):
        ref = (F.round(F.col("v") * F.lit(float(10 ** d)), 0) / F.lit(float(10 ** d)))
        bad = df.filter(~rnd("v", d).eqNullSafe(ref)).count()
        assert bad == 0, d
    zeros = [r[0] for r in df.filter(F.col("v").isin(-0.004, 0.0)).select(rnd("v", 2)).collect()]
    assert all(math.copysign(1.0, z) == 1.0 for z in zeros)     # never -0.0
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(rnd("v", 2)).first()[0]
    assert nan != nan


def test_keys_near_zero_have_no_exponent(spark):
    from cafetal.functions import composite_key
    df = spark.createDataFrame([(0.0005, -0.0001, 3), (4.5, 0.0, 12), (1e-6, None, 1)], "a double, b double, m int")
    assert [r[0] for r in df.select(composite_key("a", "b", "m")).collect()] == [
        "0.0005|-0.0001|3", "4.5|0.0|12", "0.000001||1"]


def test_deficit_is_zero_above_full_humidity(spark):
    from cafetal.functions import vpd_kpa
    df = spark.createDataFrame([(20.0, 120.0), (20.0, 100.0), (20.0, 50.0)], "t double, rh double")
    got = [r[0] for r in df.select(vpd_kpa("t", "rh")).collect()]
    assert got[:2] == [0.0, 0.0] and got[2] > 1


def test_column_detection():
    import pytest

    from cafetal.operators.silver import detect_columns
    assert detect_columns(["lat", "lon", "datetime"])["fecha"] == "datetime"
    assert detect_columns(["lat", "lon", "fechaobs", "value"])["fecha"] == "fechaobs"
    assert detect_columns(["lat", "lon", "obsdate", "date_obs"])["fecha"] == "date_obs"
    assert detect_columns(["Latitude", "lon", "date_obs", "updated_at"]) == {
        "latitud": "Latitude", "longitud": "lon", "fecha": "date_obs"}
    for bad in (["lat", "lon", "updated_at"], ["lat", "latitud", "lon", "fecha"], ["lat", "lon", "fecha", "run_date"]):
        with pytest.raises(ValueError):
            detect_columns(bad)
