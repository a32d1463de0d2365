"""Documented gold indicators: VPD, degree days, water balance, the 40-point
comfort index, thermal anomalies, grid matching and the diurnal amplitude.

Shuffle notes:
* Daily indicators are narrow projections.
* Aggregates use exact integer sums (hundredths) so they re-aggregate exactly
  and do not depend on the partitioning.
* Windows are only used over partitions whose size is bounded by the calendar
  (years per point-month), never over a raw data key.
* The grid match is an equi-join on integer lattice keys, so Spark can pick a
  hash join (broadcast only when AQE measures the coarse side small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cafetal import constants as K
from cafetal.functions import (gdd, icc_percent_label, icc_score, pct, rh_clip, rnd,
                               stddev_from_moments, to_units, vpd_kpa, water_balance)
from cafetal.operators.gold import bbox_filter


def daily_indicators(silver: DataFrame) -> DataFrame:
    """Per gold-region day: clipped RH, VPD, degree days, water balance, ICC."""
    s = bbox_filter(silver).select(
        "pk_silver", "fecha", "anio", "mes", "lat", "lon", "temp_c", "rh_pct",
        rh_clip("rh_pct").alias("rh_clip_pct"),
        vpd_kpa("temp_c", "rh_pct").alias("vpd_kpa"),
        gdd("temp_c").alias("gdd"),
        water_balance("rain_mm", "evap_pot_mm").alias("balance_mm"))
    s = s.withColumn("icc", icc_score())
    return s.withColumn("icc_pct", icc_percent_label("icc"))


def gdd_annual(silver: DataFrame) -> DataFrame:
    """Degree days per point and year (sum of the daily 2-decimal values, exact)."""
    d = daily_indicators(silver)
    agg = d.groupBy("lat", "lon", "anio").agg(F.sum(to_units("gdd", 2)).alias("_g"),
                                              F.count(F.lit(1)).alias("dias"))
    return agg.select("lat", "lon", "anio", "dias",
                      (F.col("_g").cast("double") / F.lit(100.0)).alias("gdd_total"))


def _icc_moments(d: DataFrame, keys: list[str]) -> DataFrame:
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                F.sum("icc").cast("bigint").alias("s1"),
                                F.sum(F.col("icc") * F.col("icc")).cast("bigint").alias("s2"))


def icc_ranking(silver: DataFrame) -> DataFrame:
    """Per point: mean comfort index (0..40) and as a percentage."""
    m = _icc_moments(daily_indicators(silver), ["lat", "lon"])
    mean = F.col("s1").cast("double") / F.col("n").cast("double")
    return m.select("lat", "lon", F.col("n").alias("dias"),
                    rnd(mean, 2).alias("icc_promedio"),
                    rnd(pct("s1", F.col("n") * F.lit(K.ICC_MAX_POINTS)), 2).alias("icc_pct"))


def icc_top_points(silver: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best coordinates by historical mean index (lat, lon break ties)."""
    return icc_ranking(silver).orderBy(F.col("icc_promedio").desc(), "lat", "lon").limit(n)


def icc_seasonality(silver: DataFrame) -> DataFrame:
    """Per calendar month: mean and sample standard deviation of the index."""
    m = _icc_moments(daily_indicators(silver), ["mes"])
    return m.select("mes", F.col("n").alias("dias"),
                    rnd(F.col("s1").cast("double") / F.col("n").cast("double"), 2).alias("icc_promedio"),
                    rnd(stddev_from_moments("n", "s1", "s2"), 2).alias("icc_desviacion"))


def monthly_anomaly(silver: DataFrame) -> DataFrame:
    """Point-month mean temperature minus the point's mean for that calendar month.

    Partial sums per (point, year, month) are exact integers (hundredths); the
    climatology is their sum over years, taken with a window whose partitions
    hold one row per year.
    """
    s = bbox_filter(silver)
    pm = s.groupBy("lat", "lon", "anio", "mes").agg(F.count(F.lit(1)).alias("n"),
                                                    F.sum(to_units("temp_c", 2)).alias("st"))
    w = Window.partitionBy("lat", "lon", "mes")
    mean_pm = F.col("st").cast("double") / F.col("n").cast("double") / F.lit(100.0)
    mean_clim = (F.sum("st").over(w).cast("double") / F.sum("n").over(w).cast("double")
                 / F.lit(100.0))
    return pm.select("lat", "lon", "anio", "mes", F.col("n").alias("dias"),
                     rnd(mean_pm, 2).alias("temp_media"),
                     rnd(mean_clim, 2).alias("temp_climatologia"),
                     rnd(mean_pm - mean_clim, 2).alias("anomalia"))


def lattice_key(c, step_decimals: int = 1):
    """Integer key of a coordinate rounded to ``step_decimals`` (e.g. 0.1 degree)."""
    return F.round(F.col(c) * F.lit(float(10 ** step_decimals)), 0).cast("bigint")


def grid_match(fine: DataFrame, coarse: DataFrame) -> DataFrame:
    """Pair each fine-grid point with the coarse cell that rounds to the same 0.1 degree.

    Equivalent to |round(a,1) - round(b,1)| < 0.01 on both axes, expressed as an
    equi-join on integer keys instead of a nested-loop tolerance join.
    """
    f = fine.select(F.col("lat"), F.col("lon"),
                    lattice_key("lat").alias("_klat"), lattice_key("lon").alias("_klon"))
    c = coarse.select(F.col("lat").alias("lat_gruesa"), F.col("lon").alias("lon_gruesa"),
                      F.col("v").alias("valor_grueso"),
                      lattice_key("lat").alias("_klat"), lattice_key("lon").alias("_klon"))
    return f.join(c, ["_klat", "_klon"], "inner").drop("_klat", "_klon")


def local_time(readings: DataFrame, ts_col: str = "ts_utc") -> DataFrame:
    """UTC readings shifted to local time (UTC-5) as ``hora_local``."""
    shift = F.expr(f"INTERVAL {abs(K.LOCAL_UTC_OFFSET_HOURS)} HOURS")
    shifted = (F.col(ts_col) - shift) if K.LOCAL_UTC_OFFSET_HOURS < 0 else (F.col(ts_col) + shift)
    return readings.withColumn("hora_local", shifted)


def thermal_amplitude(readings: DataFrame) -> DataFrame:
    """Per point and local day: max - min of the 00h and 12h local readings.

    Days without both a 00h and a 12h reading are dropped.  Presence of each
    hour is a max() of a flag, so the aggregate stays partial-aggregatable
    (no count-distinct).
    """
    r = local_time(readings)
    h = F.hour("hora_local")
    r = r.filter(h.isin(0, 12)).select(
        "punto", F.to_date("hora_local").alias("fecha_local"), "lectura",
        F.when(h == 0, 1).otherwise(0).alias("_h0"), F.when(h == 12, 1).otherwise(0).alias("_h12"))
    agg = r.groupBy("punto", "fecha_local").agg(
        F.max("lectura").alias("t_max"), F.min("lectura").alias("t_min"),
        F.count(F.lit(1)).alias("lecturas"),
        F.max("_h0").alias("_h0"), F.max("_h12").alias("_h12"))
    return (agg.filter((F.col("_h0") == 1) & (F.col("_h12") == 1))
               .select("punto", "fecha_local", "t_max", "t_min", "lecturas",
                       (F.col("t_max") - F.col("t_min")).alias("amplitud")))
