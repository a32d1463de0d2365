"""Climate-shaped inputs projected from the supplied tables.

The supplied tables hold no climate data, so the bronze table, the coarse
grid and the hourly readings are derived from ``lineitem``, ``supplier`` and
``events`` by fixed rules (documented in FIXTURES.md).  The derivation is a
plain Spark aggregation, so its work grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cafetal.functions.numeric import rnd


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Keys are cut to the modulus before they are multiplied, so that no key overflows.
def _longitude(s):
    return ((F.lit(-76600000) + F.lit(10000) * ((s % 220 * 31) % 220) + F.floor(s / F.lit(22000.0)).cast("long")).cast("double")
            / F.lit(1e6))


def _latitude(s):
    return (F.lit(3900007) + F.lit(100) * ((s % 22000 * 7919) % 22000)).cast("double") / F.lit(1e6)


def bronze_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (day, grid point) with bronze names and units (K, m, J/m2).

    Every supplier is a point of its own, so points and rows grow with the tables;
    about a sixth of the points lies outside the gold region.
    """
    li = table(spark, sf_dir, "lineitem")
    g = (li.groupBy(F.col("l_shipdate").cast("date").alias("fecha"),
                    F.col("l_suppkey").cast("long").alias("s"))
         .agg(F.max("l_quantity").alias("q"),
              rnd(F.min("l_discount") * 100, 0).alias("d"),
              rnd(F.min("l_tax") * 100, 0).alias("t"),
              F.max("l_extendedprice").alias("p"),
              F.max("l_linenumber").alias("n"),
              F.min("l_quantity").alias("q0")))
    q, d, t, p, n, q0 = (F.col(c) for c in ("q", "d", "t", "p", "n", "q0"))
    base_k = (F.lit(28315.0) + F.lit(40.0) * q)
    return g.select(
        "fecha",
        _longitude(F.col("s")).alias("longitud"), _latitude(F.col("s")).alias("latitud"),
        F.when((n == 6) & (q == 1), F.lit(None).cast("double"))
         .when((n == 5) & (q == 50) & (t == 8), F.lit(999.0))
         .otherwise(base_k / F.lit(1e2)).alias("temp_k"),
        ((base_k - F.lit(100.0) * d + F.lit(10.0)) / F.lit(1e2)).alias("dew_k"),
        F.when((n == 7) & (q0 == 50), F.lit(-1e-4)).otherwise(t / F.lit(1e3)).alias("lluvia_m"),
        (p * F.lit(200.0)).alias("rad_j_m2"),
        ((d * F.lit(5.0) - F.lit(40.0)) / F.lit(1e4)).alias("evap_pot_m"),
    )


def coarse_grid_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 0.25-degree grid with one value per cell, from ``supplier``.

    The grid is a fixed region of 9 x 9 cells; only the values read grow.
    """
    s = table(spark, sf_dir, "supplier")
    lat = (F.lit(4010000) + F.lit(250000) * (F.col("s_suppkey") % 9)).cast("double") / F.lit(1e6)
    lon = ((F.lit(-76490000) + F.lit(250000) * (F.floor(F.col("s_suppkey") / F.lit(9.0)).cast("bigint") % 9))
           .cast("double") / F.lit(1e6))
    return s.groupBy(lat.alias("lat"), lon.alias("lon")).agg(F.min("s_acctbal").alias("v"))


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly point readings in UTC: point = user_id, reading = value, time = ts."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").alias("punto"),
                     F.col("ts").alias("ts_utc"), F.col("value").alias("lectura"))


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings of stations at grid points, moved into the years of the daily grid.

    A station stands at the point of the supplier whose number its user number leaves modulo the number of suppliers;
    its clock is 26 years back.
    """
    points = max(1, table(spark, sf_dir, "supplier").count())
    s = F.col("punto") % points
    moved = F.col("ts_utc") - F.expr("INTERVAL 26 YEARS")
    return (hourly_readings(spark, sf_dir)
            .select("event_id", rnd(_latitude(s), 6).alias("lat"), rnd(_longitude(s), 6).alias("lon"),
                    moved.alias("ts_utc"), (moved - F.expr("INTERVAL 5 HOURS")).cast("date").alias("fecha_local"), "lectura"))
