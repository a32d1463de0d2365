"""Nearest coarse cell of each fine-grid point, within a tolerance.

An epsilon join: space is cut into square bins as wide as the tolerance, each coarse
cell is copied to the 3 x 3 bins around its own, and points meet cells by an equi-join on
the bin.  Any cell within the tolerance of a point is in the point's bin after that.
Coordinates are whole micro-degrees, so distances are exact integers and the least one,
with ties by the cell's coordinates, does not depend on the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cafetal.functions import rnd, to_units

MICRO = 1_000_000


def _bin(units: Column, width: int) -> Column:
    return F.floor(units / F.lit(width)).cast("bigint")


def nearest_cell(fine: DataFrame, coarse: DataFrame, tolerance: float = 0.18) -> DataFrame:
    """Each point of ``fine`` (lat, lon) with its nearest cell of ``coarse`` (lat, lon, v) and the distance in degrees.

    Points without a cell within ``tolerance`` (inclusive, Euclidean in degrees) or with a null
    coordinate have null cells; of equally near cells the one with the smaller lat, then lon, then value
    is taken.  Repeated points stay; the longitude is not wrapped at 180 degrees.

    The nearest cell is a partial minimum per point, so points with many candidates send one
    row per task; a bin that many points share is split by the skew join of adaptive execution,
    as only the points' side grows there.
    """
    width = round(tolerance * MICRO)
    cells = coarse.select(F.col("lat").alias("lat_gruesa"), F.col("lon").alias("lon_gruesa"), F.col("v").alias("valor_grueso"),
                          to_units("lat", 6).alias("_clat"), to_units("lon", 6).alias("_clon"))
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    cells = (cells.filter("_clat IS NOT NULL AND _clon IS NOT NULL").withColumn("_o", F.explode(around))
             .withColumn("_blat", _bin(F.col("_clat"), width) + F.col("_o.i"))
             .withColumn("_blon", _bin(F.col("_clon"), width) + F.col("_o.j")).drop("_o"))
    points = (fine.groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("_veces"))
              .withColumn("_flat", to_units("lat", 6)).withColumn("_flon", to_units("lon", 6)))
    met = (points.withColumn("_blat", _bin(F.col("_flat"), width)).withColumn("_blon", _bin(F.col("_flon"), width))
           .join(cells, ["_blat", "_blon"], "left"))
    dlat, dlon = F.col("_flat") - F.col("_clat"), F.col("_flon") - F.col("_clon")
    d2 = dlat * dlat + dlon * dlon
    found = F.when(d2 <= width * width, F.struct(d2.alias("d2"), "lat_gruesa", "lon_gruesa", "valor_grueso"))
    best = met.groupBy("lat", "lon", "_veces").agg(F.min(found).alias("_b"))
    return (best.withColumn("_veces", F.explode(F.sequence(F.lit(1).cast("bigint"), "_veces")))
            .select("lat", "lon", F.col("_b.lat_gruesa").alias("lat_gruesa"), F.col("_b.lon_gruesa").alias("lon_gruesa"),
                    F.col("_b.valor_grueso").alias("valor_grueso"),
                    rnd(F.sqrt(F.col("_b.d2").cast("double")) / F.lit(float(MICRO)), 6).alias("distancia")))
