"""Sampled daily grid images -> flat bronze rows.

A daily image arrives as tiles: one row per (date, tile) holding an
``array<struct>`` of pixels (coordinates plus bands).  Flattening filters the
date range and bounds on the tile and pixel level, keeps the wanted bands,
explodes the pixels and drops pixels with a missing band.  All of it is narrow:
``explode`` is a generator inside the scan stage, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANDS = ["temp_k", "dew_k", "lluvia_m", "rad_j_m2", "evap_pot_m"]


def tiles_from_bronze(bronze: DataFrame) -> DataFrame:
    """Group bronze into image tiles: one row per (fecha, grid row).

    A tile holds one latitude row of the day's grid, so its size is bounded by
    the grid width, never by the data volume.
    """
    pixel = F.struct(F.col("longitud").alias("lon"), F.col("latitud").alias("lat"),
                     *(F.col(b) for b in BANDS))
    return bronze.groupBy("fecha", F.col("latitud").alias("tile_lat")).agg(
        F.collect_list(pixel).alias("pixels"))


def flatten_samples(tiles: DataFrame, start: str, end: str, bbox: tuple[float, float, float, float],
                    bands: list[str] | None = None, drop_nulls: bool = True) -> DataFrame:
    """Pixels of days in [start, end) inside bbox (lon_min, lat_min, lon_max, lat_max)."""
    lon0, lat0, lon1, lat1 = bbox
    bands = bands or BANDS
    t = tiles.filter((F.col("fecha") >= F.lit(start).cast("date"))
                     & (F.col("fecha") < F.lit(end).cast("date"))
                     & F.col("tile_lat").between(lat0, lat1))
    px = t.select("fecha", F.explode("pixels").alias("p"))
    out = px.select("fecha", F.col("p.lon").alias("longitud"), F.col("p.lat").alias("latitud"),
                    *(F.col(f"p.{b}").alias(b) for b in bands))
    out = out.filter(F.col("longitud").between(lon0, lon1) & F.col("latitud").between(lat0, lat1))
    return out.dropna(subset=bands) if drop_nulls else out
