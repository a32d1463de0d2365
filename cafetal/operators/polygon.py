"""Points in polygons by a grid index of the edges.

Polygons are a table of rings (``polygon``, ``ring``, ``seq``, ``lat``, ``lon``; the last vertex of a ring
leads back to its first, rings within rings are holes).  Space is cut into square cells.  A cell that no edge
touches lies wholly inside or wholly outside, so it is decided once, by its centre, for all its points; only
points in cells with edges are tested themselves.  A test looks at the edges of its own band of latitudes, not at all.
Coordinates are whole micro-degrees (doubled for centres), so all of this is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cafetal.functions import to_units

CELL = 200_000      # micro-degrees


def _bands(a: Column, b: Column, cell: int) -> Column:
    return F.sequence(F.floor(F.least(a, b) / F.lit(2 * cell)), F.floor(F.greatest(a, b) / F.lit(2 * cell)))


def polygon_edges(vertices: DataFrame) -> DataFrame:
    """Edges (polygon, y1, x1, y2, x2) of the rings, in doubled micro-degrees; edges without length are left out."""
    v = vertices.select("polygon", "ring", "seq", (to_units("lat", 6) * 2).alias("y1"), (to_units("lon", 6) * 2).alias("x1"))
    ring = Window.partitionBy("polygon", "ring").orderBy("seq")        # a ring's vertices
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = lambda c: F.coalesce(F.lead(c).over(ring), F.first(c).over(whole))
    e = v.select("polygon", "y1", "x1", after("y1").alias("y2"), after("x1").alias("x2"))
    return e.filter("y1 <> y2 OR x1 <> x2")


def _inside(tests: DataFrame, edges: DataFrame, keys: list[str], cell: int) -> DataFrame:
    """Keys and polygon of the tests (``_y``, ``_x``) that lie in a polygon or on its border."""
    banded = edges.withColumn("_band", F.explode(_bands(F.col("y1"), F.col("y2"), cell)))
    met = tests.withColumn("_band", F.floor(F.col("_y") / F.lit(2 * cell))).join(banded, "_band")
    dy, dx = F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")
    side = dx * (F.col("_y") - F.col("y1")) - dy * (F.col("_x") - F.col("x1"))
    within = (F.col("_y").between(F.least("y1", "y2"), F.greatest("y1", "y2"))
              & F.col("_x").between(F.least("x1", "x2"), F.greatest("x1", "x2")))
    # the ray to the east crosses an edge that spans the latitude half-open, where the edge lies to the east
    crosses = ((F.col("y1") > F.col("_y")) != (F.col("y2") > F.col("_y"))) & ((side > 0) == (dy > 0))
    found = met.groupBy(*keys, "polygon").agg(
        F.sum((crosses & (side != 0)).cast("int")).alias("_n"), F.max((within & (side == 0)).cast("int")).alias("_on"))
    return found.filter((F.col("_on") == 1) | (F.col("_n") % 2 == 1)).select(*keys, "polygon")


def points_in_polygons(points: DataFrame, vertices: DataFrame, cell: int = CELL) -> DataFrame:
    """Distinct points (lat, lon) with each polygon that they lie in; points on a border are inside.

    Points with a null coordinate lie in none.  Longitudes are not wrapped.
    """
    edges = polygon_edges(vertices)
    p = (points.select("lat", "lon").distinct().filter("lat IS NOT NULL AND lon IS NOT NULL")
         .withColumn("_y", to_units("lat", 6) * 2).withColumn("_x", to_units("lon", 6) * 2)
         .withColumn("_cy", F.floor(F.col("_y") / F.lit(2 * cell))).withColumn("_cx", F.floor(F.col("_x") / F.lit(2 * cell))))
    # cells that an edge's part in a band may touch: between its ends there, with a cell to spare for rounding
    e = edges.withColumn("_cy", F.explode(_bands(F.col("y1"), F.col("y2"), cell)))
    low, high = F.col("_cy") * 2 * cell, (F.col("_cy") + 1) * 2 * cell
    slope = (F.col("x2") - F.col("x1")).cast("double") / F.nullif((F.col("y2") - F.col("y1")).cast("double"), F.lit(0.0))
    at = lambda y: F.coalesce(F.col("x1") + slope * (F.greatest(F.least(y, F.greatest("y1", "y2")), F.least("y1", "y2"))
                                                     - F.col("y1")), F.col("x1").cast("double"))
    flat = F.col("y1") == F.col("y2")
    west = F.when(flat, F.least("x1", "x2").cast("double")).otherwise(F.least(at(low), at(high)))
    east = F.when(flat, F.greatest("x1", "x2").cast("double")).otherwise(F.greatest(at(low), at(high)))
    touched = (e.withColumn("_cx", F.explode(F.sequence(F.floor(west / F.lit(2.0 * cell)) - 1, F.floor(east / F.lit(2.0 * cell)) + 1)))
               .select("_cy", "_cx").distinct().withColumn("_edge", F.lit(True)))
    placed = p.join(touched, ["_cy", "_cx"], "left")
    border = placed.filter("_edge").select("lat", "lon", "_y", "_x")
    clear = placed.filter("_edge IS NULL").select("lat", "lon", "_cy", "_cx")
    centres = (clear.select("_cy", "_cx").distinct().withColumn("_y", (F.col("_cy") * 2 + 1) * cell)
               .withColumn("_x", (F.col("_cx") * 2 + 1) * cell))
    cells = _inside(centres, edges, ["_cy", "_cx"], cell)
    return (_inside(border, edges, ["lat", "lon"], cell)
            .unionByName(clear.join(cells, ["_cy", "_cx"]).select("lat", "lon", "polygon")))
