"""Rolling sums over days, and sums on every level of region, point, year and month.

A rolling sum of a point needs no whole point in one task: days lie in blocks, each block also
gets the days just before it (its halo), and the window runs inside blocks, whose size the
calendar bounds.  Rain is summed in whole ten-thousandths of a millimetre, so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cafetal.functions import pct, rnd, to_units
from cafetal.operators.gold import scored

BLOCK = 64          # days of a block; at least the longest window


def rolling_rain(silver: DataFrame, windows: tuple[int, ...] = (7, 30), block: int = BLOCK) -> DataFrame:
    """Per point and day: rain of the last ``w`` calendar days, the day itself included, and the days with data among them.

    Several rows of a day are added up first; a null rain counts as a day with no rain known (sum null if all are).
    """
    if max(windows) > block:
        raise ValueError("a window may not be longer than a block")
    daily = (silver.filter("fecha IS NOT NULL").groupBy("lat", "lon", "fecha").agg(F.sum(to_units("rain_mm", 4)).alias("_mm"))
             .withColumn("_d", F.unix_date("fecha").cast("bigint")))
    own = F.floor(F.col("_d") / F.lit(block)).cast("bigint")
    halo = F.floor((F.col("_d") + max(windows) - 1) / F.lit(block)).cast("bigint")
    placed = daily.withColumn("_own", own).withColumn("_blk", F.explode(F.sequence(own, halo)))
    out = placed
    for w in windows:
        last = Window.partitionBy("lat", "lon", "_blk").orderBy("_d").rangeBetween(1 - w, 0)
        out = (out.withColumn(f"_s{w}", F.sum("_mm").over(last)).withColumn(f"dias_{w}d", F.count(F.lit(1)).over(last)))
    sums = [c for w in windows for c in ((F.col(f"_s{w}").cast("double") / F.lit(1e4)).alias(f"lluvia_{w}d"), F.col(f"dias_{w}d"))]
    return out.filter("_blk = _own").select("lat", "lon", "fecha", *sums)


def rollup_scores(silver: DataFrame) -> DataFrame:
    """Days, mean score and comfort days of the region, each point, its years and their months.

    ``nivel`` is the grouping id (7 region, 3 point, 1 year, 0 month); what a level adds up over has null
    coordinates, and 0 as its year or month.

    The days are grouped once, by point, year and month; the levels above come from those
    rows' exact moments, so it is not the days that are expanded four times.
    """
    cube = scored(silver).groupBy("lat", "lon", "anio", "mes").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").cast("bigint").alias("s1"), F.sum("confort").cast("bigint").alias("c"))
    point = F.struct("lat", "lon")
    rolled = (cube.withColumn("_p", point).rollup("_p", "anio", "mes")
              .agg(F.sum("n").cast("bigint").alias("dias"), F.sum("s1").cast("bigint").alias("_s"), F.sum("c").cast("bigint").alias("_c"),
                   F.grouping_id().cast("bigint").alias("nivel")))
    whole = lambda c: F.coalesce(c, F.lit(0)).alias(c)  # noqa: E731  0: all of them
    return rolled.select("nivel", "_p.lat", "_p.lon", whole("anio"), whole("mes"), "dias",
                         rnd(F.col("_s").cast("double") / F.col("dias").cast("double"), 2).alias("score_medio"),
                         rnd(pct("_c", "dias"), 2).alias("confort_pct"))
