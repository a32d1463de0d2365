"""Map feed of the ranking: centre, global rank number and the elite flag.

``global_row_number`` numbers rows in a total order without funnelling them
through one task: the data is range-partitioned and sorted, each row gets its
position inside its partition, and per-partition counts (one row per
partition, so bounded) are turned into offsets that are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cafetal.functions import rnd, to_units
from cafetal.session import checkpoint_root


def global_row_number(df: DataFrame, order: list[Column], name: str = "puesto") -> DataFrame:
    """1-based position of each row in ``order`` (a total order), distributed."""
    checkpoint_root(df.sparkSession)
    ordered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    # Freeze partition membership and positions: a recomputation after an executor
    # loss must see the same ids, so cut the lineage with a reliable checkpoint.
    ordered = ordered.checkpoint(eager=True)
    ordered = ordered.withColumn("_pid", F.shiftright("_mid", 33))
    ordered = ordered.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # one row per partition of the range exchange: bounded by the partition count
    out = ordered.join(F.broadcast(offsets), "_pid")
    return (out.withColumn(name, (F.col("_off") + F.col("_local") + F.lit(1)).cast("bigint"))
               .drop("_mid", "_pid", "_local", "_off"))


def map_center(ranking_df: DataFrame) -> DataFrame:
    """Mean latitude and longitude of the ranked points (exact micro-degree sums)."""
    agg = ranking_df.agg(F.count(F.lit(1)).alias("n"),
                         F.sum(to_units("lat", 6)).alias("_slat"),
                         F.sum(to_units("lon", 6)).alias("_slon"))
    n = F.col("n").cast("double")
    return agg.select(
        F.col("n").alias("puntos"),
        rnd(F.col("_slat").cast("double") / n / F.lit(1e6), 6).alias("lat_centro"),
        rnd(F.col("_slon").cast("double") / n / F.lit(1e6), 6).alias("lon_centro"))


def map_feed(ranking_df: DataFrame, elite: int = 5) -> DataFrame:
    """Rank number by score (lat, lon break ties), elite flag, 4-decimal coordinates."""
    order = [F.col("score_final").desc(), F.col("lat").asc(), F.col("lon").asc()]
    ranked = global_row_number(
        ranking_df.select("lat", "lon", "score_final", "dias_optimos"), order)
    return ranked.select(
        "puesto", (F.col("puesto") <= F.lit(elite)).alias("elite"),
        rnd("lat", 4).alias("lat_4"), rnd("lon", 4).alias("lon_4"),
        "score_final", "dias_optimos")
