"""Silver -> gold: comfort scoring and the three gold tables.

Plan notes (what keeps this cheap at 100 TB):

* Every aggregate is algebraic (count, integer sums, sum of squares), so Spark
  runs a partial aggregation before each shuffle and only one row per
  (task, group) crosses the network.  A group holding a third of the rows costs
  nothing extra.
* Score averages and standard deviations come from exact integer moments,
  which makes them bit-identical however the data is partitioned and lets
  per-(point, month) partials be re-aggregated exactly.
* ``gold_cube`` is the single scan behind the whole gold layer: ranking,
  regional seasonality and per-point seasonality are all re-aggregations of it.
* Points are grouped on silver's coordinates as they are: silver already
  rounds them to 6 decimals, and rounding again would change nothing.  Grouping
  on plain columns also lets a table bucketed by (lat, lon) skip the shuffle.
* The executive summary pairs each point with each month through an equi-join
  on the month (a 13-row fan-out on the point side and a broadcast of the
  seasonality table, whose size is bounded by the 12 months plus NULL); there
  is no cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cafetal import constants as K
from cafetal.functions import (comfort_day, comfort_score, composite_key, optimal_day, pct,
                               rnd, stddev_from_moments)


def bbox_filter(silver: DataFrame) -> DataFrame:
    """Rows inside the gold region (inclusive); pushed down to the scan."""
    return silver.filter(F.col("lat").between(K.LAT_MIN, K.LAT_MAX)
                         & F.col("lon").between(K.LON_MIN, K.LON_MAX))


def scored(silver: DataFrame) -> DataFrame:
    """Silver rows in the region with their daily score and day flags."""
    s = bbox_filter(silver).withColumn("score", comfort_score())
    return s.withColumns({"optimo": optimal_day(), "confort": comfort_day("score")})


def _moments(score: str = "score"):
    c = F.col(score)
    return [F.count(F.lit(1)).alias("n"),
            F.sum("optimo").cast("bigint").alias("n_opt"),
            F.sum("confort").cast("bigint").alias("n_confort"),
            F.sum(c).cast("bigint").alias("s1"),
            F.sum(c * c).cast("bigint").alias("s2")]


def gold_cube(silver: DataFrame) -> DataFrame:
    """Exact per (lat, lon, mes) moments of the daily score: the gold layer's only scan."""
    s = scored(silver)
    return s.groupBy("lat", "lon", "mes").agg(*_moments())


def _ranking_columns(df: DataFrame) -> DataFrame:
    return df.select(
        composite_key("lat", "lon").alias("pk_gold"), "lat", "lon",
        F.col("n").alias("dias_evaluados"),
        F.col("n_opt").alias("dias_optimos"),
        rnd(pct("n_opt", "n"), 2).alias("pct_optimos"),
        rnd(F.col("s1").cast("double") / F.col("n").cast("double"), 2).alias("score_final"))


def ranking(silver: DataFrame) -> DataFrame:
    """Per point: days, optimal days, % optimal and mean score (one shuffle)."""
    s = scored(silver)
    return _ranking_columns(s.groupBy("lat", "lon").agg(*_moments()))


def ranking_from_cube(cube: DataFrame) -> DataFrame:
    agg = cube.groupBy("lat", "lon").agg(*(F.sum(c).cast("bigint").alias(c)
                                           for c in ("n", "n_opt", "s1")))
    return _ranking_columns(agg)


def ranking_counts(silver: DataFrame) -> DataFrame:
    """The plan-display variant: days and optimal days per point only."""
    s = scored(silver)
    return (s.groupBy("lat", "lon")
             .agg(F.count(F.lit(1)).alias("dias_evaluados"),
                  F.sum("optimo").cast("bigint").alias("dias_optimos")))


def _seasonality_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("mes").alias("pk_estacional_mes"),
        rnd(F.col("s1").cast("double") / F.col("n").cast("double"), 2).alias("score_mensual_promedio"),
        rnd(stddev_from_moments("n", "s1", "s2"), 2).alias("variabilidad_score"),
        rnd(pct("n_confort", "n"), 2).alias("confort_pct"))


def seasonality(silver: DataFrame) -> DataFrame:
    """Per calendar month over the whole region: mean, sample stddev, % comfort days."""
    s = scored(silver)
    return _seasonality_columns(s.groupBy("mes").agg(*_moments()))


def seasonality_from_cube(cube: DataFrame) -> DataFrame:
    agg = cube.groupBy("mes").agg(*(F.sum(c).cast("bigint").alias(c)
                                    for c in ("n", "n_confort", "s1", "s2")))
    return _seasonality_columns(agg)


def point_seasonality_from_cube(cube: DataFrame) -> DataFrame:
    return cube.select("lat", "lon", "mes",
                       rnd(F.col("s1").cast("double") / F.col("n").cast("double"), 2).alias("score_mes"))


def point_seasonality(silver: DataFrame) -> DataFrame:
    """Per point and calendar month: mean score."""
    return point_seasonality_from_cube(gold_cube(silver))


def point_month_join(silver: DataFrame) -> DataFrame:
    """Each point's overall score next to each of its month scores (1:12).

    Equivalent to joining the ranking with per-point-month scores on (lat, lon);
    both sides are re-aggregations of one cube, so the join is evaluated as a
    window over each point's at most 13 month rows: one small shuffle instead
    of a second scan plus a sort-merge join.
    """
    cube = gold_cube(silver)
    w = Window.partitionBy("lat", "lon")
    n_all = F.sum("n").over(w)
    s_all = F.sum("s1").over(w)
    return cube.select(
        "lat", "lon",
        rnd(s_all.cast("double") / n_all.cast("double"), 2).alias("score_final"),
        n_all.cast("bigint").alias("dias_evaluados"),
        "mes",
        rnd(F.col("s1").cast("double") / F.col("n").cast("double"), 2).alias("score_mes"))


def top_point_months(silver: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` of the point-month join by score, month (lat, lon break ties)."""
    return (point_month_join(silver)
            .orderBy(F.col("score_final").desc(), "mes", "lat", "lon").limit(n))


def _months_and_null():
    return F.array(*[F.lit(m) for m in range(1, 13)], F.lit(None).cast("int"))


def executive_summary(ranking_df: DataFrame, seasonality_df: DataFrame) -> DataFrame:
    """Every point paired with every regional month profile, and its deviation."""
    r = ranking_df.select("lat", "lon", "score_final", "dias_evaluados", "dias_optimos",
                          "pct_optimos", F.explode(_months_and_null()).alias("_mes"))
    e = seasonality_df.select(F.col("pk_estacional_mes").alias("mes"), "score_mensual_promedio",
                              "variabilidad_score", F.col("confort_pct").alias("confort_pct_mes"))
    # seasonality is grouped by month(fecha): at most 13 rows, so broadcasting is bounded.
    j = r.join(F.broadcast(e), r["_mes"].eqNullSafe(e["mes"]), "inner")
    return j.select(
        composite_key("lat", "lon", "mes").alias("pk_resumen"),
        "lat", "lon", "score_final", "dias_evaluados", "dias_optimos", "pct_optimos",
        "mes", "score_mensual_promedio", "variabilidad_score", "confort_pct_mes",
        rnd(F.col("score_mensual_promedio") - F.col("score_final"), 2).alias("desviacion_estacional"))


def gold_tables(silver: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """Ranking, seasonality and summary from one scan of silver (via ``gold_cube``).

    The cube is small (points x 13 rows) and feeds every output; with
    ``materialize`` it is written once as a reliable checkpoint, so the
    outputs read it instead of each re-scanning silver (their pruned subplans
    differ, so Spark could not reuse the exchange on its own).
    """
    cube = gold_cube(silver)
    if materialize:
        from cafetal.session import checkpoint_root
        checkpoint_root(silver.sparkSession)
        cube = cube.checkpoint(eager=True)
    rk = ranking_from_cube(cube)
    es = seasonality_from_cube(cube)
    return {"cube": cube, "ranking": rk, "seasonality": es,
            "summary": executive_summary(rk, es)}


def with_audit(df: DataFrame) -> DataFrame:
    return df.withColumn("aggregated_at", F.current_timestamp())


def seasonality_sorted(seasonality_df: DataFrame) -> DataFrame:
    return seasonality_df.orderBy(F.col("confort_pct").desc(), "pk_estacional_mes")


def summary_sorted(summary_df: DataFrame) -> DataFrame:
    return summary_df.orderBy(F.col("score_final").desc(), "mes", "lat", "lon")


def top_points(ranking_df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best coordinates by mean score (lat, lon break ties)."""
    return ranking_df.orderBy(F.col("score_final").desc(), "lat", "lon").limit(n)
