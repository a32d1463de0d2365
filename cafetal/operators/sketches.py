"""Mergeable sketches per point and month, and what is answered from stored ones only.

KLL states answer quantiles within a rank error that their size ``k`` bounds, HLL states count distinct
values.  Both merge, so the region's, a year's or a point's answer comes from the stored states, never from
the days again, and a state is a few kilobytes however many days went into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400             # normalised rank error about 0.7 % (99 % sure)
RANK_ERROR = 0.02   # promised: nearly three times that
LG_K = 12           # relative error about 1.6 %
COUNT_ERROR = 0.08  # promised: five times that


def month_states(silver: DataFrame, measure: str = "temp_c") -> DataFrame:
    """Stored states per point and month: rows, a KLL state of the measure and an HLL state of its days."""
    return silver.filter(F.col(measure).isNotNull()).groupBy("lat", "lon", "anio", "mes").agg(
        F.count(F.lit(1)).alias("n"), F.call_function("kll_sketch_agg_double", F.col(measure), F.lit(K)).alias("kll"),
        F.hll_sketch_agg(F.date_format("fecha", "yyyy-MM-dd"), F.lit(LG_K)).alias("hll"))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """States merged upwards, to any subset of the stored keys."""
    return states.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"), F.call_function("kll_merge_agg_double", F.col("kll"), F.lit(K)).alias("kll"),
        F.hll_union_agg("hll").alias("hll"))


def quantiles(states: DataFrame, keys: list[str], ranks: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Rows, quantiles (``q10`` ...) and distinct days per key, from stored states only."""
    of = lambda r: F.call_function("kll_sketch_get_quantile_double", F.col("kll"), F.lit(float(r)))
    return merged(states, keys).select(*keys, "n", *(of(r).alias(f"q{round(100 * r)}") for r in ranks),
                                       F.hll_sketch_estimate("hll").alias("dias_distintos"))


def within_bounds(silver: DataFrame, states: DataFrame, ranks: tuple[float, ...] = (0.1, 0.5, 0.9),
                  measure: str = "temp_c") -> DataFrame:
    """Per calendar month of the region: whether the answers from states keep their promised errors, by an exact count."""
    q = quantiles(states, ["mes"], ranks)
    names = [f"q{round(100 * r)}" for r in ranks]
    days = silver.filter(F.col(measure).isNotNull()).join(q, "mes")      # a row per calendar month
    share = lambda op, c: F.sum(op(F.col(measure), F.col(c)).cast("bigint")) / F.count(F.lit(1))
    out = days.groupBy("mes").agg(
        F.count(F.lit(1)).alias("dias"), F.count_distinct("fecha").alias("_d"), F.first("dias_distintos").alias("_e"),
        *(x for c in names for x in (share(lambda a, b: a < b, c).alias(f"_{c}_below"), share(lambda a, b: a <= b, c).alias(f"_{c}_to"))))
    # the asked rank lies between the shares below and up to the answer, give or take the error
    kept = [(F.col(f"_{c}_below") <= r + RANK_ERROR) & (F.col(f"_{c}_to") >= r - RANK_ERROR) for c, r in zip(names, ranks, strict=True)]
    return out.select("mes", "dias", F.col("_d").alias("dias_distintos"), *(k.alias(f"{c}_cumple") for k, c in zip(kept, names, strict=True)),
                      (F.abs(F.col("_e") - F.col("_d")) <= COUNT_ERROR * F.col("_d")).alias("distintos_cumple"))
