"""Runs of days: spells that meet a condition, and gaps in the declared coverage.

The days of a point are bit masks of 32 days (``bit_or``, partially aggregated, so a
point that holds a third of the rows sends one mask per task and block).  A mask is the
summary of its block: runs that end inside it are closed there, a leading or trailing run may go
on in the next block.  Only the latter meet again: they are joined end to end per point, over
a number of rows that the calendar bounds, not the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POINT = ["lat", "lon"]
BLOCK = 32          # days of a mask; its bits and one more fit into a bigint


def day_masks(days: DataFrame, keys: list[str], day: str = "fecha") -> DataFrame:
    """Per key and block of days: which days are there (keys, ``_blk``, ``_days``)."""
    n = F.unix_date(day).cast("bigint")
    return (days.filter(F.col(day).isNotNull())
            .groupBy(*keys, F.floor(n / F.lit(BLOCK)).cast("bigint").alias("_blk"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(n, F.lit(BLOCK)).cast("int"))).alias("_days")))


def _bits(mask: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.call_function("getbit", mask, i) == 1)


def _block_runs(masks: DataFrame, keys: list[str]) -> DataFrame:
    """The runs inside each block, as first and last day number, and whether they touch its ends."""
    days = F.col("_days")
    starts = days.bitwiseAND(F.bitwise_not(F.shiftleft(days, 1)))
    ends = days.bitwiseAND(F.bitwise_not(F.shiftright(days, 1)))
    runs = F.explode(F.arrays_zip(_bits(starts).alias("a"), _bits(ends).alias("z")))
    return (masks.select(*keys, "_blk", runs.alias("_r"))
            .select(*keys, (F.col("_blk") * BLOCK + F.col("_r.a")).alias("_a"), (F.col("_blk") * BLOCK + F.col("_r.z")).alias("_z"),
                    ((F.col("_r.a") == 0) | (F.col("_r.z") == BLOCK - 1)).alias("_open")))


def _joined_ends(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs that touch a block's end, joined to those they go on in."""
    order = Window.partitionBy(*keys).orderBy("_a")
    new = F.coalesce(F.lag("_z").over(order) + 1 < F.col("_a"), F.lit(True))
    chained = runs.withColumn("_new", new.cast("bigint"))
    chained = chained.withColumn("_run", F.sum("_new").over(order))
    return chained.groupBy(*keys, "_run").agg(F.min("_a").alias("_a"), F.max("_z").alias("_z")).drop("_run")


def day_runs(days: DataFrame, keys: list[str], day: str = "fecha") -> DataFrame:
    """Maximal runs of consecutive days per key: keys, ``_a`` and ``_z`` (day numbers, inclusive)."""
    runs = _block_runs(day_masks(days, keys, day), keys)
    closed = runs.filter(~F.col("_open")).drop("_open")
    return closed.unionByName(_joined_ends(runs.filter("_open").drop("_open"), keys))


def _dated(runs: DataFrame, keys: list[str]) -> DataFrame:
    date = lambda c: F.date_from_unix_date(F.col(c).cast("int"))
    return runs.select(*keys, date("_a").alias("inicio"), date("_z").alias("fin"), (F.col("_z") - F.col("_a") + 1).alias("dias"))


def spells(silver: DataFrame, condition: Column, min_days: int = 1, keys: list[str] | None = None) -> DataFrame:
    """Runs of at least ``min_days`` consecutive days that meet ``condition``: keys, ``inicio``, ``fin``, ``dias``.

    A day without a row, or whose condition is null, ends a run.  Several rows of one day count once
    (the day meets the condition if one of them does); rows without a date are left out.
    """
    keys = keys or POINT
    return _dated(day_runs(silver.filter(condition), keys), keys).filter(F.col("dias") >= min_days)


def dry_spells(silver: DataFrame, rain_below: float, min_days: int = 1) -> DataFrame:
    """Consecutive days with less rain than ``rain_below`` millimetres, per point."""
    return spells(silver, F.col("rain_mm") < F.lit(rain_below), min_days)


def coverage_gaps(silver: DataFrame, start: str, end: str) -> DataFrame:
    """Stretches of absent days of each point inside the declared coverage [start, end], as intervals.

    They are what lies between the point's runs of present days, with the days before ``start`` and after
    ``end`` as outer runs, so a point without any day inside has one gap, the whole coverage.  One row per gap,
    however many days it has.
    """
    first, last = (F.unix_date(F.lit(d).cast("date")).cast("bigint") for d in (start, end))
    inside = silver.filter(F.col("fecha").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    present = day_runs(inside.select(*POINT, "fecha"), POINT)
    points = silver.select(*POINT).distinct()
    outer = points.select(*POINT, F.explode(F.array(
        F.struct((first - 1).alias("_a"), (first - 1).alias("_z")), F.struct((last + 1).alias("_a"), (last + 1).alias("_z")))).alias("_o"))
    runs = present.unionByName(outer.select(*POINT, "_o.*"))
    after = F.lead("_a").over(Window.partitionBy(*POINT).orderBy("_a", "_z"))
    gaps = runs.select(*POINT, (F.col("_z") + 1).alias("_a"), (after - 1).alias("_z"))
    return _dated(gaps.filter("_z >= _a"), POINT)
