"""Overlap joins of day intervals by time bins.

Each interval is copied to the bins of ``width`` days that it touches; both sides meet by an
equi-join on (key, bin), and a pair that shares several bins is kept in the first of
them only, so nothing has to be made distinct.  Bins with more than ``hot`` left rows are cut into
pieces by a hash, and the right rows of just these bins are copied to the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 32          # days of a bin
HOT = 100_000       # left rows of one (key, bin) beyond which it is cut into pieces


def _binned(df: DataFrame, keys: list[str], span: tuple[str, str], side: str, width: int) -> DataFrame:
    start, end = (F.unix_date(c).cast("bigint") for c in span)
    first, last = (F.floor(d / F.lit(width)).cast("bigint") for d in (start, end))
    names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    whole = F.struct(*(F.col(c) for c in df.columns)).alias(f"_{side}")
    valid = df.filter((start <= end) & F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    return valid.select(*names, whole, start.alias(f"_{side}a"), end.alias(f"_{side}z"), first.alias(f"_{side}bin"),
                        F.explode(F.sequence(first, last)).alias("_bin"))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str],
                 width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """Pairs of rows of one key whose day intervals [start, end] share a day, as ``l`` and ``r`` structs.

    A point in time is an interval from a day to itself.  Rows with a null key or end, or that end before they
    start, pair with nothing.  Each pair is there once for each time its rows are there.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    a, b = _binned(left, keys, left_span, "l", width), _binned(right, keys, right_span, "r", width)
    crowded = (a.groupBy(*names, "_bin").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot)
               .withColumn("_pieces", F.ceil(F.col("_n") / F.lit(hot)).cast("int")).drop("_n"))
    pieces = F.coalesce("_pieces", F.lit(1))
    a = a.join(crowded, [*names, "_bin"], "left").withColumn("_piece", F.pmod(F.xxhash64("_l"), pieces).cast("int")).drop("_pieces")
    b = (b.join(crowded, [*names, "_bin"], "left")
         .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces"))
    met = a.join(b, [*names, "_bin", "_piece"])
    return (met.filter((F.col("_la") <= F.col("_rz")) & (F.col("_ra") <= F.col("_lz"))
                       & (F.col("_bin") == F.greatest("_lbin", "_rbin")))
            .select(F.col("_l").alias("l"), F.col("_r").alias("r")))


def readings_in_spells(readings: DataFrame, spells: DataFrame) -> DataFrame:
    """Each reading (lat, lon, fecha_local and its other columns) with the spell of its point that its day lies in."""
    pairs = overlap_join(readings, spells, ["lat", "lon"], ("fecha_local", "fecha_local"), ("inicio", "fin"))
    return pairs.select("l.*", "r.inicio", "r.fin", "r.dias")


def compound_spells(one: DataFrame, other: DataFrame) -> DataFrame:
    """Overlaps of two kinds of spells per point: both spells' ends and the days they share."""
    pairs = overlap_join(one, other, ["lat", "lon"], ("inicio", "fin"), ("inicio", "fin"))
    start, end = F.greatest("l.inicio", "r.inicio"), F.least("l.fin", "r.fin")
    return pairs.select("l.lat", "l.lon", F.col("l.inicio").alias("inicio_a"), F.col("l.fin").alias("fin_a"),
                        F.col("r.inicio").alias("inicio_b"), F.col("r.fin").alias("fin_b"),
                        start.alias("inicio"), end.alias("fin"), (F.datediff(end, start) + 1).cast("bigint").alias("dias"))
