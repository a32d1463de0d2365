"""Gold kept up to date by the published partitions that changed.

The state of gold is the exact moment cube (a row per point and calendar month) and, for each
published (anio, mes) partition, the moments that it put into the cube.  An update compares the
partitions' fingerprints with those of the last update, scans the changed ones only, and takes their old
moments out of the cube as it adds the new: integer moments are subtracted as exactly as they are added.

Each update writes a new numbered folder and its manifest last, so a reader (or an update that
starts after a crash) sees whole states only, and old folders stay as they were.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cafetal.operators import gold as G
from cafetal.sources import io

PART = ["anio", "mes"]
POINT_MONTH = ["lat", "lon", "mes"]
MOMENTS = ["n", "n_opt", "n_confort", "s1", "s2"]
MANIFEST_SCHEMA = "anio int, mes int, huella string, version int"


def fingerprints(silver: DataFrame) -> DataFrame:
    """Per (anio, mes) partition a fingerprint of its files (names, sizes, times); no column is read."""
    files = silver.select(*PART, F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"),
                          F.col("_metadata.file_modification_time").cast("string").alias("t")).distinct()
    one = F.xxhash64("p", "s", "t").cast("decimal(38,0)")
    return files.groupBy(*PART).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(one).cast("string")).alias("huella"))


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished states: those with a committed manifest."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [f.getPath().getName() for f in fs.listStatus(base)]
    return sorted(int(n[1:]) for n in names if fs.exists(path(f"{root}/manifest/{n}/_SUCCESS")))


def changed_partitions(before: DataFrame, now: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """(new or changed, gone) partitions; at most one per month of the calendar, so they may come to the driver."""
    old = before.select(*PART, F.col("huella").alias("_old"))
    diff = now.join(old, PART, "full_outer").filter(~F.col("huella").eqNullSafe(F.col("_old")))
    rows = diff.select(*PART, "huella").collect()
    return ([(r.anio, r.mes) for r in rows if r.huella is not None], [(r.anio, r.mes) for r in rows if r.huella is None])


def _is_one_of(parts: list[tuple]) -> Column:
    return reduce(lambda a, b: a | b, ((F.col("anio") == y) & (F.col("mes") == m) for y, m in parts), F.lit(False))


def _moments(silver: DataFrame) -> DataFrame:
    return G.scored(silver).groupBy("lat", "lon", *PART).agg(*G._moments())


def cube(spark: SparkSession, root: str) -> DataFrame:
    """The cube of the newest finished state."""
    return io.read_parquet(spark, f"{root}/cube/v{_versions(spark, root)[-1]}")


def update(spark: SparkSession, silver_path: str, root: str) -> dict:
    """Bring the state in ``root`` up to the published, (anio, mes)-partitioned silver table; say what was scanned.

    Partitions whose files are as they were are neither read nor regrouped.  Without an earlier
    state all of them are new; without any change the state stays as it is.
    """
    silver = io.read_parquet(spark, silver_path)
    now = fingerprints(silver)
    done = _versions(spark, root)
    last = done[-1] if done else 0
    manifest = (io.read_parquet(spark, f"{root}/manifest/v{last}") if done
                else spark.createDataFrame([], MANIFEST_SCHEMA))
    new, gone = changed_partitions(manifest, now)
    if done and not new and not gone:
        return {"version": last, "scanned": [], "removed": []}
    version = last + 1
    added = _moments(silver.filter(_is_one_of(new)))
    parts_path = io.write_parquet(added, f"{root}/moments/v{version}")
    added = io.read_parquet(spark, parts_path)
    # what the changed and gone partitions had put into the cube: their moments of the version that scanned them
    touched = manifest.filter(_is_one_of(new + gone))
    stale = [r.version for r in touched.select("version").distinct().collect()]
    pieces = [added]
    for v in stale:
        mine = touched.filter(F.col("version") == v).select(*PART)
        old = io.read_parquet(spark, f"{root}/moments/v{v}").join(F.broadcast(mine), PART)  # a row per month of the calendar
        pieces.append(old.select("lat", "lon", *PART, *((-F.col(c)).alias(c) for c in MOMENTS)))
    delta = reduce(DataFrame.unionByName, (p.select(*POINT_MONTH, *MOMENTS) for p in pieces))
    if done:
        delta = delta.unionByName(io.read_parquet(spark, f"{root}/cube/v{last}").select(*POINT_MONTH, *MOMENTS))
    summed = delta.groupBy(*POINT_MONTH).agg(*(F.sum(c).cast("bigint").alias(c) for c in MOMENTS)).filter("n > 0")
    io.write_parquet(summed, f"{root}/cube/v{version}")
    kept = manifest.join(now.select(*PART, F.col("huella").alias("_now")), PART).filter("huella = _now").drop("_now")
    fresh = now.filter(_is_one_of(new)).withColumn("version", F.lit(version))
    io.write_parquet(kept.unionByName(fresh.select(*kept.columns)), f"{root}/manifest/v{version}")
    return {"version": version, "scanned": sorted(new), "removed": sorted(gone)}
