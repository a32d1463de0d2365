"""Difference of two versions of a partitioned table, as multisets.

Partitions are compared by a fingerprint of their rows (count and sums of two hashes, which do not depend
on order), and only those that differ are read again and compared row by row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_fingerprints(df: DataFrame, parts: list[str]) -> DataFrame:
    """Per partition: rows, and the sums of two 64-bit hashes of each row."""
    row = [F.col(c) for c in sorted(df.columns)]
    total = lambda seed: F.sum(F.xxhash64(*row, F.lit(seed)).cast("decimal(38,0)"))
    return df.groupBy(*parts).agg(F.struct(F.count(F.lit(1)), total(1), total(2)).alias("_print"))


def table_diff(before: DataFrame, after: DataFrame, key: list[str], parts: list[str]) -> DataFrame:
    """Rows that only one version has, and how often: ``cambio``, the table's columns, ``veces``.

    ``cambio`` is ``alta`` (in ``after`` only), ``baja`` (in ``before`` only), or ``cambio_alta`` and
    ``cambio_baja`` where the key stands on both sides of the difference.  Rows are equal if all columns are, nulls being
    equal to nulls; the versions have the same columns.  What comes to the driver are the differing partitions' names.
    """
    columns = before.columns
    a = partition_fingerprints(before, parts).withColumnRenamed("_print", "_a")
    b = partition_fingerprints(after.select(*columns), parts).withColumnRenamed("_print", "_b")
    same = reduce(lambda x, y: x & y, (a[p].eqNullSafe(b[p]) for p in parts))
    unequal = a.join(b, same, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(
        *(F.coalesce(a[p], b[p]).alias(p) for p in parts)).collect()
    chosen = reduce(lambda x, y: x | y, (reduce(lambda x, y: x & y, (F.col(p).eqNullSafe(F.lit(r[p])) for p in parts))
                                         for r in unequal), F.lit(False))
    signed = (before.filter(chosen).withColumn("_n", F.lit(-1).cast("bigint"))
              .unionByName(after.select(*columns).filter(chosen).withColumn("_n", F.lit(1).cast("bigint"))))
    left = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    keys = left.groupBy(*(F.col(k).alias(f"_k_{k}") for k in key)).agg(
        (F.min("_n") < 0).alias("_gone"), (F.max("_n") > 0).alias("_new"))
    met = left.join(keys, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key)))
    kind = F.when(F.col("_n") > 0, "alta").otherwise("baja")
    return met.select(F.when(F.col("_gone") & F.col("_new"), F.concat(F.lit("cambio_"), kind)).otherwise(kind).alias("cambio"),
                      *columns, F.abs("_n").alias("veces"))
