"""Parquet and CSV sinks and scans.

Writes go through the DataFrame writer, so every task is retried on its own if
an executor is lost and the output is committed only when the job succeeds.
Nothing is coalesced to one file: a CSV export is a folder of ordered parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  cluster_by: tuple[str, ...] = ()) -> str:
    """Parquet with ZSTD compression; ``cluster_by`` sorts each task's rows (no shuffle)."""
    out = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: list[str], dynamic: bool = True,
                      cluster_by: tuple[str, ...] = ()) -> str:
    """Hive-partitioned Parquet.  ``dynamic`` replaces only the partitions present
    in ``df`` and keeps the others, like an overwrite-or-ignore copy.

    No shuffle on the partition columns (a hot month would land in one task):
    each task sorts its rows by the partition columns and writes one file per
    value it holds.  Date-clustered input (bronze is written sorted by date)
    keeps that to one or two files per task.  ``cluster_by`` adds sort columns
    inside each file (e.g. the grid point), which improves compression and lets
    Parquet row-group statistics skip data for filters on those columns.
    """
    # a per-write option, so concurrent writes never race on the session setting
    (df.sortWithinPartitions(*by, *cluster_by).write.mode("overwrite").option("compression", "zstd")
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .partitionBy(*by).parquet(path))
    return path


def write_if_absent(df: DataFrame, path: str) -> str:
    """Write only when nothing exists at ``path`` (an existing table is kept)."""
    df.write.mode("ignore").option("compression", "zstd").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def export_csv(df: DataFrame, path: str, order: list, mode: str = "overwrite") -> str:
    """Sorted CSV with a header; parts are range-partitioned, so reading the part
    files in name order yields the global order."""
    df.orderBy(*order).write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
