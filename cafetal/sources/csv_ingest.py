"""Yearly grid CSVs -> typed bronze.

Spark's CSV reader maps columns by position, so files whose headers differ in
order or content cannot be read with one multi-path read.  One job finds every
file's header line; the files are grouped by header, every group is read with
ONE multi-path scan under its own all-string schema, and the groups are aligned
with ``unionByName(allowMissingColumns=True)``.  The number of scans is the
number of distinct headers, not of files.  The reader checks each file's header
against its group's and fails on lines with too few or too many fields.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cafetal.constants import SOURCE_COLUMNS, YEARLY_FILE_PREFIX


def list_files(spark: SparkSession, root: str, prefix: str = YEARLY_FILE_PREFIX, suffix: str = "*.csv") -> list[str]:
    """Paths of the yearly files under ``root``: the file or a folder below the root has the prefix."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", suffix).load(root).select("path"))
    yearly = F.exists(F.split(F.element_at(F.split("path", F.lit(_literal(root.rstrip("/"))), 2), -1), "/"),
                      lambda part: part.startswith(prefix))
    return sorted(r.path for r in df.filter(yearly).collect())


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def read_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header: the first line of each, found by one job over all files."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("f"),
                                          F.col("_metadata.file_block_start").alias("start"),
                                          F.monotonically_increasing_id().alias("line"))  # rises within a block
    found = lines.filter("start = 0").groupBy("f").agg(F.min_by("value", "line").alias("h")).collect()
    if len(found) < len(paths):
        raise ValueError(f"{len(paths) - len(found)} of {len(paths)} CSV files have no header line")
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in found:  # a line per file
        groups.setdefault(tuple(next(csv.reader([r.h.lstrip("\ufeff")]))), []).append(r.f)
    return groups


def csv_union_by_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files as string columns, aligned by header name; missing columns are NULL."""
    if not paths:
        raise ValueError("no CSV files to read")
    frames = []
    for header, files in sorted(read_headers(spark, paths).items()):
        schema = StructType([StructField(c, StringType(), True) for c in header])
        frames.append(spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
                      .schema(schema).csv(sorted(files)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bronze_typed(raw: DataFrame) -> DataFrame:
    """Rename the source fields to bronze names and cast; a bad value raises (ANSI).

    A field that no file has raises ``ValueError``.
    """
    absent = [c for c in SOURCE_COLUMNS if c not in raw.columns]
    if absent:
        raise ValueError(f"no file has the columns {absent}")
    return raw.select(*(F.col(src).cast("date" if dst == "fecha" else "double").alias(dst)
                        for src, dst in SOURCE_COLUMNS.items()))


def to_source_layout(bronze: DataFrame) -> DataFrame:
    """Bronze back in the source layout (source names, text values) for export."""
    inverse = {v: k for k, v in SOURCE_COLUMNS.items()}
    return bronze.select(*(F.col(b).cast("string").alias(inverse[b]) for b in inverse if b in bronze.columns))


def write_yearly_csvs(bronze: DataFrame, root: str, reorder_year: int | None = None,
                      drop_evap_year: int | None = None) -> list[str]:
    """One CSV folder per year under source names (``<YEARLY_FILE_PREFIX><year>``).

    ``reorder_year`` is written with its columns in reverse order and
    ``drop_evap_year`` without ``potential_evaporation_sum``, the two header
    variations the reader must align.
    """
    src = to_source_layout(bronze).withColumn("_anio", F.year(F.col("date").cast("date")))
    cols = [c for c in src.columns if c != "_anio"]
    special = [y for y in (reorder_year, drop_evap_year) if y is not None]
    # rows without a date are regular, too
    regular = src.filter(~F.coalesce(F.col("_anio").isin(*special), F.lit(False))) if special else src
    (regular.write.mode("overwrite").option("header", True)
            .partitionBy("_anio").csv(f"{root}/{YEARLY_FILE_PREFIX}years"))
    if reorder_year is not None:
        (src.filter(F.col("_anio") == reorder_year).select(*reversed(cols))
            .write.mode("overwrite").option("header", True).csv(f"{root}/{YEARLY_FILE_PREFIX}{reorder_year}"))
    if drop_evap_year is not None:
        (src.filter(F.col("_anio") == drop_evap_year)
            .select(*[c for c in cols if c != "potential_evaporation_sum"])
            .write.mode("overwrite").option("header", True).csv(f"{root}/{YEARLY_FILE_PREFIX}{drop_evap_year}"))
    return list_files(bronze.sparkSession, root)
