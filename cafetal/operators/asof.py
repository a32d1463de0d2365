"""As-of join: each left row gets the latest right row of its key that is not later.

Both sides are merged into one table, sorted by ranges of (key, time), so a key that holds a
third of all rows is cut into as many ranges as its size asks for.  Inside a range the last right row
is carried forward; what a range needs from the ranges before it is one row per range and key,
joined back.  No task ever sees a whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cafetal.session import scratch_path
from cafetal.sources import io


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
              values: list[str]) -> DataFrame:
    """``left`` with ``right_time`` and ``values`` of the latest right row at or before ``left_time``.

    Every left row stays, once; without such a right row (or with a null key or time) the right columns are
    null.  Right rows without key or time are left out; of several at one key and time the one with the greatest
    values counts.  Both times must have one type.
    """
    spark = left.sparkSession
    names = [f"_k{i}" for i in range(len(keys))]
    kept = right.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, right_time)))
    kept = kept.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(right_time).alias("_t")).agg(
        F.max(F.struct(F.col(right_time).alias(right_time), *values)).alias("_r"))
    whole = F.struct(*(F.col(c) for c in left.columns))
    rows = left.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(left_time).alias("_t"), whole.alias("_l"))
    merged = (rows.withColumn("_r", F.lit(None).cast(kept.schema["_r"].dataType)).withColumn("_side", F.lit(1))
              # rows that agree in key and time may still lie in several ranges
              .withColumn("_tie", F.xxhash64("_l"))
              .unionByName(kept.withColumn("_l", F.lit(None).cast(rows.schema["_l"].dataType)).withColumn("_side", F.lit(0))
                           .withColumn("_tie", F.lit(0).cast("bigint"))))
    order = [*names, "_t", "_side", "_tie"]
    path = io.write_parquet(merged.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()),
                            scratch_path(spark, "asof"))
    merged = io.read_parquet(spark, path)
    inside = (Window.partitionBy("_pid", *names).orderBy("_t", "_side", "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = merged.withColumn("_here", F.last("_r", ignorenulls=True).over(inside))
    # the last right row of each range and key, then of the ranges before: at most a row per range for each key
    ends = merged.groupBy("_pid", *names).agg(F.max_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))).alias("_end"))
    before = Window.partitionBy(*names).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.filter(" AND ".join(f"{n} IS NOT NULL" for n in names))
               .withColumn("_before", F.last("_end", ignorenulls=True).over(before)).drop("_end"))
    out = merged.filter("_side = 1").join(carried, ["_pid", *names], "left")
    found = F.coalesce("_here", F.when(F.col("_t").isNotNull(), F.col("_before")))
    return out.select("_l.*", found.alias("_f")).select(*left.columns, *(F.col(f"_f.{c}").alias(c) for c in (right_time, *values)))
