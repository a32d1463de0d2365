"""Diurnal thermal amplitude as a Structured Streaming query.

Hourly readings arrive as files.  Each reading is moved to local time, only
the 00h and 12h readings are kept, and per point and local day the query
collects max, min and the presence of both hours.  A watermark on the local
day bounds the state: a day is emitted (append mode) once the watermark has
passed it, and its state is dropped.  The file sink plus the checkpoint give
exactly-once output across restarts and lost executors.

The batch operator ``cafetal.operators.agro.thermal_amplitude`` computes the
same rows from a static table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cafetal.operators.agro import local_time

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def amplitude_stream(readings: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Streaming rows (punto, fecha_local, t_max, t_min, lecturas, amplitud).

    The event time is the start of the local day of each reading.  Grouping on
    that watermarked column (with the point) lets append mode emit a day once
    the watermark, the latest day seen minus ``lateness``, has passed it.  The
    local date comes from the time-zone-free local wall clock, so results do
    not depend on the session time zone.
    """
    # Every reading must reach the watermark so event time advances with the
    # stream; a plain filter on the hour would be pushed below the watermark by
    # the optimizer.  So the hour selection happens inside the aggregates.
    r = (local_time(readings)
         .withColumn("dia_local", F.to_date("hora_local").cast("timestamp"))
         .withWatermark("dia_local", lateness))
    h = F.hour("hora_local")
    kept = h.isin(0, 12)
    agg = r.groupBy("punto", "dia_local").agg(
        F.max(F.when(kept, F.col("lectura"))).alias("t_max"),
        F.min(F.when(kept, F.col("lectura"))).alias("t_min"),
        F.count(F.when(kept, F.lit(1))).alias("lecturas"),
        F.max(F.when(h == 0, 1).otherwise(0)).alias("_h0"),
        F.max(F.when(h == 12, 1).otherwise(0)).alias("_h12"))
    return (agg.filter((F.col("_h0") == 1) & (F.col("_h12") == 1))
               .select("punto", F.to_date("dia_local").alias("fecha_local"),
                       "t_max", "t_min", "lecturas",
                       (F.col("t_max") - F.col("t_min")).alias("amplitud")))


def readings_from_events(spark: SparkSession, source: str) -> DataFrame:
    """Streaming hourly readings from event files (point = user_id)."""
    ev = spark.readStream.schema(EVENTS_SCHEMA).parquet(source)
    return ev.select(F.col("user_id").alias("punto"), F.col("ts").alias("ts_utc"),
                     F.col("value").alias("lectura"))


def run_amplitude(spark: SparkSession, source: str, sink: str, checkpoint: str,
                  lateness: str = "1 day") -> StreamingQuery:
    """Process every file currently in ``source`` and stop (availableNow trigger).

    Re-running with the same checkpoint processes only files that arrived since.
    """
    q = (amplitude_stream(readings_from_events(spark, source), lateness)
         .writeStream.format("parquet").outputMode("append")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
