"""Stream-stream join: readings that follow an alarm of their station within some hours.

Both streams have a watermark of their own, and the condition bounds how far apart in time two rows may be, so
the join drops each side's state as soon as no later row of the other can meet it.  The checkpoint holds state and
progress: after a restart only new files are read, and the file sink keeps each match once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cafetal.streaming.amplitude import EVENTS_SCHEMA


def alarm_join(alarms: DataFrame, readings: DataFrame, within: str = "6 hours", lateness: str = "2 hours") -> DataFrame:
    """(punto, alarma, t_alarma, lectura, t_lectura): readings from the alarm's moment to ``within`` after it, inclusive.

    Both inputs have event_id, punto and a timestamp ``t``; they may be streams or tables.
    """
    a = alarms.select(F.col("event_id").alias("alarma"), "punto", F.col("t").alias("t_alarma")).withWatermark("t_alarma", lateness)
    r = readings.select(F.col("event_id").alias("lectura"), F.col("punto").alias("_p"), F.col("t").alias("t_lectura")).withWatermark(
        "t_lectura", lateness)
    near = ((F.col("punto") == F.col("_p")) & (F.col("t_lectura") >= F.col("t_alarma"))
            & (F.col("t_lectura") <= F.col("t_alarma") + F.expr(f"INTERVAL {within}")))
    return a.join(r, near).select("punto", "alarma", "t_alarma", "lectura", "t_lectura")


def alarms_and_readings(events: DataFrame, alarm: str = "error", reading: str = "view") -> tuple[DataFrame, DataFrame]:
    rows = events.select("event_id", F.col("user_id").alias("punto"), F.col("ts").cast("timestamp").alias("t"), "event_type")
    return rows.filter(F.col("event_type") == alarm), rows.filter(F.col("event_type") == reading)


def run_alarm_join(spark: SparkSession, source: str, sink: str, checkpoint: str, **parameters) -> StreamingQuery:
    """Join every event file now in ``source`` and stop; run it again with the same checkpoint when more have arrived."""
    events = lambda: spark.readStream.schema(EVENTS_SCHEMA).parquet(source)
    alarms, _ = alarms_and_readings(events())
    _, readings = alarms_and_readings(events())
    q = (alarm_join(alarms, readings, **parameters).writeStream.format("parquet").outputMode("append")
         .option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
