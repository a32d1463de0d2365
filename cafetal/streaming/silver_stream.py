"""Incremental bronze -> silver as a Structured Streaming query.

New bronze files (for example a newly consolidated year) are picked up by the
file source, converted with the same silver operator as the batch layer and
appended to the partitioned silver table.  The transformation is row-wise, so
the query keeps no state; the checkpoint records which files were processed,
which makes a re-run after a failure or a lost executor exactly-once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from cafetal.operators.silver import to_silver

BRONZE_SCHEMA = ("fecha date, longitud double, latitud double, temp_k double, dew_k double, "
                 "lluvia_m double, rad_j_m2 double, evap_pot_m double")


def run_silver_stream(spark: SparkSession, bronze_source: str, silver_sink: str, checkpoint: str,
                      schema: str = BRONZE_SCHEMA) -> StreamingQuery:
    """Process every bronze file now in ``bronze_source`` and stop (availableNow)."""
    bronze = spark.readStream.schema(schema).parquet(bronze_source)
    q = (to_silver(bronze)
         .writeStream.format("parquet").outputMode("append")
         .partitionBy("anio", "mes")
         .option("path", silver_sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
