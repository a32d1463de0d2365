"""The streaming amplitude equals the batch operator once the watermark has passed."""

from __future__ import annotations

from pyspark.sql import functions as F

from cafetal.operators.agro import thermal_amplitude
from cafetal.sources.fixture import hourly_readings
from cafetal.streaming.amplitude import EVENTS_SCHEMA, run_amplitude
from tests.conftest import SF_MID, rows


def test_streaming_amplitude_matches_batch(spark, scratch):
    src = scratch("events_src")
    events = spark.read.parquet(f"{SF_MID}/events.parquet")
    # deliver the readings as two files, oldest first
    cut = events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    events.filter(F.col("ts") < F.lit(cut)).write.parquet(f"{src}/part1")
    sink, ckpt = scratch("amp_sink"), scratch("amp_ckpt")
    run_amplitude(spark, f"{src}/*", sink, ckpt)
    events.filter(F.col("ts") >= F.lit(cut)).write.parquet(f"{src}/part2")
    run_amplitude(spark, f"{src}/*", sink, ckpt)
    # readings two days after the last one move the watermark past every real day;
    # state is evicted in the batch after the one that moved the watermark
    last = events.agg(F.max("ts")).first()[0]
    for i in (3, 4):
        spark.createDataFrame([(-i, last, 0, "tick", 0.0, None)], EVENTS_SCHEMA) \
            .withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {i - 1} DAYS")).write.parquet(f"{src}/part{i}")
        run_amplitude(spark, f"{src}/*", sink, ckpt)

    got = rows(spark.read.parquet(sink))
    want = rows(thermal_amplitude(hourly_readings(spark, SF_MID)))
    assert len(want) == 30
    assert sorted(set(want) - set(got)) == [] and got == want


def test_incremental_silver_equals_batch_silver(spark, scratch):
    from cafetal.operators.silver import SILVER_COLUMNS, to_silver
    from cafetal.sources.fixture import bronze_fixture
    from cafetal.streaming.silver_stream import run_silver_stream
    from tests.conftest import SF_SMALL

    src, sink, ckpt = scratch("bronze_src"), scratch("silver_sink"), scratch("silver_ckpt")
    b = bronze_fixture(spark, SF_SMALL)
    b.filter(F.year("fecha") < 1998).write.parquet(f"{src}/y1")         # first delivery
    run_silver_stream(spark, f"{src}/*", sink, ckpt)
    first = spark.read.parquet(sink).count()
    b.filter(F.year("fecha") >= 1998).write.parquet(f"{src}/y2")        # later years arrive
    run_silver_stream(spark, f"{src}/*", sink, ckpt)
    run_silver_stream(spark, f"{src}/*", sink, ckpt)                    # nothing new: no duplicates
    got = rows(spark.read.parquet(sink).select(*SILVER_COLUMNS))
    want = rows(to_silver(b))
    assert 0 < first < len(want)
    assert got == want
