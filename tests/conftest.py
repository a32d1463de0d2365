from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="cafetal-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .appName("cafetal-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from cafetal.session import scratch_path
    return lambda name: scratch_path(spark, name)


def rows(df, order=None):
    """Collected rows as sorted tuples (test helper for small results)."""
    out = [tuple(r) for r in df.collect()]
    return out if order == "keep" else sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
