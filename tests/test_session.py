from __future__ import annotations

import datetime
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cafetal import session
from tests.conftest import ROOT

PROGRAM = """
from pyspark.sql import SparkSession
from cafetal.session import build_session
SparkSession.builder.master("local[3]").config("spark.sql.shuffle.partitions", "77").config(
    "spark.ui.enabled", "false").config("spark.sql.session.timeZone", "Asia/Tokyo").getOrCreate()
s = build_session()
print(s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"), s.conf.get("spark.sql.session.timeZone"),
      s.conf.get("spark.sql.parquet.compression.codec"))
"""


def test_given_settings_stay():
    got = subprocess.run([sys.executable, "-c", PROGRAM], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert got.stdout.split() == ["local[3]", "77", "Asia/Tokyo", "zstd"], got.stderr[-500:]


class FakeSession:
    def __init__(self, master, conf):
        self.sparkContext = self
        self.master, self.conf = master, conf

    def getConf(self):
        return self

    def get(self, name, default=None):
        return self.conf.get(name, default)

    def getCheckpointDir(self):
        return "set"


@pytest.mark.parametrize("path", ["file:/tmp/x", "/data/x"])
def test_local_checkpoint_path_is_refused_on_a_cluster(path):
    conf = {"spark.checkpoint.dir": path}
    with pytest.raises(RuntimeError):
        session.checkpoint_root(FakeSession("spark://host:7077", conf))
    assert session.checkpoint_root(FakeSession("local[4]", conf)) == path
    assert session.checkpoint_root(FakeSession("yarn", conf | {"spark.cafetal.checkpoint.mounted": "true"})) == path
    assert session.checkpoint_root(FakeSession("yarn", {"spark.checkpoint.dir": "hdfs://n/x"})) == "hdfs://n/x"


CLUSTER = """
import importlib.util, os, sys
from pathlib import Path
home = Path(sys.argv[1], "home")            # executors work in Spark's home, in a folder of their own
(home / "work").mkdir(parents=True)
for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():
    if p.name != "work":
        (home / p.name).symlink_to(p)
os.environ |= {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable,
               "PYTHONPATH": sys.argv[4], "SPARK_LOCAL_IP": "127.0.0.1"}
sys.path.insert(0, sys.argv[4])
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config(map={
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.executor.memory": "600m", "spark.local.dir": sys.argv[1],
    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": sys.argv[2]}).getOrCreate()
spark.sparkContext.master = "spark://host:7077"         # as the library sees it
try:
    print("ROWS", E.queries()["bbox_filter"](spark, sys.argv[3]).count(), flush=True)
except RuntimeError as e:
    print("REFUSED", e, flush=True)
spark.stop()
"""


@pytest.mark.parametrize("folder, said", [("file://{}/shared", "ROWS"), ("{}/shared", "ROWS"), ("/proc/self/cwd/apart", "REFUSED")])
def test_checkpoint_path_on_a_cluster_is_tried(tmp_path, folder, said):
    """A folder that every machine mounts is used; one that each process has for itself is refused."""
    tables = tmp_path / "tables"
    tables.mkdir()
    lineitem = {"l_suppkey": [1, 2, 3], "l_linenumber": [1, 2, 3], "l_quantity": [10.0, 20.0, 30.0], "l_extendedprice": [9.0, 8.0, 7.0],
                "l_discount": [0.01, 0.02, 0.03], "l_tax": [0.04, 0.05, 0.06], "l_shipdate": [datetime.datetime(1998, 3, 1)] * 3}
    pq.write_table(pa.table(lineitem).set_column(6, "l_shipdate", pa.array(lineitem["l_shipdate"], pa.timestamp("us"))),
                   tables / "lineitem.parquet")
    got = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path), folder.format(tmp_path), str(tables), ROOT],
                         capture_output=True, text=True, cwd=tmp_path, timeout=240)
    assert said in got.stdout, got.stdout[-500:] + got.stderr[-1500:]


# F2 to F23, as the findings name them
FOUND = """bbox_filter bronze_sorted check_no_nulls bronze_typed check_pk_unique check_row_consistency check_ranges comfort_day
check_row_counts composite_key comfort_score compound_spells contract_documented contract_ranking contract_seasonality contract_bronze
contract_silver coverage_gaps coords_in_country csv_union_by_name csv_export date_gaps""".split()
EACH = CLUSTER.replace("[2,1,1024]", "[2,2,1024]").replace('print("ROWS", E.queries()["bbox_filter"](spark, sys.argv[3]).count(), flush=True)', """
    for name in sys.argv[5:]:
        print("ROWS", name, E.queries()[name](spark, sys.argv[3]).count(), flush=True)""")


def test_each_query_returns_its_rows_on_a_cluster(spark, tmp_path):
    """With a mounted folder and files in several parts, each query returns as many rows as in local mode."""
    import __spark_entry__ as E
    tables = tmp_path / "tables"
    for part, year in enumerate((1996, 1998, 2001)):
        days = [datetime.datetime(year, m, d) for m in (3, 8) for d in range(1, 7)]
        key = [s + 30 * part for s in range(1, 31)]
        columns = [(s, 1 + (s + i) % 7, float(1 + (7 * s + 11 * i) % 50), 900.0 * (1 + (s + i) % 60), (s + i) % 11 / 100, (s * i) % 9 / 100, day)
                   for s in key for i, day in enumerate(days)]
        names = ["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
        lineitem = pa.table(dict(zip(names, map(list, zip(*columns)))))
        (tables / "lineitem.parquet").mkdir(parents=True, exist_ok=True)
        pq.write_table(lineitem.set_column(6, "l_shipdate", lineitem["l_shipdate"].cast(pa.timestamp("us"))),
                       tables / "lineitem.parquet" / f"part-{part}.parquet")
    want = [f"ROWS {name} {E.queries()[name](spark, str(tables)).count()}" for name in FOUND]
    got = subprocess.run([sys.executable, "-c", EACH, str(tmp_path), f"{tmp_path}/shared", str(tables), ROOT, *FOUND],
                         capture_output=True, text=True, cwd=tmp_path, timeout=400)
    assert [x for x in got.stdout.splitlines() if x.startswith(("ROWS", "REFUSED"))] == want, got.stderr[-1500:]
    assert not any(x.endswith(" 0") for x in want if not x.startswith(("ROWS contract", "ROWS check")))
