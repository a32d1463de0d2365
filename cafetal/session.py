"""SparkSession construction and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(a shared filesystem such as HDFS or an object store).  A private temporary
folder is only created when that setting is unset, which is the local test and
bench case.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


# Defaults of this library; what the cluster or the caller has set stays.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Settings of a run on one machine (tests, bench, scripts); never applied to a cluster.
LOCAL = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def build_session(app_name: str = "cafetal", **settings: str) -> SparkSession:
    """A session with the submitted settings; reuses an active one.

    Master, parallelism and memory are the cluster's: they are taken as submitted
    unless passed here (``settings``: names with ``__`` for dots).  Library defaults
    only fill what is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    set_before = spark.sparkContext.getConf()
    for name, value in DEFAULTS.items():
        if not set_before.contains(name):
            spark.conf.set(name, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_session(app_name: str = "cafetal") -> SparkSession:
    """A session on this machine for bench and scripts: ``BENCH_CPUS`` threads and as many partitions."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    return build_session(app_name, spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                         spark__driver__memory=os.environ.get("CAFETAL_DRIVER_MEMORY", "16g"),
                         **{k.replace(".", "__"): v for k, v in LOCAL.items()})


def _machine_local(path: str) -> bool:
    return path.startswith("file:") or "://" not in path


_SHARED: set[tuple[str, str]] = set()    # (application, folder) that the executors were seen to share


def _check_shared(spark: SparkSession, folder: str) -> None:
    """Raise ``RuntimeError`` unless what the executors write to ``folder`` is found by the driver and by other tasks."""
    sc = spark.sparkContext

    def slowly(i):
        time.sleep(0.1)     # so that no executor takes all tasks
        return i

    try:
        if (sc.applicationId, folder) in _SHARED:
            return
        n, probe = 2 * max(1, sc.defaultParallelism), f"{folder.rstrip('/')}/cafetal/probe-{uuid.uuid4().hex[:12]}"
        sc.parallelize(range(n), n).map(slowly).saveAsTextFile(probe)
        found = sc.textFile(probe).count()
    except Exception as e:
        raise RuntimeError(f"spark.checkpoint.dir is {folder!r}, a local path, and trying it failed: name a shared folder, or set "
                           "spark.cafetal.checkpoint.mounted=true if every machine mounts it") from e
    if found != n:
        raise RuntimeError(f"spark.checkpoint.dir is {folder!r}, a local path that the machines do not share ({found} of {n} "
                           "rows came back): name a shared folder")
    _SHARED.add((sc.applicationId, folder))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    A path without a remote scheme may be mounted on every machine: outside local mode it is
    tried once per application, and refused if files do not come back; with
    ``spark.cafetal.checkpoint.mounted=true`` it is taken as it is.

    Only in local mode, and only when the setting is unset (tests, bench), a
    private temporary folder is created and set.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.master.startswith("local") and _machine_local(configured) and sc.getConf().get(
                "spark.cafetal.checkpoint.mounted", "false") != "true":
            _check_shared(spark, configured)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() carries a per-application subfolder; its parent is the root.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        # a machine-local folder is not shared by executors: refuse rather than guess
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                           "for checkpoints and scratch tables")
    local = tempfile.mkdtemp(prefix="cafetal-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/cafetal/{name}-{uuid.uuid4().hex[:12]}"
