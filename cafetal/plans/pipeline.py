"""Layer orchestration: bronze -> silver -> gold with gates before publishing.

Publishing without transactions: every run writes its tables under
``<root>/runs/<run_id>/``, reads them back, validates them there, and only
then adds one small immutable entry under ``<root>/versions/`` with the
locations of its own tables.  Readers take each table's newest entry, so two
runs at once lose nothing of each other, a crash before the entry leaves the
old tables current, and an entry that can't be read is an error.  Each written
table also cuts the lineage, so a lost executor only recomputes from the last
written layer.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cafetal import constants as K
from cafetal.operators import gold as G
from cafetal.operators import mapdata as M
from cafetal.operators import quality as Q
from cafetal.operators import silver as S
from cafetal.sources import io

LAYERS = ("bronze", "silver", "gold")
SILVER_CLUSTER = ("lat", "lon", "fecha")


class GateError(RuntimeError):
    """A quality gate failed; nothing was published."""


@dataclass
class RunResult:
    run_id: str
    root: str
    tables: dict[str, str]


def _entries(spark: SparkSession, root: str) -> DataFrame | None:
    """All published entries; None if there are none, which is looked up before anything is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder) or not fs.listStatus(folder):
        return None
    return (spark.read.schema("orden bigint, corrida string, tabla string, ruta string")
            .option("mode", "FAILFAST").json(f"{root}/versions/*"))


def current_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Published table locations (empty if nothing was ever published)."""
    entries = _entries(spark, root)
    if entries is None:
        return {}
    newest = entries.groupBy("tabla").agg(F.max_by("ruta", F.struct("orden", "corrida")).alias("ruta"))
    return {r["tabla"]: r["ruta"] for r in newest.collect()}


def _publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, str]) -> None:
    # the next number, not a clock, decides which entry is newest; of two runs at once the run id does
    entries = _entries(spark, root)
    order = 1 if entries is None else (entries.agg(F.max("orden")).first()[0] or 0) + 1
    entry = spark.createDataFrame([(order, run_id, t, path) for t, path in sorted(tables.items())],
                                  "orden bigint, corrida string, tabla string, ruta string")
    # one file, moved into place when it is complete
    entry.coalesce(1).write.mode("error").json(f"{root}/versions/{order:012d}-{run_id}")


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    tables = current_tables(spark, root)
    if table not in tables:
        raise FileNotFoundError(f"{table} is not published under {root}")
    return spark.read.parquet(tables[table])


def _concurrently(*jobs):
    """Run independent Spark actions from driver threads; Spark schedules them together."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def stage_silver(spark: SparkSession, bronze: DataFrame, base: str,
                 gate_pct: float = K.LOSS_GATE_PCT) -> dict[str, str]:
    """Write silver once, partitioned by year and month, then apply the duplicate-key and
    loss gates (both evaluated by one job over the written table).

    All readers use that one table: partition filters prune months, and the rows of
    each writing task are clustered by grid point, so later per-point aggregations
    combine more on the map side and bbox filters skip row groups.
    """
    silver = S.to_silver(bronze, audit=True)
    staged = io.write_partitioned(silver, f"{base}/silver", ["anio", "mes"], cluster_by=SILVER_CLUSTER)
    written = io.read_parquet(spark, staged, silver.schema)  # an empty table has no file to tell its columns
    gate = Q.silver_gates(bronze, written, gate_pct).first()
    if gate["duplicados"]:
        raise GateError(f"{gate['duplicados']} duplicated silver keys")
    if not gate["publicar"]:
        raise GateError(f"loss {gate['perdida_pct']}% above {gate_pct}%")
    return {"silver": staged}


def add_row_ids(spark: SparkSession, bronze: DataFrame, path: str) -> DataFrame:
    """Bronze with a surrogate ``row_id`` (random UUID) first; ids that are there already are kept.

    ``uuid()`` is not stable under recomputation, so the ids are written first and
    the written table is checked: as many rows as the input and no repeated id,
    else ``GateError``.  Returns the written table.
    """
    ids = [] if "row_id" in bronze.columns else [F.expr("uuid()").alias("row_id")]
    before = Observation("filas")  # rows are counted while they are written, not by another scan of the source
    io.write_parquet(bronze.observe(before, F.count(F.lit(1)).alias("antes"))
                     .select(*ids, "*"), path)
    written = spark.read.parquet(path)
    # ids are compared through 64-bit hashes; only ids whose hash repeats are compared themselves
    ids = written.select("row_id", F.xxhash64("row_id").alias("_h"))
    again = ids.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h")
    chk = Q.side_by_side(written.agg(F.count(F.lit(1)).alias("despues")),
                         Q.duplicate_count(ids.join(again, "_h", "left_semi"), ["row_id"], "ids_repetidos")).first()
    if chk["ids_repetidos"] or before.get["antes"] != chk["despues"]:
        raise GateError(f"surrogate ids: {chk['ids_repetidos']} repeated, "
                        f"{before.get['antes']} -> {chk['despues']} rows")
    return written


def publish_if_valid(spark: SparkSession, bronze: DataFrame, root: str,
                     gate_pct: float = K.LOSS_GATE_PCT) -> RunResult:
    """Stage and check silver; publish only if every gate passes."""
    run_id = uuid.uuid4().hex[:12]
    tables = stage_silver(spark, bronze, f"{root}/runs/{run_id}", gate_pct)
    _publish(spark, root, run_id, tables)
    return RunResult(run_id, root, tables)


def build_gold(spark: SparkSession, silver: DataFrame, base: str) -> dict[str, str]:
    """Write the cube once, derive ranking / seasonality / summary from it, check keys.

    An empty silver is refused: it would publish an empty ranking.
    """
    if silver.limit(1).count() == 0:
        raise GateError("silver is empty")
    cube_path = io.write_parquet(G.gold_cube(silver), f"{base}/_gold_cube")
    cube = spark.read.parquet(cube_path)
    paths = {"ranking": f"{base}/ranking", "seasonality": f"{base}/seasonality"}
    _concurrently(
        lambda: io.write_parquet(G.with_audit(G.ranking_from_cube(cube)), paths["ranking"]),
        lambda: io.write_parquet(G.with_audit(G.seasonality_from_cube(cube)), paths["seasonality"]))
    rk = spark.read.parquet(paths["ranking"])
    es = spark.read.parquet(paths["seasonality"])
    paths["summary"] = io.write_parquet(G.with_audit(G.executive_summary(rk, es)), f"{base}/summary")
    summary = spark.read.parquet(paths["summary"])
    gate = Q.gold_gates(rk, es, summary).first()
    for name in ("ranking", "seasonality"):
        if gate[f"duplicados_{name}"]:
            raise GateError(f"gold {name} has {gate[f'duplicados_{name}']} duplicated keys")
    if gate["filas_resumen"] != gate["esperado"]:
        # a warning, not a gate, as in the layer's documented behaviour
        print(f"warning: summary has {gate['filas_resumen']} rows, expected {gate['esperado']}")
    paths.update({"map_center": f"{base}/map_center", "map_feed": f"{base}/map_feed",
                  "seasonality_partitioned": f"{base}/seasonality_partitioned",
                  "csv_ranking": f"{base}/csv/ranking", "csv_seasonality": f"{base}/csv/seasonality",
                  "csv_summary": f"{base}/csv/summary"})
    _concurrently(
        lambda: io.write_parquet(M.map_center(rk), paths["map_center"]),
        lambda: io.write_parquet(M.map_feed(rk), paths["map_feed"]),
        lambda: io.write_partitioned(es, paths["seasonality_partitioned"], ["pk_estacional_mes"]),
        lambda: io.export_csv(rk, paths["csv_ranking"], [F.col("score_final").desc(), "lat", "lon"]),
        lambda: io.export_csv(es, paths["csv_seasonality"],
                              [F.col("confort_pct").desc(), "pk_estacional_mes"]),
        lambda: io.export_csv(summary, paths["csv_summary"],
                              [F.col("score_final").desc(), "mes", "lat", "lon"]))
    return paths


REPORT_TABLES = (("bronze", "BRONZE"), ("silver", "SILVER"), ("ranking", "GOLD_RANKING"),
                 ("seasonality", "GOLD_ESTACIONAL"))


def validate_tables(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Validation report of written tables; an absent one is a failed row count (critical)."""
    return Q.validation_report(*(spark.read.parquet(tables[t]) if t in tables else None for t, _ in REPORT_TABLES))


def contract_report(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Contract violations (tabla, columna, regla, violaciones) of the written tables."""
    parts = [Q.contract_violations(spark.read.parquet(tables[t]), Q.CONTRACTS[t], audited=True)
             for t, _ in REPORT_TABLES if t in tables]
    return reduce(DataFrame.unionByName, parts).filter("violaciones > 0")


def validate_published(spark: SparkSession, root: str) -> DataFrame:
    tables = current_tables(spark, root)
    if not set(tables) & {t for t, _ in REPORT_TABLES}:
        return spark.createDataFrame([("row_count", capa, False, "no publicado", True) for _, capa in REPORT_TABLES],
                                     Q.REPORT_SCHEMA)
    return validate_tables(spark, tables)


def run_layers(spark: SparkSession, bronze: DataFrame | None, root: str, start: str = "bronze",
               validate_only: bool = False, gate_pct: float = K.LOSS_GATE_PCT, stop_on_critical: bool = True):
    """Run from ``start`` (bronze | silver | gold), or only validate what is published.

    bronze: write bronze sorted by (fecha, latitud, longitud), then silver and gold.
    silver: silver and gold from the given bronze.  gold: gold from the published silver.
    The staged tables, with the published ones for layers before ``start``, are validated
    and their contracts evaluated before anything is published.  Raises ``GateError`` on a
    failed gate and, with ``stop_on_critical``, on a failed critical check; the old tables
    then stay current.  Contract violations are published as the table ``contracts``.
    ``validate_only`` returns the validation report of the published tables.
    """
    if validate_only:
        return validate_published(spark, root)
    if start not in LAYERS:
        raise ValueError(f"unknown layer {start!r}; use one of {LAYERS}")
    run_id = uuid.uuid4().hex[:12]
    base = f"{root}/runs/{run_id}"
    tables: dict[str, str] = {}
    if start == "bronze":
        ordered = (bronze.repartitionByRange("fecha", "latitud", "longitud")
                         .sortWithinPartitions("fecha", "latitud", "longitud"))
        tables["bronze"] = f"{base}/bronze"
        bronze = add_row_ids(spark, ordered, tables["bronze"])
    if start in ("bronze", "silver"):
        if start == "silver" and bronze is None:
            bronze = published(spark, root, "bronze")
        tables.update(stage_silver(spark, bronze, base, gate_pct))
        gold = build_gold(spark, spark.read.parquet(tables["silver"]), base)
    else:
        gold = build_gold(spark, published(spark, root, "silver"), base)
    tables.update(gold)
    everything = {**current_tables(spark, root), **tables}
    contracts = f"{base}/contracts"
    outcome, _ = _concurrently(lambda: Q.verdict(validate_tables(spark, everything)).first(),
                               lambda: io.write_parquet(contract_report(spark, everything), contracts))
    if stop_on_critical and not outcome["aprobado"]:
        raise GateError(f"{outcome['criticos']} critical checks failed")
    tables["contracts"] = contracts
    _publish(spark, root, run_id, tables)
    return RunResult(run_id, root, tables)
