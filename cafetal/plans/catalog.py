"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query starts from the supplied tables (through the fixture projection in
``cafetal.sources.fixture``), so its work grows with them.  As in a pipeline
run, the bronze and silver layers are projected once per application and
written to the shared scratch folder; the queries scan those tables.  Audit columns
(timestamps, random ids) are left out of results that have an oracle, since
they are not deterministic.  Queries that exercise a sink write to a fresh
folder under the shared checkpoint root and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cafetal import constants as K
from cafetal.functions import comfort_day, comfort_score, composite_key, optimal_day
from cafetal.operators import agro as A
from cafetal.operators import gold as G
from cafetal.operators import intervals as I
from cafetal.operators import mapdata as M
from cafetal.operators import polygon as Y
from cafetal.operators import quality as Q
from cafetal.operators import rolling as W
from cafetal.operators import silver as S
from cafetal.operators import sketches as H
from cafetal.operators import spatial as N
from cafetal.operators import spells as L
from cafetal.operators.asof import asof_join
from cafetal.operators.tablediff import table_diff
from cafetal.plans import incremental as D
from cafetal.plans import pipeline as P
from cafetal.session import scratch_path
from cafetal.sources import csv_ingest as C
from cafetal.sources import io
from cafetal.sources import raster as R
from cafetal.sources.fixture import bronze_fixture, coarse_grid_fixture, hourly_readings, station_readings, table
from cafetal.streaming.alarm_join import run_alarm_join
from cafetal.streaming.silver_stream import run_silver_stream

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: column names of the layers --------------------------------------------
BRONZE_COLUMNS = ["fecha", "longitud", "latitud", "temp_k", "dew_k", "lluvia_m", "rad_j_m2",
                  "evap_pot_m"]
RANKING_COLUMNS = ["pk_gold", "lat", "lon", "dias_evaluados", "dias_optimos", "pct_optimos",
                   "score_final"]

# --- fixed values: parameters of the registered queries ---------------------------------
CSV_REORDERED_YEAR = 1996         # written with its columns in reverse order
CSV_NO_EVAP_YEAR = 2001           # written without potential_evaporation_sum
EXPECTED_YEARS = (1993, 2002)     # expected coverage for missing_years
TOLERANCE = 0.18                  # degrees: half the diagonal of a 0.25 degree cell, rounded up
# a region with a bay and a lake (polygon, ring, seq, lat, lon); its east border runs through grid longitudes
REGION = [("zona", 0, 0, 4.1, -76.4), ("zona", 0, 1, 5.9, -76.2), ("zona", 0, 2, 5.5, -75.4), ("zona", 0, 3, 5.95, -74.8),
          ("zona", 0, 4, 4.4, -74.8), ("zona", 0, 5, 4.9, -75.7), ("zona", 1, 0, 4.9, -76.0), ("zona", 1, 1, 5.2, -75.9),
          ("zona", 1, 2, 5.0, -75.75)]
STATE_PARTITIONS = "16"           # state stores a side of the registered stream-stream join
CHANGED_MONTH = (1998, 3)         # published anew for incremental_gold and table_diff
DIFF_COLUMNS = ["pk_silver", "fecha", "anio", "mes", "lat", "lon", "temp_c", "rh_pct", "rain_mm"]
SAMPLE_START, SAMPLE_END = "1996-01-01", "2001-01-01"   # half-open date range


UUID_V4 = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
COVERAGE = "1995-01-01", "2001-12-31"                   # declared days of the fixture's series

_BRONZE_TABLES: dict[tuple[str, str], str] = {}
_SILVER_TABLES: dict[tuple[str, str], str] = {}


def _kept_layer(spark, sf_dir, tables, write):
    """The table that ``write`` made for ``sf_dir`` in this application; made anew if the scratch folder was emptied meanwhile."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in tables:
        try:
            return spark.read.parquet(tables[key])
        except AnalysisException:
            del tables[key]
    tables[key] = write()
    return spark.read.parquet(tables[key])


def bronze_layer(spark, sf_dir):
    """The bronze layer for ``sf_dir``: projected from the supplied tables once per
    application and written (sorted by date and coordinates, like a consolidated
    bronze file) to the shared scratch folder; later queries scan that table."""
    order = ["fecha", "latitud", "longitud"]
    return _kept_layer(spark, sf_dir, _BRONZE_TABLES, lambda: io.write_parquet(
        bronze_fixture(spark, sf_dir).repartitionByRange(*order).sortWithinPartitions(*order), scratch_path(spark, "bronze_layer")))


def silver_layer(spark, sf_dir):
    """The silver layer, written once per application like bronze; gold queries scan it,
    so their columns are pruned and the region's limits reach the scan."""
    return _kept_layer(spark, sf_dir, _SILVER_TABLES, lambda: io.write_parquet(
        S.to_silver(bronze_layer(spark, sf_dir)), scratch_path(spark, "silver_layer"), cluster_by=P.SILVER_CLUSTER))


_bronze = bronze_layer
_silver = silver_layer


def _ranking(spark, sf_dir):
    return G.ranking(_silver(spark, sf_dir))


def _seasonality(spark, sf_dir):
    return G.seasonality(_silver(spark, sf_dir))


def _gold(spark, sf_dir):
    return G.gold_tables(_silver(spark, sf_dir))


# ---------------------------------------------------------------- scans, sources, sinks
def q_csv_union_by_name(spark, sf_dir):
    root = scratch_path(spark, "yearly_csv")
    files = C.write_yearly_csvs(_bronze(spark, sf_dir), root, CSV_REORDERED_YEAR, CSV_NO_EVAP_YEAR)
    return C.bronze_typed(C.csv_union_by_name(spark, files))


def q_bronze_typed(spark, sf_dir):
    return C.bronze_typed(C.to_source_layout(_bronze(spark, sf_dir)))


def q_parquet_scan(spark, sf_dir):
    path = io.write_parquet(_bronze(spark, sf_dir), scratch_path(spark, "bronze"))
    return io.read_parquet(spark, path)


def q_parquet_sink(spark, sf_dir):
    path = io.write_parquet(G.with_audit(_ranking(spark, sf_dir)), scratch_path(spark, "ranking"))
    return io.read_parquet(spark, path).select(*RANKING_COLUMNS)


def q_partitioned_sink(spark, sf_dir):
    path = io.write_partitioned(_silver(spark, sf_dir), scratch_path(spark, "silver_parts"),
                                ["anio", "mes"])
    return io.read_parquet(spark, path).select(*S.SILVER_COLUMNS)


def q_csv_export(spark, sf_dir):
    rk = _ranking(spark, sf_dir)
    path = io.export_csv(rk, scratch_path(spark, "ranking_csv"),
                         [F.col("score_final").desc(), "lat", "lon"])
    return io.read_csv(spark, path, rk.schema)


def q_resolve_columns(spark, sf_dir):
    variant = _bronze(spark, sf_dir).withColumnsRenamed(
        {"latitud": "lat", "longitud": "lon", "fecha": "date_obs"})
    return S.resolve_columns(variant).select(*BRONZE_COLUMNS)


def q_skip_if_exists(spark, sf_dir):
    path = scratch_path(spark, "bronze_once")
    io.write_if_absent(_bronze(spark, sf_dir), path)
    io.write_if_absent(_silver(spark, sf_dir), path)   # ignored: the table already exists
    return io.read_parquet(spark, path)


def q_missing_years(spark, sf_dir):
    return Q.missing_years(_bronze(spark, sf_dir), *EXPECTED_YEARS)


def q_publish_if_valid(spark, sf_dir):
    root = scratch_path(spark, "publish")
    P.publish_if_valid(spark, _bronze(spark, sf_dir), root)
    return P.published(spark, root, "silver").select(*S.SILVER_COLUMNS)


def q_grid_sample_flatten(spark, sf_dir):
    tiles = R.tiles_from_bronze(_bronze(spark, sf_dir))
    return R.flatten_samples(tiles, SAMPLE_START, SAMPLE_END, K.INGEST_BBOX)


def q_bronze_sorted(spark, sf_dir):
    order = ["fecha", "latitud", "longitud"]
    return _bronze(spark, sf_dir).repartitionByRange(*order).sortWithinPartitions(*order)


def q_surrogate_uuid(spark, sf_dir):
    # ids are written, then checked (same count, no repeats) before they are used
    b = P.add_row_ids(spark, _bronze(spark, sf_dir), scratch_path(spark, "bronze_uuid"))
    return b.agg(F.count(F.lit(1)).alias("n_filas"),
                 F.count_distinct("row_id").alias("n_ids_distintos"),
                 Q.count_if(F.col("row_id").isNull()).alias("ids_nulos"),
                 Q.count_if(~F.col("row_id").rlike(UUID_V4)).alias("ids_mal_formados"))


def q_load_timestamp(spark, sf_dir):
    """Rows, rows without a load time, and distinct load times: one run has one."""
    s = S.to_silver(_bronze(spark, sf_dir), audit=True)
    return s.agg(F.count(F.lit(1)).alias("filas"), Q.count_if(F.col("processed_at").isNull()).alias("nulos"),
                 F.count_distinct("processed_at").alias("marcas"))


def q_run_layers(spark, sf_dir):
    root = scratch_path(spark, "layers")
    # the fixture holds humidities above 100 % on purpose, which is a critical finding
    P.run_layers(spark, _bronze(spark, sf_dir), root, start="bronze", stop_on_critical=False)
    return P.published(spark, root, "ranking").select(*RANKING_COLUMNS)


# ---------------------------------------------------------------- projections, scalars
def q_unit_conversion(spark, sf_dir):
    c = S.converted_columns()
    return _bronze(spark, sf_dir).select(
        "fecha", "latitud", "longitud", *(c[k].alias(k) for k in
                                          ("temp_c", "rain_mm", "rad_mj_m2", "evap_pot_mm")))


def q_relative_humidity(spark, sf_dir):
    return _bronze(spark, sf_dir).select("fecha", "latitud", "longitud",
                                         S.converted_columns()["rh_pct"].alias("rh_pct"))


def q_date_parts(spark, sf_dir):
    c = S.converted_columns()
    return _bronze(spark, sf_dir).select("fecha", "latitud", "longitud",
                                         c["anio"].alias("anio"), c["mes"].alias("mes"))


def q_round_coords(spark, sf_dir):
    c = S.converted_columns()
    return _bronze(spark, sf_dir).select("fecha", "latitud", "longitud",
                                         c["lat"].alias("lat"), c["lon"].alias("lon"))


def q_composite_key(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "pk_silver", composite_key("lat", "lon").alias("pk_punto"),
        composite_key("lat", "lon", "mes").alias("pk_punto_mes"))


def q_quality_filter(spark, sf_dir):
    return S.quality_filter(_bronze(spark, sf_dir))


def q_bbox_filter(spark, sf_dir):
    return G.bbox_filter(_silver(spark, sf_dir))


def q_comfort_score(spark, sf_dir):
    return G.bbox_filter(_silver(spark, sf_dir)).select("pk_silver", comfort_score().alias("score"))


def q_optimal_day(spark, sf_dir):
    return G.bbox_filter(_silver(spark, sf_dir)).select("pk_silver", optimal_day().alias("optimo"))


def q_comfort_day(spark, sf_dir):
    return G.bbox_filter(_silver(spark, sf_dir)).select(
        "pk_silver", comfort_day(comfort_score()).alias("confort"))


def q_seasonal_deviation(spark, sf_dir):
    return _gold(spark, sf_dir)["summary"].select("pk_resumen", "desviacion_estacional")


def q_silver_preview(spark, sf_dir):
    return S.silver_preview(_bronze(spark, sf_dir), 10)


def _daily(spark, sf_dir):
    return A.daily_indicators(_silver(spark, sf_dir))


def q_rh_clip(spark, sf_dir):
    return _daily(spark, sf_dir).select("pk_silver", "rh_pct", "rh_clip_pct")


def q_vpd(spark, sf_dir):
    return _daily(spark, sf_dir).select("pk_silver", "vpd_kpa")


def q_gdd(spark, sf_dir):
    return _daily(spark, sf_dir).select("pk_silver", "gdd")


def q_gdd_annual(spark, sf_dir):
    return A.gdd_annual(_silver(spark, sf_dir))


def q_water_balance(spark, sf_dir):
    return _daily(spark, sf_dir).select("pk_silver", "balance_mm")


def q_icc_score(spark, sf_dir):
    return _daily(spark, sf_dir).select("pk_silver", "icc")


def q_icc_percent_label(spark, sf_dir):
    return _daily(spark, sf_dir).select("pk_silver", "icc", "icc_pct")


def q_local_time(spark, sf_dir):
    return A.local_time(hourly_readings(spark, sf_dir)).select(
        "event_id", "punto", "ts_utc", "hora_local", "lectura")


# ---------------------------------------------------------------- joins
def q_grid_match(spark, sf_dir):
    return A.grid_match(_ranking(spark, sf_dir).select("lat", "lon"),
                        coarse_grid_fixture(spark, sf_dir))


def q_monthly_anomaly(spark, sf_dir):
    return A.monthly_anomaly(_silver(spark, sf_dir))


def q_nearest_cell(spark, sf_dir):
    return N.nearest_cell(_ranking(spark, sf_dir).select("lat", "lon"), coarse_grid_fixture(spark, sf_dir), TOLERANCE)


def _dry(spark, sf_dir):
    return L.dry_spells(_silver(spark, sf_dir), K.RAIN_MIN_OPT)


def q_asof_grid_day(spark, sf_dir):
    silver = _silver(spark, sf_dir).select("lat", "lon", F.col("fecha").cast("timestamp_ntz").alias("dia"), "temp_c", "rain_mm")
    return asof_join(station_readings(spark, sf_dir).select("event_id", "lat", "lon", "ts_utc", "lectura"), silver,
                     ["lat", "lon"], "ts_utc", "dia", ["temp_c", "rain_mm"])


def q_readings_in_spells(spark, sf_dir):
    return I.readings_in_spells(station_readings(spark, sf_dir).select("event_id", "lat", "lon", "fecha_local", "lectura"),
                                _dry(spark, sf_dir))


def q_compound_spells(spark, sf_dir):
    hot = L.spells(_silver(spark, sf_dir), F.col("temp_c") > F.lit(K.TEMP_MAX_OPT))
    return I.compound_spells(_dry(spark, sf_dir), hot)


# ---------------------------------------------------------------- aggregations, windows, top-k
def q_dry_spells(spark, sf_dir):
    return _dry(spark, sf_dir)


def q_rolling_rain(spark, sf_dir):
    return W.rolling_rain(_silver(spark, sf_dir))


def q_rollup_scores(spark, sf_dir):
    return W.rollup_scores(_silver(spark, sf_dir))


def q_incremental_gold(spark, sf_dir):
    """The cube after one published month was replaced: its rows of odd days only, two degrees warmer."""
    silver, root = _silver(spark, sf_dir), scratch_path(spark, "incremental")
    published = io.write_partitioned(silver, f"{root}/silver", ["anio", "mes"])
    D.update(spark, published, f"{root}/state")
    year, month = CHANGED_MONTH
    new = (silver.filter((F.col("anio") == year) & (F.col("mes") == month) & (F.dayofmonth("fecha") % 2 == 1))
           .withColumn("temp_c", F.col("temp_c") + F.lit(2.0)))
    io.write_partitioned(new, published, ["anio", "mes"])
    done = D.update(spark, published, f"{root}/state")
    if done["scanned"] != [CHANGED_MONTH] or done["removed"]:
        raise RuntimeError(f"an update of {CHANGED_MONTH} scanned {done}")
    return D.cube(spark, f"{root}/state")


def _replaced_month(silver):
    """The published table with one month's rows of even days gone and its odd days two degrees warmer."""
    year, month = CHANGED_MONTH
    changed = (F.col("anio") == year) & (F.col("mes") == month)
    kept = silver.filter(~changed | (F.dayofmonth("fecha") % 2 == 1))
    return kept.withColumn("temp_c", F.when(changed, F.col("temp_c") + F.lit(2.0)).otherwise(F.col("temp_c")))


def q_table_diff(spark, sf_dir):
    before = _silver(spark, sf_dir).select(*DIFF_COLUMNS)
    after = io.read_parquet(spark, io.write_partitioned(_replaced_month(before), scratch_path(spark, "new_run"), ["anio", "mes"]))
    return table_diff(before, after.select(*(F.col(c).cast(before.schema[c].dataType) for c in DIFF_COLUMNS)), ["pk_silver"],
                      ["anio", "mes"])


def q_points_in_region(spark, sf_dir):
    region = spark.createDataFrame(REGION, "polygon string, ring int, seq int, lat double, lon double")
    return Y.points_in_polygons(_silver(spark, sf_dir).select("lat", "lon"), region)


def q_sketch_bounds(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    states = io.read_parquet(spark, io.write_parquet(H.month_states(silver), scratch_path(spark, "sketches")))
    return H.within_bounds(silver, states)


def q_stream_alarm_join(spark, sf_dir):
    """The events arrive as three deliveries in time order; the query is stopped and started again after each."""
    events, root = table(spark, sf_dir, "events"), scratch_path(spark, "alarms")
    cuts = events.agg(F.percentile_approx("ts", [0.33, 0.66], 10_000)).first()[0]
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", STATE_PARTITIONS)
    third = F.when(F.col("ts") < F.lit(cuts[0]), 0).when(F.col("ts") < F.lit(cuts[1]), 1).otherwise(2)
    for k in range(3):
        events.filter(third == k).write.parquet(f"{root}/in/delivery{k}")
        run_alarm_join(session, f"{root}/in/*", f"{root}/out", f"{root}/checkpoint")
    return io.read_parquet(spark, f"{root}/out").select(
        "punto", "alarma", F.col("t_alarma").cast("timestamp_ntz").alias("t_alarma"), "lectura",
        F.col("t_lectura").cast("timestamp_ntz").alias("t_lectura"))


def q_stream_silver(spark, sf_dir):
    """Bronze arrives year by year; each run converts what is new and appends it to silver."""
    bronze, root = _bronze(spark, sf_dir), scratch_path(spark, "silver_stream")
    for k, part in enumerate((F.year("fecha") < 1998, F.year("fecha") >= 1998)):
        bronze.filter(part).write.parquet(f"{root}/in/delivery{k}")
        run_silver_stream(spark, f"{root}/in/*", f"{root}/out", f"{root}/checkpoint")
    return io.read_parquet(spark, f"{root}/out").select(*S.SILVER_COLUMNS)


def q_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_bronze(spark, sf_dir), ["fecha", "latitud", "longitud"])


def q_map_center(spark, sf_dir):
    return M.map_center(_ranking(spark, sf_dir))


def q_thermal_amplitude(spark, sf_dir):
    return A.thermal_amplitude(hourly_readings(spark, sf_dir))


def q_map_feed(spark, sf_dir):
    return M.map_feed(_ranking(spark, sf_dir))


def q_icc_ranking(spark, sf_dir):
    return A.icc_ranking(_silver(spark, sf_dir))


def q_icc_top5_points(spark, sf_dir):
    return A.icc_top_points(_silver(spark, sf_dir), 5)


def q_icc_seasonality(spark, sf_dir):
    return A.icc_seasonality(_silver(spark, sf_dir))


# ---------------------------------------------------------------- checks and contracts
def _report(spark, sf_dir, checks=Q.CHECKS):
    s = _silver(spark, sf_dir)
    return Q.validation_report(_bronze(spark, sf_dir), s, G.ranking(s), G.seasonality(s), checks)


def _check(name):
    def run(spark, sf_dir):
        return _report(spark, sf_dir, (name,))
    run.__name__ = f"q_check_{name}"
    return run


def q_validation_report(spark, sf_dir):
    return _report(spark, sf_dir)


def q_validation_verdict(spark, sf_dir):
    return Q.verdict(_report(spark, sf_dir))


def q_loss_gate(spark, sf_dir):
    return Q.loss_gate(_bronze(spark, sf_dir), _silver(spark, sf_dir))


def q_date_gaps(spark, sf_dir):
    return Q.date_gaps(_silver(spark, sf_dir), *COVERAGE)


def q_coverage_gaps(spark, sf_dir):
    return L.coverage_gaps(_silver(spark, sf_dir), *COVERAGE)


def q_dew_le_temp(spark, sf_dir):
    return Q.dew_le_temp(_bronze(spark, sf_dir))


def q_coords_in_country(spark, sf_dir):
    return Q.coords_in_country(_bronze(spark, sf_dir))


def q_summary_cardinality(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return Q.summary_cardinality(g["ranking"], g["summary"], g["seasonality"])


def q_contract_bronze(spark, sf_dir):
    return Q.contract_violations(_bronze(spark, sf_dir), Q.CONTRACTS["bronze"])


def q_contract_silver(spark, sf_dir):
    return Q.contract_violations(_silver(spark, sf_dir), Q.CONTRACTS["silver"])


def q_contract_ranking(spark, sf_dir):
    return Q.contract_violations(_ranking(spark, sf_dir), Q.CONTRACTS["ranking"])


def q_contract_seasonality(spark, sf_dir):
    return Q.contract_violations(_seasonality(spark, sf_dir), Q.CONTRACTS["seasonality"])


def q_contract_documented(spark, sf_dir):
    return Q.contract_violations(S.documented_table(_bronze(spark, sf_dir)), Q.CONTRACTS["documented"])


# ---------------------------------------------------------------- gold (core)
def q_ranking(spark, sf_dir):
    return _ranking(spark, sf_dir)


def q_seasonality(spark, sf_dir):
    return _seasonality(spark, sf_dir)


def q_point_seasonality(spark, sf_dir):
    return G.point_seasonality(_silver(spark, sf_dir))


def q_ranking_counts(spark, sf_dir):
    return G.ranking_counts(_silver(spark, sf_dir))


def q_executive_summary(spark, sf_dir):
    return _gold(spark, sf_dir)["summary"]


def q_summary_sorted(spark, sf_dir):
    return G.summary_sorted(q_executive_summary(spark, sf_dir))


def q_seasonality_sorted(spark, sf_dir):
    return G.seasonality_sorted(_seasonality(spark, sf_dir))


def q_point_month_join(spark, sf_dir):
    return G.point_month_join(_silver(spark, sf_dir))


def q_top20_point_month(spark, sf_dir):
    return G.top_point_months(_silver(spark, sf_dir), 20)


def q_top5_points(spark, sf_dir):
    return G.top_points(_ranking(spark, sf_dir), 5)


def q_silver(spark, sf_dir):
    return _silver(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        # scans, sources, sinks
        "csv_union_by_name": q_csv_union_by_name,
        "bronze_typed": q_bronze_typed,
        "parquet_scan": q_parquet_scan,
        "parquet_sink": q_parquet_sink,
        "partitioned_sink": q_partitioned_sink,
        "csv_export": q_csv_export,
        "resolve_columns": q_resolve_columns,
        "skip_if_exists": q_skip_if_exists,
        "missing_years": q_missing_years,
        "publish_if_valid": q_publish_if_valid,
        "grid_sample_flatten": q_grid_sample_flatten,
        "surrogate_uuid": q_surrogate_uuid,
        "load_timestamp": q_load_timestamp,
        "run_layers": q_run_layers,
        # projections and scalar functions
        "silver": q_silver,
        "unit_conversion": q_unit_conversion,
        "relative_humidity": q_relative_humidity,
        "date_parts": q_date_parts,
        "round_coords": q_round_coords,
        "composite_key": q_composite_key,
        "quality_filter": q_quality_filter,
        "bbox_filter": q_bbox_filter,
        "comfort_score": q_comfort_score,
        "optimal_day": q_optimal_day,
        "comfort_day": q_comfort_day,
        "seasonal_deviation": q_seasonal_deviation,
        "silver_preview": q_silver_preview,
        "rh_clip": q_rh_clip,
        "vpd": q_vpd,
        "gdd": q_gdd,
        "gdd_annual": q_gdd_annual,
        "water_balance": q_water_balance,
        "icc_score": q_icc_score,
        "icc_percent_label": q_icc_percent_label,
        "local_time": q_local_time,
        # joins
        "executive_summary": q_executive_summary,
        "point_month_join": q_point_month_join,
        "grid_match": q_grid_match,
        "nearest_cell": q_nearest_cell,
        "asof_grid_day": q_asof_grid_day,
        "readings_in_spells": q_readings_in_spells,
        "compound_spells": q_compound_spells,
        "points_in_region": q_points_in_region,
        "stream_alarm_join": q_stream_alarm_join,
        "monthly_anomaly": q_monthly_anomaly,
        # aggregations
        "ranking": q_ranking,
        "seasonality": q_seasonality,
        "point_seasonality": q_point_seasonality,
        "ranking_counts": q_ranking_counts,
        "duplicate_keys": q_duplicate_keys,
        "map_center": q_map_center,
        "thermal_amplitude": q_thermal_amplitude,
        "icc_ranking": q_icc_ranking,
        "icc_seasonality": q_icc_seasonality,
        "rollup_scores": q_rollup_scores,
        "incremental_gold": q_incremental_gold,
        "sketch_bounds": q_sketch_bounds,
        "table_diff": q_table_diff,
        "stream_silver": q_stream_silver,
        # windows, sorts, top-k
        "map_feed": q_map_feed,
        "dry_spells": q_dry_spells,
        "rolling_rain": q_rolling_rain,
        "bronze_sorted": q_bronze_sorted,
        "seasonality_sorted": q_seasonality_sorted,
        "summary_sorted": q_summary_sorted,
        "top20_point_month": q_top20_point_month,
        "top5_points": q_top5_points,
        "icc_top5_points": q_icc_top5_points,
        # quality checks and contracts
        "check_row_counts": _check("row_count"),
        "check_pk_unique": _check("pk_unicidad"),
        "check_no_nulls": _check("no_nulls"),
        "check_row_consistency": _check("row_consistency"),
        "check_ranges": _check("rango_fisico"),
        "validation_report": q_validation_report,
        "validation_verdict": q_validation_verdict,
        "loss_gate": q_loss_gate,
        "date_gaps": q_date_gaps,
        "coverage_gaps": q_coverage_gaps,
        "dew_le_temp": q_dew_le_temp,
        "coords_in_country": q_coords_in_country,
        "summary_cardinality": q_summary_cardinality,
        "contract_bronze": q_contract_bronze,
        "contract_silver": q_contract_silver,
        "contract_ranking": q_contract_ranking,
        "contract_seasonality": q_contract_seasonality,
        "contract_documented": q_contract_documented,
    }
