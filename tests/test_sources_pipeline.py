"""Sources, sinks, publishing and layer runs."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from cafetal.operators import silver as S
from cafetal.plans import pipeline as P
from cafetal.sources import csv_ingest as C
from cafetal.sources import io
from cafetal.sources.fixture import bronze_fixture
from tests.conftest import SF_SMALL, rows


def test_csv_union_by_name_aligns_headers(spark, scratch):
    root = scratch("csv")
    spark.createDataFrame([("2020-01-01", "1.5", "2.5")], "date string, a string, b string") \
        .write.option("header", True).csv(f"{root}/ERA5_EC_one")
    spark.createDataFrame([("3.5", "2020-01-02")], "b string, date string") \
        .write.option("header", True).csv(f"{root}/ERA5_EC_two")
    spark.createDataFrame([("x",)], "other string").write.option("header", True).csv(f"{root}/our_export")
    files = C.list_files(spark, root)
    assert files and not [f for f in files if "our_export" in f]    # only the yearly files
    got = rows(C.csv_union_by_name(spark, files).select("date", "a", "b"))
    assert got == [("2020-01-01", "1.5", "2.5"), ("2020-01-02", None, "3.5")]


def test_bronze_typed_raises_on_bad_value(spark):
    raw = spark.createDataFrame([("2020-01-01", "x", "4.1", "290", "280", "0", "1", "0")],
                                ",".join(f"{c} string" for c in
                                         ["date", "longitude", "latitude", "temperature_2m",
                                          "dewpoint_temperature_2m", "total_precipitation_sum",
                                          "surface_solar_radiation_downwards_sum",
                                          "potential_evaporation_sum"]))
    with pytest.raises(Exception):
        C.bronze_typed(raw).collect()


def test_yearly_csv_roundtrip_keeps_values(spark, scratch):
    b = bronze_fixture(spark, SF_SMALL)
    files = C.write_yearly_csvs(b, scratch("yearly"), 1996, 2001)
    back = C.bronze_typed(C.csv_union_by_name(spark, files))
    want = b.withColumn("evap_pot_m", F.when(F.year("fecha") == 2001, None).otherwise(F.col("evap_pot_m")))
    assert back.exceptAll(want.select(*back.columns)).count() == 0
    assert back.count() == b.count()


def test_partitioned_read_prunes_partitions(spark, scratch):
    s = S.to_silver(bronze_fixture(spark, SF_SMALL))
    path = io.write_partitioned(s, scratch("parts"), ["anio", "mes"])
    one = spark.read.parquet(path).filter((F.col("anio") == 1997) & (F.col("mes") == 3))
    from cafetal.plans.explain import plan_text
    plan = plan_text(one)
    assert "PartitionFilters" in plan and "anio" in plan
    assert one.count() == s.filter("anio = 1997 AND mes = 3").count()


def test_write_if_absent_keeps_existing(spark, scratch):
    path = scratch("once")
    io.write_if_absent(spark.range(3), path)
    io.write_if_absent(spark.range(10), path)
    assert spark.read.parquet(path).count() == 3


def test_failed_gate_leaves_published_data(spark, scratch):
    root = scratch("pub")
    b = bronze_fixture(spark, SF_SMALL)
    first = P.publish_if_valid(spark, b, root)
    before = P.current_tables(spark, root)
    # make 10 % of the rows invalid: loss above the 2 % gate
    bad = b.withColumn("temp_k", F.when(F.dayofmonth("fecha") <= 3, None).otherwise(F.col("temp_k")))
    with pytest.raises(P.GateError):
        P.publish_if_valid(spark, bad, root)
    assert P.current_tables(spark, root) == before
    assert first.tables["silver"] == before["silver"]


def test_run_layers_from_each_layer(spark, scratch):
    root = scratch("layers")
    b = bronze_fixture(spark, SF_SMALL)
    full = P.run_layers(spark, b, root, "bronze", stop_on_critical=False)
    rk1 = rows(P.published(spark, root, "ranking").drop("aggregated_at"))
    P.run_layers(spark, None, root, "gold", stop_on_critical=False)
    rk2 = rows(P.published(spark, root, "ranking").drop("aggregated_at"))
    assert rk1 == rk2 and len(rk1) == 8
    assert P.published(spark, root, "map_center").count() == 1 and P.published(spark, root, "map_feed").count() == 8
    broken = {r.columna for r in P.published(spark, root, "contracts").collect()}
    assert "rh_pct" in broken and not {"row_id", "processed_at", "aggregated_at"} & broken
    assert P.current_tables(spark, root)["bronze"] == full.tables["bronze"]
    report = P.run_layers(spark, None, root, validate_only=True)
    assert report.count() == 25
    with pytest.raises(ValueError):
        P.run_layers(spark, b, root, "Bronze")


def test_bronze_written_sorted(spark, scratch):
    root = scratch("layers_sorted")
    P.run_layers(spark, bronze_fixture(spark, SF_SMALL), root, "bronze", stop_on_critical=False)
    keys = [(r.fecha, r.latitud, r.longitud) for r in P.published(spark, root, "bronze").collect()]
    assert keys == sorted(keys)


def test_dynamic_partition_overwrite_keeps_other_partitions(spark, scratch):
    path = scratch("dyn")
    io.write_partitioned(spark.createDataFrame([(1, 10), (2, 20)], "mes int, v int"), path, ["mes"])
    io.write_partitioned(spark.createDataFrame([(2, 99)], "mes int, v int"), path, ["mes"])
    assert rows(spark.read.parquet(path).select("mes", "v")) == [(1, 10), (2, 99)]


def test_row_ids_written_checked_and_kept(spark, scratch):
    b = bronze_fixture(spark, SF_SMALL)
    with_ids = P.add_row_ids(spark, b, scratch("ids"))
    assert with_ids.columns[0] == "row_id"
    r = with_ids.agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("d")).first()
    assert r.n == r.d == b.count()
    again = P.add_row_ids(spark, with_ids, scratch("ids2"))               # ids that are there are kept, written and checked
    assert rows(again.select("row_id", "fecha", "latitud")) == rows(with_ids.select("row_id", "fecha", "latitud"))
    with pytest.raises(P.GateError):
        P.add_row_ids(spark, with_ids.withColumn("row_id", F.lit("same")), scratch("ids3"))
    silver = S.to_silver(with_ids, audit=True)
    assert silver.columns[0] == "bronze_id" and "processed_at" in silver.columns


def test_command_line_runs_layers_and_validates(spark, scratch, capsys):
    from cafetal.__main__ import main
    root = scratch("cli")
    # the fixture has NULL temperatures and RH above 100: critical checks fail -> nothing is published
    assert main(["--tables", SF_SMALL, "--root", root]) == 1
    assert "critical checks failed" in capsys.readouterr().err and P.current_tables(spark, root) == {}
    assert main(["--tables", SF_SMALL, "--root", root, "--allow-critical"]) == 1
    out = capsys.readouterr().out
    assert "ranking" in out and "critical=" in out
    assert main(["--from", "gold", "--root", root, "--allow-critical"]) == 1
    assert main(["--explain", "silver", "--tables", SF_SMALL]) == 0
    assert "silver_preview" in capsys.readouterr().out


def test_validate_only_reports_missing_tables(spark, scratch):
    root = scratch("partial")
    P.publish_if_valid(spark, bronze_fixture(spark, SF_SMALL), root)      # silver only
    rep = {r.capa: r for r in P.run_layers(spark, None, root, validate_only=True).collect()}
    assert rep["SILVER"].paso is True
    assert rep["BRONZE"].paso is False and rep["GOLD_RANKING"].critico is True


def test_command_line_ingests_yearly_csvs(spark, scratch, capsys):
    from cafetal.__main__ import main
    landing = scratch("landing")
    C.write_yearly_csvs(bronze_fixture(spark, SF_SMALL), landing, 1996, 2001)
    root = scratch("cli_csv")
    assert main(["--csv", landing, "--root", root, "--allow-critical"]) == 1   # critical checks fail on the fixture
    assert "years without data: 2015" in capsys.readouterr().out
    rk = P.published(spark, root, "ranking")
    assert rk.count() == 8
    b = P.published(spark, root, "bronze")
    assert b.filter(F.year("fecha") == 2001).filter(F.col("evap_pot_m").isNotNull()).count() == 0


def test_duplicate_silver_key_blocks_publishing(spark, scratch):
    root = scratch("dup_gate")
    b = bronze_fixture(spark, SF_SMALL)
    dup = b.unionByName(b.orderBy("fecha", "latitud", "longitud").limit(1))
    with pytest.raises(P.GateError, match="duplicated silver keys"):
        P.publish_if_valid(spark, dup, root)
    assert P.current_tables(spark, root) == {}


def clean_bronze(spark):
    """Three months at two points, without any finding."""
    days = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-12-31', INTERVAL 1 DAY)) AS fecha")
    return days.selectExpr("fecha", "-75.5D AS longitud", "explode(array(4.5D, 5.5D)) AS latitud", "293D AS temp_k",
                           "289D AS dew_k", "0.004D AS lluvia_m", "1.5e7D AS rad_j_m2", "0.001D AS evap_pot_m")


def test_critical_finding_leaves_old_tables_current(spark, scratch):
    root = scratch("critical")
    P.run_layers(spark, clean_bronze(spark), root)
    before = P.current_tables(spark, root)
    assert {"bronze", "silver", "ranking", "contracts", "map_feed"} <= set(before)
    assert P.published(spark, root, "contracts").count() == 0
    wet = clean_bronze(spark).withColumn("dew_k", F.lit(299.0))           # humidity above 100 %
    with pytest.raises(P.GateError, match="critical"):
        P.run_layers(spark, wet, root)
    assert P.current_tables(spark, root) == before


def test_empty_silver_is_refused(spark, scratch):
    root = scratch("empty")
    P._publish(spark, root, "r", {"silver": io.write_parquet(
        S.to_silver(clean_bronze(spark), audit=True).filter("false"), scratch("none"))})
    with pytest.raises(P.GateError, match="silver is empty"):
        P.run_layers(spark, None, root, "gold")
    assert set(P.current_tables(spark, root)) == {"silver"}


def test_versions_are_merged_and_a_damaged_one_raises(spark, scratch, tmp_path):
    root = str(tmp_path / "pub")
    assert P.current_tables(spark, root) == {}
    P._publish(spark, root, "one", {"silver": "a", "bronze": "b"})
    P._publish(spark, root, "two", {"silver": "c"})                        # another run, not knowing the first
    assert P.current_tables(spark, root) == {"silver": "c", "bronze": "b"}
    bad = tmp_path / "pub" / "versions" / "9-crashed"
    bad.mkdir()
    assert P.current_tables(spark, root) == {"silver": "c", "bronze": "b"}  # a crash before its file was in place
    (bad / "part-0.json").write_text("{damaged")
    with pytest.raises(Exception):
        P.current_tables(spark, root)


@pytest.mark.parametrize("line", ["2020-01-01,4.5", "2020-01-01,4.5,1,9"])
def test_short_and_long_csv_lines_raise(spark, tmp_path, line):
    (tmp_path / "ERA5_EC_2020.csv").write_text(f"date,latitude,temp\n2020-01-02,4.5,2\n{line}\n")
    files = C.list_files(spark, str(tmp_path))
    with pytest.raises(Exception):
        C.csv_union_by_name(spark, files).collect()


def test_reheaded_file_and_absent_column(spark, tmp_path):
    (tmp_path / "ERA5_EC_2020.csv").write_text("date,latitude\n2020-01-02,4.5\n")
    (tmp_path / "ERA5_EC_2021.csv").write_text("latitude,date\n5.5,2021-01-02\n")
    raw = C.csv_union_by_name(spark, C.list_files(spark, str(tmp_path)))
    assert rows(raw.select("date", "latitude")) == [("2020-01-02", "4.5"), ("2021-01-02", "5.5")]
    with pytest.raises(ValueError, match="no file has"):
        C.bronze_typed(raw)


def test_rows_without_a_date_are_exported(spark, scratch):
    b = clean_bronze(spark).limit(3).withColumn("fecha", F.lit(None).cast("date"))
    files = C.write_yearly_csvs(b, scratch("nodate"), 1996, 2001)
    assert C.csv_union_by_name(spark, files).count() == 3


LINEITEM = ("l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
            "l_shipdate timestamp_ntz")


def _lineitem(spark, scratch, keys):
    sf = scratch("tables")
    spark.createDataFrame([(k, 1, 20.0, 9.0, 0.01, 0.02, datetime.datetime(1998, 3, 1)) for k in keys], LINEITEM).write.parquet(f"{sf}/lineitem.parquet")
    return sf


@pytest.mark.parametrize("name", ["bbox_filter", "bronze_sorted"])
def test_layers_are_written_anew_when_scratch_is_emptied(spark, scratch, name):
    from cafetal.plans import catalog
    sf = _lineitem(spark, scratch, [1, 2, 3])
    want = rows(catalog.queries()[name](spark, sf))
    assert len(want) == 3
    key = (spark.sparkContext.applicationId, sf)
    for tables in (catalog._BRONZE_TABLES, catalog._SILVER_TABLES):
        tables.update({key: scratch("emptied")} if key in tables else {})
    assert rows(catalog.queries()[name](spark, sf)) == want


def test_bronze_holds_keys_of_any_size(spark, scratch):
    keys = [-(2**63), -7, 0, 999, 10**15, 3 * 10**15 + 1, 2**63 - 1]
    rem = lambda a, b: abs(a) % b * (1 if a >= 0 else -1)  # noqa: E731  the sign of the dividend, as in SQL
    got = rows(bronze_fixture(spark, _lineitem(spark, scratch, keys)).select("latitud"))
    assert sorted(got) == sorted(((3900007 + 100 * rem(k * 7919, 22000)) / 1e6,) for k in keys)
    small = bronze_fixture(spark, _lineitem(spark, scratch, [-7, 999])).select("longitud")
    assert sorted(rows(small)) == sorted(((-76600000 + 10000 * rem(k * 31, 220) + k // 22000) / 1e6,) for k in (-7, 999))
