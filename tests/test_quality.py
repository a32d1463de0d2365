"""Checks, gates and contracts on small hand-made frames and on the fixture."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from cafetal.operators import gold as G
from cafetal.operators import quality as Q
from cafetal.operators import silver as S
from cafetal.sources.fixture import bronze_fixture
from tests.conftest import SF_SMALL, rows

BRONZE_SCHEMA = ("fecha date, longitud double, latitud double, temp_k double, dew_k double, "
                 "lluvia_m double, rad_j_m2 double, evap_pot_m double")


def _bronze(spark, n_ok, n_bad):
    import datetime as dt
    good = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), -75.5, 4.5, 293.15, 288.15, 0.004, 2e7, 0.003)
            for i in range(n_ok)]
    bad = [(dt.date(2021, 1, 1) + dt.timedelta(days=i), -75.5, 4.5, None, 288.15, 0.004, 2e7, 0.003)
           for i in range(n_bad)]
    return spark.createDataFrame(good + bad, BRONZE_SCHEMA)


def test_duplicate_keys_found_when_a_row_is_repeated(spark):
    b = bronze_fixture(spark, SF_SMALL)
    dup = b.unionByName(b.orderBy("fecha", "latitud", "longitud").limit(1))
    got = Q.duplicate_keys(dup, ["fecha", "latitud", "longitud"]).collect()
    assert len(got) == 1 and got[0]["n"] == 2
    assert Q.duplicate_keys(b, ["fecha", "latitud", "longitud"]).count() == 0


@pytest.mark.parametrize("n_bad,publish", [(1, True), (2, True), (3, False)])
def test_loss_gate_limit(spark, n_bad, publish):
    # 100 rows: 2 lost = 2.00 % passes (limit inclusive), 3 lost = 3.00 % fails
    b = _bronze(spark, 100 - n_bad, n_bad)
    g = Q.loss_gate(b, S.to_silver(b)).first()
    assert g["filas_bronze"] == 100 and g["filas_silver"] == 100 - n_bad
    assert g["publicar"] is publish


def test_empty_inputs_give_zero_counts(spark):
    b = _bronze(spark, 0, 0)
    assert tuple(Q.dew_le_temp(b).first()) == (0, 0)
    g = Q.loss_gate(b, S.to_silver(b)).first()
    assert g["perdida_pct"] is None and g["publicar"] is False


def test_validation_report_flags_nulls_and_rh(spark):
    b = bronze_fixture(spark, SF_SMALL)
    s = S.to_silver(b)
    rep = Q.validation_report(b, s, G.ranking(s), G.seasonality(s))
    by = {(r["check"], r["capa"]): r for r in rep.collect()}
    assert by[("no_nulls", "BRONZE.temp_k")]["paso"] is False        # the fixture has NULL temp_k
    assert by[("rango_fisico", "SILVER.rh_pct")]["paso"] is False     # RH above 100 is kept in silver
    assert by[("pk_unicidad", "SILVER")]["paso"] is True
    assert by[("row_consistency", "BRONZE->SILVER")]["critico"] is False
    v = Q.verdict(rep).first()
    assert v["aprobado"] is False and v["criticos"] >= 2


def test_contract_counts_check_and_not_null(spark):
    df = spark.createDataFrame([(1, 0.5), (13, None), (None, -1.0)], "pk_estacional_mes int, confort_pct double")
    df = df.withColumns({"score_mensual_promedio": F.lit(1.0), "variabilidad_score": F.lit(-1.0)})
    got = {(r.columna, r.regla): r.violaciones
           for r in Q.contract_violations(df, Q.CONTRACTS["seasonality"]).collect()}
    assert got[("pk_estacional_mes", "check")] == 1          # 13; NULL passes a CHECK
    assert got[("pk_estacional_mes", "not_null")] == 1
    assert got[("confort_pct", "check")] == 1                # -1.0
    assert got[("variabilidad_score", "check")] == 3
    assert got[("pk_estacional_mes", "primary_key")] == 0
    assert got[("pk_estacional_mes", "tipo")] == 0


def test_date_gaps_cover_the_declared_range(spark):
    day = datetime.date
    s = spark.createDataFrame([(4.5, -75.5, day(2020, 1, 1)), (4.5, -75.5, day(2020, 1, 4)), (4.5, -75.5, day(2020, 3, 1)),
                               (1.0, -75.0, day(9999, 12, 31))], "lat double, lon double, fecha date")
    got = [r[2] for r in rows(Q.date_gaps(s, "2019-12-31", "2020-03-02").filter("lat = 4.5"))]
    have = {day(2020, 1, 1), day(2020, 1, 4), day(2020, 3, 1)}
    every = [day(2019, 12, 31) + datetime.timedelta(k) for k in range(63)]
    assert got == [d for d in every if d not in have]       # leading, trailing and a whole missing month
    assert Q.date_gaps(s, "2019-12-31", "2020-03-02").filter("lat = 1").count() == 63
    assert Q.date_gaps(s).filter("lat = 4.5").count() == 4018 - 3       # the declared coverage


def test_summary_needs_twelve_months(spark):
    rk = spark.createDataFrame([(1,), (2,)], "x int")
    for months, ok in ((12, True), (11, False)):
        es = spark.range(months)
        got = Q.summary_cardinality(rk, rk.crossJoin(es), es).first()
        assert (got.esperado, got.ok) == (24, ok)


def test_report_of_absent_tables(spark):
    silver = spark.createDataFrame([], "fecha date, lat double, lon double, temp_c double, rh_pct double, "
                                       "rain_mm double, rad_mj_m2 double")
    rep = {(r["check"], r.capa): r for r in Q.validation_report(None, silver, None, None).collect()}
    assert not rep["row_count", "SILVER"].paso and rep["row_count", "SILVER"].detalle == "0 filas"
    assert not rep["row_count", "BRONZE"].paso and rep["no_nulls", "SILVER.lat"].paso
    assert ("no_nulls", "BRONZE.fecha") not in rep and ("pk_unicidad", "GOLD_RK") not in rep


def test_audited_contracts(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), (None, 3, 1.0)], "row_id string, k int, t double")
    contract = Q.Contract("t", [Q.Rule("row_id", "string", False, audit=True), Q.Rule("k", "int", False)], ["k"],
                          surrogate="row_id")
    got = {(r.columna, r.regla): r.violaciones for r in Q.contract_violations(df, contract, audited=True).collect()}
    assert got["row_id", "not_null"] == 1 and got["row_id", "primary_key"] == 1 and got["k", "primary_key"] == 0
    assert ("row_id", "tipo") not in {(r.columna, r.regla) for r in Q.contract_violations(df, contract).collect()}


def test_missing_years(spark):
    b = _bronze(spark, 3, 0)
    assert [r.anio for r in Q.missing_years(b, 2018, 2021).orderBy("anio").collect()] == [2018, 2019, 2021]
