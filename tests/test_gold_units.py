"""Gold arithmetic against figures of a published ranking, and export layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cafetal.operators import gold as G
from cafetal.sources import io

# --- fixed values: three rows of a published ranking (days, optimal days, % optimal, score) ---
# the score sums are the multiples of 25 whose mean rounds to the published score
PUBLISHED = [
    (4.099607, -76.099525, 3643, 1938, 309900, 53.2, 85.07),
    (4.199607, -76.099525, 3643, 1418, 302075, 38.92, 82.92),
    (4.299608, -75.999524, 3643, 888, 288825, 24.38, 79.28),
]
RANKING_CSV_HEADER = ["pk_gold", "lat", "lon", "dias_evaluados", "dias_optimos", "pct_optimos",
                      "score_final", "aggregated_at"]
SEASONALITY_CSV_HEADER = ["pk_estacional_mes", "score_mensual_promedio", "variabilidad_score",
                          "confort_pct", "aggregated_at"]


def test_ranking_columns_reproduce_published_figures(spark):
    df = spark.createDataFrame([r[:5] for r in PUBLISHED], "lat double, lon double, n long, n_opt long, s1 long")
    got = {(r.lat, r.lon): (r.pk_gold, r.pct_optimos, r.score_final)
           for r in G._ranking_columns(df).collect()}
    for lat, lon, _, _, _, pct, score in PUBLISHED:
        assert got[(lat, lon)] == (f"{lat}|{lon}", pct, score)


def test_exported_csv_headers_follow_the_published_layout(spark, scratch):
    rk = spark.createDataFrame([r[:5] for r in PUBLISHED], "lat double, lon double, n long, n_opt long, s1 long")
    rk = G.with_audit(G._ranking_columns(rk))
    path = io.export_csv(rk, scratch("rk_csv"), [F.col("score_final").desc()])
    first = spark.read.text(path).first()[0]
    assert first.split(",") == RANKING_CSV_HEADER
    es = spark.createDataFrame([(9, 100, 50, 6500, 450000)], "mes int, n long, n_confort long, s1 long, s2 long")
    es = G.with_audit(G._seasonality_columns(es))
    assert es.columns == SEASONALITY_CSV_HEADER
