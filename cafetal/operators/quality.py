"""Quality checks, contracts and the validation report, as fused aggregations.

Every table is read ONCE: row count, null counts, range and CHECK violations
and duplicates come from one grouping by its key, summed up afterwards.
Results stay DataFrames: a report row is built by exploding an array of
structs over the one-row profile, so nothing but the final small report needs
to reach the driver.  Counts from different tables are combined by a union
of the one-row profiles and one pivoting aggregate (no join).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cafetal import constants as K
from cafetal.functions import rnd
from cafetal.operators.silver import detect_columns
from cafetal.operators.spells import coverage_gaps


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true (NULL is not counted); 0 on an empty input."""
    return F.count(F.when(cond, F.lit(1)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def duplicate_count(df: DataFrame, keys: list[str], alias: str = "duplicados") -> DataFrame:
    """One row: how many key values are duplicated."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias(alias))


def table_profile(df: DataFrame, keys: list[str], counts: dict[str, Column], dup: str, rows: str = "_n") -> DataFrame:
    """One row: rows, duplicated key values and counts of conditions, from one scan and one grouping."""
    if not keys:
        return df.agg(F.count(F.lit(1)).alias(rows), *(count_if(c).alias(k) for k, c in counts.items()))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows), *(count_if(c).alias(k) for k, c in counts.items()))
    return per_key.agg(count_if(F.col(rows) > 1).alias(dup),
                       *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (rows, *counts)))


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames of integer metrics into one row, without a join.

    Each frame is melted to (metric, value) rows, the frames are unioned, and
    one aggregate pivots the metrics back into columns.
    """
    melted = [f.select(F.explode(F.create_map(*[x for c in f.columns
                                                for x in (F.lit(c), F.col(c).cast("bigint"))]))
                       .alias("_metric", "_value"))
              for f in frames]
    u = reduce(DataFrame.unionByName, melted)
    names = [c for f in frames for c in f.columns]
    return u.agg(*(F.max(F.when(F.col("_metric") == c, F.col("_value"))).alias(c) for c in names))


# --------------------------------------------------------------------------------
# validation report
# --------------------------------------------------------------------------------

REPORT_SCHEMA = "check string, capa string, paso boolean, detalle string, critico boolean"


def _row(check: str, capa: str, paso: Column, detalle: Column, critico: bool = True) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(capa).alias("capa"),
                    paso.alias("paso"), detalle.alias("detalle"), F.lit(critico).alias("critico"))


def _n(c: str) -> Column:
    return F.col(c).cast("string")


SILVER_KEY = ["fecha", "lat", "lon"]       # typed columns behind pk_silver
RANKING_KEY = ["lat", "lon"]               # typed columns behind pk_gold
# --- fixed values: columns that may not be null ----------------------------------
BRONZE_NULL_COLS = ["fecha", "latitud", "longitud", "temp_k", "dew_k", "lluvia_m"]
SILVER_NULL_COLS = ["fecha", "lat", "lon", "temp_c", "rh_pct", "rain_mm"]


def _silver_ranges() -> dict[str, Column]:
    return {
        "temp_c": ~F.col("temp_c").between(*K.TEMP_C_RANGE),
        "rh_pct": ~F.col("rh_pct").between(*K.RH_RANGE),
        "rain_mm": F.col("rain_mm") < F.lit(0),
        "rad_mj_m2": F.col("rad_mj_m2") < F.lit(0),
    }


CHECKS = ("row_count", "pk_unicidad", "no_nulls", "row_consistency", "rango_fisico")


def validation_report(bronze: DataFrame | None, silver: DataFrame | None, ranking: DataFrame | None,
                      seasonality: DataFrame | None, checks: tuple[str, ...] = CHECKS) -> DataFrame:
    """Check rows (check, capa, paso, detalle, critico) for the four tables.

    Each table is read once: rows, nulls, ranges and duplicates come from one
    grouping by its key (no grouping if uniqueness is not asked for).  A table given
    as None is reported as a failed row count, and its other checks are left out.
    """
    rng = _silver_ranges()
    unique = "pk_unicidad" in checks
    nulls, ranges = "no_nulls" in checks, "rango_fisico" in checks
    given = {"b": bronze, "s": silver, "r": ranking, "e": seasonality}
    counted = unique or "row_count" in checks
    compared = counted or "row_consistency" in checks
    frames, bronze_cols = [], []
    if bronze is not None and (compared or nulls):
        cols = detect_columns(bronze.columns)
        b = bronze.withColumnsRenamed({v: k for k, v in cols.items() if v != k})
        bronze_cols = [c for c in BRONZE_NULL_COLS if c in b.columns]
        frames.append(table_profile(b, ["fecha", "latitud", "longitud"] if unique else [],
                                    {f"b_null_{c}": F.col(c).isNull() for c in bronze_cols if nulls}, "b_dup", "b_n"))
    if silver is not None and (compared or nulls or ranges):
        conditions = {f"s_null_{c}": F.col(c).isNull() for c in SILVER_NULL_COLS if nulls}
        conditions |= {f"s_rng_{c}": cond for c, cond in rng.items() if ranges}
        # serialized keys are checked through the typed columns they encode
        # (pk_silver = fecha|lat|lon, pk_gold = lat|lon): same counts, smaller shuffle
        frames.append(table_profile(silver, SILVER_KEY if unique else [], conditions, "s_dup", "s_n"))
    if ranking is not None and counted:
        frames.append(table_profile(ranking, RANKING_KEY if unique else [], {}, "r_dup", "r_n"))
    if seasonality is not None and counted:
        frames.append(table_profile(seasonality, ["pk_estacional_mes"] if unique else [], {}, "e_dup", "e_n"))
    if not frames:
        raise ValueError("no table to validate")
    p = side_by_side(*frames)

    rows = []
    if "row_count" in checks:
        for capa, c in (("BRONZE", "b_n"), ("SILVER", "s_n"), ("GOLD_RANKING", "r_n"),
                        ("GOLD_ESTACIONAL", "e_n")):
            rows.append(_row("row_count", capa, F.col(c) > 0, F.concat(_n(c), F.lit(" filas")))
                        if given[c[0]] is not None else
                        _row("row_count", capa, F.lit(False), F.lit("no publicado")))
    if "pk_unicidad" in checks:
        for capa, c in (("BRONZE", "b_dup"), ("SILVER", "s_dup"), ("GOLD_RK", "r_dup"),
                        ("GOLD_ES", "e_dup")):
            if given[c[0]] is None:
                continue
            rows.append(_row("pk_unicidad", capa, F.col(c) == 0,
                             F.concat(_n(c), F.lit(" duplicados"))))
    if "no_nulls" in checks:
        for c in bronze_cols:
            k = f"b_null_{c}"
            rows.append(_row("no_nulls", f"BRONZE.{c}", F.col(k) == 0,
                             F.concat(_n(k), F.lit(" nulos"))))
        for c in SILVER_NULL_COLS if silver is not None else ():
            k = f"s_null_{c}"
            rows.append(_row("no_nulls", f"SILVER.{c}", F.col(k) == 0,
                             F.concat(_n(k), F.lit(" nulos"))))
    if "row_consistency" in checks and bronze is not None and silver is not None:
        loss = F.abs(F.col("b_n") - F.col("s_n")).cast("double") * F.lit(100.0) / F.nullif(
            F.col("b_n").cast("double"), F.lit(0.0))
        rows.append(_row("row_consistency", "BRONZE->SILVER",
                         F.coalesce(loss <= F.lit(K.LOSS_WARN_PCT), F.lit(False)),
                         F.concat(F.lit("bronze="), _n("b_n"), F.lit(" silver="), _n("s_n"),
                                  F.lit(" perdida_pct="),
                                  F.coalesce(rnd(loss, 2).cast("string"), F.lit("NULL"))),
                         critico=False))
    if ranges and silver is not None:
        for c in rng:
            k = f"s_rng_{c}"
            rows.append(_row("rango_fisico", f"SILVER.{c}", F.col(k) == 0,
                             F.concat(_n(k), F.lit(" fuera de rango"))))
    return p.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def verdict(report: DataFrame) -> DataFrame:
    """One row: whether no critical check failed, and the failure counts."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        count_if(~F.col("paso")).alias("fallidos"),
        count_if(~F.col("paso") & F.col("critico")).alias("criticos"),
    ).withColumn("aprobado", F.col("criticos") == 0)


# --------------------------------------------------------------------------------
# gates and single checks
# --------------------------------------------------------------------------------

def loss_gate(bronze: DataFrame, silver: DataFrame, limit_pct: float = K.LOSS_GATE_PCT) -> DataFrame:
    """One row: counts, loss percentage and whether silver may be published."""
    p = side_by_side(bronze.agg(F.count(F.lit(1)).alias("filas_bronze")),
                      silver.agg(F.count(F.lit(1)).alias("filas_silver")))
    loss = (F.abs(F.col("filas_bronze") - F.col("filas_silver")).cast("double") * F.lit(100.0)
            / F.nullif(F.col("filas_bronze").cast("double"), F.lit(0.0)))
    return p.select("filas_bronze", "filas_silver", rnd(loss, 2).alias("perdida_pct"),
                    F.coalesce(loss <= F.lit(limit_pct), F.lit(False)).alias("publicar"))


def silver_gates(bronze: DataFrame, silver: DataFrame, limit_pct: float = K.LOSS_GATE_PCT) -> DataFrame:
    """One row for the silver publish decision: duplicated keys and the loss gate, one job."""
    p = side_by_side(bronze.agg(F.count(F.lit(1)).alias("filas_bronze")),
                      silver.agg(F.count(F.lit(1)).alias("filas_silver")),
                      duplicate_count(silver, SILVER_KEY, "duplicados"))
    loss = (F.abs(F.col("filas_bronze") - F.col("filas_silver")).cast("double") * F.lit(100.0)
            / F.nullif(F.col("filas_bronze").cast("double"), F.lit(0.0)))
    return p.select("filas_bronze", "filas_silver", "duplicados", rnd(loss, 2).alias("perdida_pct"),
                    F.coalesce(loss <= F.lit(limit_pct), F.lit(False)).alias("publicar"))


def gold_gates(ranking_df: DataFrame, seasonality_df: DataFrame, summary_df: DataFrame) -> DataFrame:
    """One row for the gold publish decision: key duplicates and summary cardinality, one job."""
    p = side_by_side(duplicate_count(ranking_df, RANKING_KEY, "duplicados_ranking"),
                      duplicate_count(seasonality_df, ["pk_estacional_mes"], "duplicados_seasonality"),
                      ranking_df.agg(F.count(F.lit(1)).alias("filas_ranking")),
                      seasonality_df.agg(F.count(F.lit(1)).alias("filas_estacional")),
                      summary_df.agg(F.count(F.lit(1)).alias("filas_resumen")))
    return p.withColumn("esperado", F.col("filas_ranking") * F.lit(K.MONTHS))


def summary_cardinality(ranking_df: DataFrame, summary_df: DataFrame,
                        seasonality_df: DataFrame) -> DataFrame:
    """One row: summary rows against ranking rows x 12 months; ``ok`` is false if a month is absent."""
    p = side_by_side(ranking_df.agg(F.count(F.lit(1)).alias("filas_ranking")),
                      seasonality_df.agg(F.count(F.lit(1)).alias("filas_estacional")),
                      summary_df.agg(F.count(F.lit(1)).alias("filas_resumen")))
    esperado = F.col("filas_ranking") * F.lit(K.MONTHS)
    return p.select("filas_ranking", "filas_estacional", "filas_resumen",
                    esperado.alias("esperado"), (F.col("filas_resumen") == esperado).alias("ok"))


def dew_le_temp(bronze: DataFrame) -> DataFrame:
    """One row: rows checked and rows whose dew point exceeds the temperature."""
    return bronze.agg(F.count(F.lit(1)).alias("filas"),
                      count_if(F.col("dew_k") > F.col("temp_k")).alias("violaciones"))


def coords_in_country(bronze: DataFrame) -> DataFrame:
    """One row: rows checked and rows outside the country's coordinate limits."""
    c = detect_columns(bronze.columns)
    lat, lon = F.col(c["latitud"]), F.col(c["longitud"])
    outside = ~(lat.between(*K.COUNTRY_LAT) & lon.between(*K.COUNTRY_LON))
    return bronze.agg(F.count(F.lit(1)).alias("filas"),
                      count_if(F.coalesce(outside, F.lit(True))).alias("fuera_de_pais"))


def date_gaps(silver: DataFrame, start: str = K.COVERAGE[0], end: str = K.COVERAGE[1]) -> DataFrame:
    """Point-days missing from the declared coverage [start, end] (days outside it don't count).

    The intervals of ``coverage_gaps``, day by day; ask for those where the intervals will do.
    """
    gaps = coverage_gaps(silver, start, end)
    return gaps.select("lat", "lon", F.explode(F.sequence("inicio", "fin")).alias("fecha"))


def missing_years(bronze: DataFrame, first: int, last: int) -> DataFrame:
    """Years in [first, last] with no observation at all."""
    spark = bronze.sparkSession
    present = bronze.select(F.year("fecha").alias("anio")).distinct()
    expected = spark.range(first, last + 1).select(F.col("id").cast("int").alias("anio"))
    return expected.join(present, "anio", "left_anti")


# --------------------------------------------------------------------------------
# contracts
# --------------------------------------------------------------------------------

@dataclass
class Rule:
    column: str
    dtype: str
    nullable: bool = True
    check: str | None = None       # SQL predicate; NULL passes, as a CHECK constraint
    audit: bool = False            # written by a run; looked for only where the run has added it


@dataclass
class Contract:
    table: str
    rules: list[Rule]
    primary_key: list[str] = field(default_factory=list)
    typed_key: list[str] = field(default_factory=list)   # columns that a serialized key encodes
    surrogate: str | None = None                         # a random key besides, unique in written tables


# --- fixed values: layer contracts (types, NOT NULL, CHECK, keys) ---------------
CONTRACTS = {
    "bronze": Contract("bronze", [
        Rule("row_id", "string", False, audit=True),
        Rule("fecha", "date", False),
        Rule("latitud", "double", False),
        Rule("longitud", "double", False),
        Rule("temp_k", "double", False, "temp_k BETWEEN 200 AND 340"),
        Rule("dew_k", "double", False, "dew_k BETWEEN 200 AND 340"),
        Rule("lluvia_m", "double", False, "lluvia_m >= 0"),
        Rule("rad_j_m2", "double", False, "rad_j_m2 >= 0"),
        Rule("evap_pot_m", "double", True, "evap_pot_m >= 0"),
    ], ["fecha", "latitud", "longitud"], surrogate="row_id"),
    "silver": Contract("silver", [
        Rule("pk_silver", "string", False),
        Rule("fecha", "date", False),
        Rule("anio", "int", False, "anio BETWEEN 2000 AND 2100"),
        Rule("mes", "int", False, "mes BETWEEN 1 AND 12"),
        Rule("lat", "double", False),
        Rule("lon", "double", False),
        Rule("temp_c", "double", False, "temp_c BETWEEN -80 AND 60"),
        Rule("rh_pct", "double", False, "rh_pct BETWEEN 0 AND 100"),
        Rule("rain_mm", "double", False, "rain_mm >= 0"),
        Rule("rad_mj_m2", "double", False, "rad_mj_m2 >= 0"),
        Rule("evap_pot_mm", "double", True, "evap_pot_mm >= 0"),
        Rule("processed_at", "timestamp", False, audit=True),
    ], ["pk_silver"], typed_key=SILVER_KEY),
    "ranking": Contract("ranking", [
        Rule("pk_gold", "string", False),
        Rule("lat", "double", False),
        Rule("lon", "double", False),
        Rule("score_final", "double", False, "score_final BETWEEN 0 AND 100"),
        Rule("dias_evaluados", "bigint", False, "dias_evaluados > 0"),
        Rule("dias_optimos", "bigint", False, "dias_optimos >= 0"),
        Rule("pct_optimos", "double", False, "pct_optimos BETWEEN 0 AND 100"),
        Rule("aggregated_at", "timestamp", False, audit=True),
    ], ["pk_gold"], typed_key=RANKING_KEY),
    "seasonality": Contract("seasonality", [
        Rule("pk_estacional_mes", "int", False, "pk_estacional_mes BETWEEN 1 AND 12"),
        Rule("score_mensual_promedio", "double", False),
        Rule("variabilidad_score", "double", False, "variabilidad_score >= 0"),
        Rule("confort_pct", "double", False, "confort_pct BETWEEN 0 AND 100"),
        Rule("aggregated_at", "timestamp", False, audit=True),
    ], ["pk_estacional_mes"]),
    # the published data contract's own limits, which are narrower than the silver checks
    "documented": Contract("documented", [
        Rule("fecha", "date", False),
        Rule("lon", "double", False, "lon BETWEEN -79.0 AND -66.8"),
        Rule("lat", "double", False, "lat BETWEEN -4.3 AND 12.5"),
        Rule("temp_c", "double", True, "temp_c BETWEEN -10.0 AND 45.0"),
        Rule("dew_c", "double", True, "dew_c < temp_c"),
        Rule("humedad_relativa", "double", True, "humedad_relativa BETWEEN 0.0 AND 100.0"),
        Rule("lluvia_mm", "double", True, "lluvia_mm >= 0.0"),
        Rule("rad_mj_m2", "double", True, "rad_mj_m2 >= 0.0"),
        Rule("evap_pot_mm", "double", True, "evap_pot_mm >= 0.0"),
    ], ["fecha", "lat", "lon"]),
}


def contract_violations(df: DataFrame, contract: Contract, audited: bool = False) -> DataFrame:
    """Rows (tabla, columna, regla, violaciones) for every rule, from one scan.

    Type and presence rules are metadata (no job).  NOT NULL, CHECK and key rules
    come from one grouping by the key's typed columns: counts per key value are
    partial sums, so the table is read once.  ``audited`` includes the audit
    columns, which only written tables have, and the surrogate key.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts, rows = {}, []
    for r in contract.rules:
        if r.audit and not audited:
            continue
        present = r.column in types
        rows.append((r.column, "tipo", F.lit(0 if present and types[r.column] == r.dtype else 1)))
        if not present:
            continue
        if not r.nullable:
            counts[f"nn_{r.column}"] = F.col(r.column).isNull()
            rows.append((r.column, "not_null", F.col(f"nn_{r.column}")))
        if r.check:
            counts[f"ck_{r.column}"] = ~F.expr(r.check)
            rows.append((r.column, "check", F.col(f"ck_{r.column}")))
    key = contract.typed_key or contract.primary_key
    known = all(k in types for k in key)
    prof = table_profile(df, key if known else [], counts, "pk_dup")
    if known:
        rows.append((",".join(contract.primary_key), "primary_key", F.col("pk_dup")))
    if audited and contract.surrogate in types:
        # 64-bit hashes of the random ids are grouped; only hashes that repeat are looked at again
        ids = df.select(contract.surrogate, F.xxhash64(contract.surrogate).alias("_h"))
        again = ids.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h")
        prof = side_by_side(prof, duplicate_count(ids.join(again, "_h", "left_semi"), [contract.surrogate], "id_dup"))
        rows.append((contract.surrogate, "primary_key", F.col("id_dup")))
    structs = [F.struct(F.lit(contract.table).alias("tabla"), F.lit(c).alias("columna"),
                        F.lit(rule).alias("regla"), v.cast("bigint").alias("violaciones"))
               for c, rule, v in rows]
    return prof.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
