"""Daily comfort scores as column expressions (NULL measures score 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cafetal import constants as K
from cafetal.functions.numeric import _c


def _points(cond: Column, pts: int) -> Column:
    return F.when(cond, F.lit(pts)).otherwise(F.lit(0))


def comfort_tests(temp_c="temp_c", rh_pct="rh_pct", rain_mm="rain_mm", rad_mj_m2="rad_mj_m2"):
    return [
        _c(temp_c).between(K.TEMP_MIN_OPT, K.TEMP_MAX_OPT),
        _c(rh_pct).between(K.RH_MIN_OPT, K.RH_MAX_OPT),
        _c(rain_mm) >= F.lit(K.RAIN_MIN_OPT),
        _c(rad_mj_m2) >= F.lit(K.RAD_MIN_OPT),
    ]


def comfort_score(**cols) -> Column:
    """0..100: 25 points for each of the four tests that holds."""
    t = comfort_tests(**cols)
    return (_points(t[0], K.POINTS_PER_TEST) + _points(t[1], K.POINTS_PER_TEST)
            + _points(t[2], K.POINTS_PER_TEST) + _points(t[3], K.POINTS_PER_TEST))


def optimal_day(**cols) -> Column:
    """1 when all four tests hold, else 0."""
    t = comfort_tests(**cols)
    return F.when(t[0] & t[1] & t[2] & t[3], F.lit(1)).otherwise(F.lit(0))


def comfort_day(score) -> Column:
    """1 when the day scores at least 75, else 0."""
    return F.when(_c(score) >= F.lit(K.COMFORT_DAY_MIN_SCORE), F.lit(1)).otherwise(F.lit(0))


def icc_score(temp_c="temp_c", vpd="vpd_kpa", rh_pct="rh_pct", balance="balance_mm") -> Column:
    """Coffee comfort index, 0..40 (10 points per factor, partial credit as documented)."""
    t, v, h, b = _c(temp_c), _c(vpd), _c(rh_pct), _c(balance)
    p_temp = (F.when(t.between(*K.ICC_TEMP_BEST), 10)
              .when(t.between(*K.ICC_TEMP_OK), 5).otherwise(0))
    p_vpd = (F.when(v.between(*K.ICC_VPD_BEST), 10)
             .when(v.between(*K.ICC_VPD_OK), 5).otherwise(0))
    p_rh = F.when(h.between(*K.ICC_RH_BEST), 10).otherwise(5)
    p_water = F.when(b > 0, 10).otherwise(0)
    return p_temp + p_vpd + p_rh + p_water


def icc_percent_label(score) -> Column:
    """(score / 40) * 100 rendered with a percent sign, e.g. '62.5%'."""
    return F.concat((_c(score).cast("double") / F.lit(float(K.ICC_MAX_POINTS)) * F.lit(100.0))
                    .cast("string"), F.lit("%"))
