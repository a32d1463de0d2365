"""Unit conversions and derived physical measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cafetal.constants import (GDD_BASE_C, KELVIN_OFFSET, MAGNUS_A, MAGNUS_B,
                               MAGNUS_ES0_KPA)
from cafetal.functions.numeric import _c, rnd


def kelvin_to_c(x) -> Column:
    return _c(x) - F.lit(KELVIN_OFFSET)


def m_to_mm(x) -> Column:
    return _c(x) * F.lit(1000)


def j_to_mj(x) -> Column:
    return _c(x) / F.lit(1e6)


def _magnus(t_c: Column) -> Column:
    return F.exp(F.lit(MAGNUS_A) * t_c / (F.lit(MAGNUS_B) + t_c))


def relative_humidity(temp_k, dew_k) -> Column:
    """100 * e(Td) / e(T) with the Magnus form, from Kelvin inputs; not clipped."""
    return F.lit(100) * _magnus(kelvin_to_c(dew_k)) / _magnus(kelvin_to_c(temp_k))


def rh_clip(rh) -> Column:
    """Relative humidity above 100 % becomes 100 %."""
    return F.least(_c(rh), F.lit(100.0))


def saturation_vp_kpa(temp_c) -> Column:
    return F.lit(MAGNUS_ES0_KPA) * _magnus(_c(temp_c))


def vpd_kpa(temp_c, rh_pct) -> Column:
    """Vapour pressure deficit es(T) * (1 - RH/100), kPa, 4 decimals; RH above 100 counts as 100."""
    return rnd(saturation_vp_kpa(temp_c) * (F.lit(1.0) - rh_clip(rh_pct) / F.lit(100.0)), 4)


def gdd(temp_c, base: float = GDD_BASE_C) -> Column:
    """Daily growing degree days max(T - base, 0), 2 decimals."""
    return rnd(F.greatest(_c(temp_c) - F.lit(base), F.lit(0.0)), 2)


def water_balance(rain_mm, evap_mm) -> Column:
    """rain - potential evaporation, mm, 4 decimals."""
    return rnd(_c(rain_mm) - _c(evap_mm), 4)
