"""Column-expression building blocks (all JVM-side, codegen friendly)."""

from cafetal.functions.keys import composite_key
from cafetal.functions.numeric import pct, rnd, safe_div, stddev_from_moments, to_units
from cafetal.functions.physics import (gdd, j_to_mj, kelvin_to_c, m_to_mm, relative_humidity,
                                       rh_clip, saturation_vp_kpa, vpd_kpa, water_balance)
from cafetal.functions.scoring import (comfort_day, comfort_score, icc_percent_label, icc_score,
                                       optimal_day)

__all__ = [
    "composite_key", "pct", "rnd", "safe_div", "stddev_from_moments", "to_units",
    "gdd", "j_to_mj", "kelvin_to_c", "m_to_mm", "relative_humidity", "rh_clip",
    "saturation_vp_kpa", "vpd_kpa", "water_balance",
    "comfort_day", "comfort_score", "icc_percent_label", "icc_score", "optimal_day",
]
