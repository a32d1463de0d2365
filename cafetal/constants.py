"""Fixed values of the domain.

These must equal the documented thresholds for right results, so they are
stated plainly here and nowhere else.
"""

# --- fixed values: daily comfort tests (inclusive limits) -------------------
TEMP_MIN_OPT, TEMP_MAX_OPT = 17.0, 23.0      # degrees C
RH_MIN_OPT, RH_MAX_OPT = 70.0, 85.0          # percent
RAIN_MIN_OPT = 3.0                           # mm per day
RAD_MIN_OPT = 10.0                           # MJ per m2 per day
POINTS_PER_TEST = 25                         # four tests, 0..100
COMFORT_DAY_MIN_SCORE = 75

# --- fixed values: gold region (inclusive) -----------------------------------
LAT_MIN, LAT_MAX = 4.0, 6.0
LON_MIN, LON_MAX = -76.5, -74.5

# --- fixed values: bronze quality filter -------------------------------------
KELVIN_MIN, KELVIN_MAX = 200.0, 340.0

# --- fixed values: physical range checks on silver ---------------------------
TEMP_C_RANGE = (-80.0, 60.0)
RH_RANGE = (0.0, 100.0)

# --- fixed values: country limits for coordinates ----------------------------
COUNTRY_LAT = (-4.3, 12.5)
COUNTRY_LON = (-79.0, -66.8)

# --- fixed values: loss limits bronze -> silver (percent) --------------------
LOSS_GATE_PCT = 2.0        # silver is not published above this
LOSS_WARN_PCT = 1.0        # validation warning above this

# --- fixed values: unit conversion and Magnus humidity ------------------------
KELVIN_OFFSET = 273.15
MAGNUS_A = 17.625
MAGNUS_B = 243.04
MAGNUS_ES0_KPA = 0.61094   # saturation vapour pressure at 0 C, kPa

# --- fixed values: documented agro indicators ----------------------------------
GDD_BASE_C = 10.0
LOCAL_UTC_OFFSET_HOURS = -5
ICC_TEMP_BEST = (18.0, 22.0)
ICC_TEMP_OK = (15.0, 25.0)
ICC_VPD_BEST = (0.3, 0.7)
ICC_VPD_OK = (0.1, 1.0)
ICC_RH_BEST = (70.0, 85.0)
ICC_MAX_POINTS = 40

# --- fixed values: ingest ------------------------------------------------------
INGEST_YEARS = (2015, 2024)
COVERAGE = ("2015-01-01", "2025-12-31")      # declared days of the series, inclusive
MONTHS = 12                                  # rows of the summary per point
YEARLY_FILE_PREFIX = "ERA5_EC_"              # yearly files are <prefix><year>.csv
INGEST_BBOX = (-76.1, 4.0, -75.2, 5.6)       # lon_min, lat_min, lon_max, lat_max
SOURCE_COLUMNS = {                            # source name -> bronze name
    "date": "fecha",
    "longitude": "longitud",
    "latitude": "latitud",
    "temperature_2m": "temp_k",
    "dewpoint_temperature_2m": "dew_k",
    "total_precipitation_sum": "lluvia_m",
    "surface_solar_radiation_downwards_sum": "rad_j_m2",
    "potential_evaporation_sum": "evap_pot_m",
}
