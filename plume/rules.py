"""Business thresholds and vocabularies.

FIXED VALUES — these must equal the reference pipeline's values for results to
match. They are stated here once, in natural order, and used everywhere else.
"""

from __future__ import annotations

# --- FIXED VALUES: raw record fields -------------------------------------------
REQUIRED_FIELDS = ("timestamp", "engine_id")
MEASURE_FIELDS = ("chamber_pressure", "fuel_flow", "temperature")
CSV_COLUMNS = REQUIRED_FIELDS + MEASURE_FIELDS

# --- FIXED VALUES: cleaning rules ----------------------------------------------
ABSOLUTE_ZERO = -273.15          # temperature below this drops the record
HIGH_TEMPERATURE_WARNING = 6000  # temperature above this is only logged
MIN_FUEL_FLOW = "0.1"            # a fuel flow of exactly 0 is replaced by this

# --- FIXED VALUES: anomaly bounds (strict compare; the bounds themselves are normal)
PRESSURE_ANOMALY = (80, 400)
FUEL_ANOMALY = (15, 220)
TEMPERATURE_ANOMALY = (1200, 4500)
ANOMALY_TYPES = (
    "LOW_PRESSURE",
    "HIGH_PRESSURE",
    "LOW_FUEL_FLOW",
    "HIGH_FUEL_FLOW",
    "LOW_TEMPERATURE",
    "HIGH_TEMPERATURE",
)

# --- FIXED VALUES: performance score bands (inclusive) and weights -------------
PRESSURE_SCORE_BAND = (120, 350, "0.4")
FUEL_SCORE_BAND = (30, 180, "0.3")
TEMPERATURE_SCORE_BAND = (1800, 4200, "0.3")

# --- FIXED VALUES: reading-level health (score >= threshold, first match) -------
READING_HEALTH = (
    (80, "EXCELLENT"),
    (60, "GOOD"),
    (40, "FAIR"),
    (20, "POOR"),
)
READING_HEALTH_ELSE = "CRITICAL"
READING_HEALTH_VALUES = ("EXCELLENT", "GOOD", "FAIR", "POOR", "CRITICAL")

# --- FIXED VALUES: engine-level health (anomaly rate <= threshold, first match) -
ENGINE_HEALTH = (
    (5, "EXCELLENT"),
    (15, "GOOD"),
    (30, "FAIR"),
)
ENGINE_HEALTH_ELSE = "NEEDS_ATTENTION"
ENGINE_HEALTH_VALUES = ("EXCELLENT", "GOOD", "FAIR", "NEEDS_ATTENTION")
FLIGHT_READY = ("EXCELLENT", "GOOD")

# --- FIXED VALUES: engine catalogue --------------------------------------------
ENGINE_NAMES = (
    ("TRE-001", "Terran R Engine Alpha"),
    ("TRE-002", "Terran R Engine Beta"),
    ("TRE-003", "Terran R Engine Gamma"),
    ("TRE-004", "Terran R Engine Delta"),
    ("TRE-005", "Terran R Engine Epsilon"),
)
UNKNOWN_ENGINE_SUFFIX = " (Unknown)"
ENGINE_TYPE = "Rocket Engine"
MANUFACTURER = "Relativity Space"
OPERATIONAL_STATUS = "ACTIVE"
INSTALLATION_DATE = "2024-01-01"

# --- FIXED VALUES: design limits for utilisation percentages -------------------
PRESSURE_LIMIT = 350
FUEL_LIMIT = 200
TEMPERATURE_LIMIT = 4000

# --- FIXED VALUES: daily trend classification -----------------------------------
ANOMALY_TREND_UP = "1.2"     # rate > 1.2 x 7-day average -> DETERIORATING
ANOMALY_TREND_DOWN = "0.8"   # rate < 0.8 x 7-day average -> IMPROVING
PERFORMANCE_TREND_UP = "1.1"    # score > 1.1 x 7-day average -> IMPROVING
PERFORMANCE_TREND_DOWN = "0.9"  # score < 0.9 x 7-day average -> DETERIORATING
TREND_VALUES = ("IMPROVING", "STABLE", "DETERIORATING")
MOVING_WINDOW_ROWS = 7
WEEK_LAG_ROWS = 7

# --- FIXED VALUES: daily alerts (first match) -----------------------------------
HIGH_ANOMALY_RATE = 25
RAPID_CHANGE = 10
ALERTS = ("HIGH_ANOMALY_ALERT", "CRITICAL_HEALTH_ALERT", "RAPID_DETERIORATION_ALERT")

# --- FIXED VALUES: dashboard score band -----------------------------------------
SCORE_BAND = ((95, "green"), (85, "yellow"))
SCORE_BAND_ELSE = "red"
LATEST_READINGS_LIMIT = 50
RECENT_ANOMALIES_LIMIT = 10
RECENT_DAYS_LIMIT = 7

# --- FIXED VALUES: metadata -------------------------------------------------------
SOURCE_SYSTEM = "AIRBYTE"
DIM_SOURCE_SYSTEM = "MANUAL"
UNKNOWN_KEY = -1
METRIC_NAMES = ("chamber_pressure", "fuel_flow", "temperature")
