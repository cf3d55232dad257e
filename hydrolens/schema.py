"""Event schema, controlled vocabularies and operating limits."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Event fields.
# ---------------------------------------------------------------------------
EVENT_TEXT_FIELDS = (
    "reading_id",
    "station_id",
    "sensor_id",
    "timestamp",
    "water_source_type",
    "station_category",
)

MEASURES = (
    "raw_turbidity_ntu",
    "raw_ph",
    "raw_conductivity_us_cm",
    "raw_temperature_c",
    "raw_ammonia_mg_l",
    "raw_alkalinity_mg_l",
    "settled_turbidity_ntu",
    "sludge_blanket_level_m",
    "estimated_settling_efficiency_pct",
    "filtered_turbidity_ntu",
    "head_loss_m",
    "filtration_rate_m_h",
    "final_residual_chlorine_mg_l",
    "final_ph",
    "final_turbidity_ntu",
)

EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in EVENT_TEXT_FIELDS]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
    + [T.StructField("data_source", T.StringType())]
)

STATION_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("governorate", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("water_source_type", T.StringType()),
        T.StructField("station_category", T.StringType()),
        T.StructField("plant_capacity_m3_day", T.IntegerType()),
        T.StructField("operational_status", T.StringType()),
        T.StructField("commission_date", T.DateType()),
        T.StructField("data_source", T.StringType()),
    ]
)

SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("sensor_name", T.StringType()),
        T.StructField("sensor_stage", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("unit_group", T.StringType()),
        T.StructField("installation_date", T.DateType()),
        T.StructField("calibration_date", T.DateType()),
        T.StructField("sensor_status", T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Vocabularies.
# ---------------------------------------------------------------------------
QUALITY_FLAGS = ("valid", "partial", "invalid", "suspicious")
STATUS_COLORS = ("green", "yellow", "orange", "red", "gray")

# Colour ranks and the words shown for a colour.
COLOR_PRIORITY = {"gray": 0, "green": 1, "yellow": 2, "orange": 3, "red": 4}
COLOR_LABELS = {
    "green": "Stable",
    "yellow": "Monitor",
    "orange": "Risk",
    "red": "Critical",
    "gray": "No Data",
}

# ---------------------------------------------------------------------------
# Validation limits.
# ---------------------------------------------------------------------------
# A reading without one of these is partial.
KEY_MEASURES = (
    "raw_turbidity_ntu",
    "settled_turbidity_ntu",
    "filtered_turbidity_ntu",
    "final_turbidity_ntu",
    "final_residual_chlorine_mg_l",
    "final_ph",
)

# Only readings that have all of these feed the index and the alerts.
BUSINESS_MEASURES = KEY_MEASURES + ("raw_ph",)

# measure -> (lowest, highest) physically possible value, both inclusive.
PHYSICAL_RANGES = {
    "raw_ph": (0, 14),
    "final_ph": (0, 14),
    "raw_turbidity_ntu": (0, 1000),
    "settled_turbidity_ntu": (0, 300),
    "filtered_turbidity_ntu": (0, 100),
    "final_turbidity_ntu": (0, 20),
    "final_residual_chlorine_mg_l": (0, 5),
    "estimated_settling_efficiency_pct": (0, 100),
}

# (downstream, upstream, factor): downstream must not exceed upstream x factor.
STAGE_FACTORS = (
    ("settled_turbidity_ntu", "raw_turbidity_ntu", 1.10),
    ("filtered_turbidity_ntu", "settled_turbidity_ntu", 1.20),
    ("final_turbidity_ntu", "filtered_turbidity_ntu", 1.20),
)
MAX_PH_SHIFT = 1.5
MIN_HEAD_LOSS = 0.2

# Safe band of the treated water's pH.
PH_SAFE = (6.5, 8.5)

# Defaults of the time-dependent operators.
FRESHNESS_MINUTES = 20
LOOKBACK_HOURS = 24
WATERMARK_DELAY = "10 minutes"
