"""Dimension tables: CSV scan and export, calendar, clock, parameters, rules, KPIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens import schema as S
from hydrolens.functions.common import date_key, week_of_year_sunday
from hydrolens.sources.parts import Dimension

STATION_SCAN = [
    "station_id",
    "station_name",
    "governorate",
    "city",
    "latitude",
    "longitude",
    "water_source_type",
    "station_category",
    "plant_capacity_m3_day",
    "operational_status",
]
SENSOR_SCAN = ["sensor_id", "station_id", "sensor_stage", "sensor_type", "sensor_status"]


# --- CSV and Parquet -------------------------------------------------------------------
def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a given schema; a byte-order mark at the start is skipped."""
    return spark.read.csv(path, header=True, schema=schema)


def scan_stations(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, S.STATION_SCHEMA).select(STATION_SCAN)


def scan_sensors(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, S.SENSOR_SCHEMA).select(SENSOR_SCAN)


def scan_parameters(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, PARAMETER_SCHEMA)


def scan_threshold_rules(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, RULE_SCHEMA)


def export_csv(df: DataFrame, path: str) -> None:
    """UTF-8 CSV with a header that starts with a byte-order mark, one per part file."""
    first, *others = df.columns
    marked = df.withColumnRenamed(first, "﻿" + first) if first[:1] != "﻿" else df
    marked.write.mode("overwrite").csv(path, header=True)


def reload_dimension(df: DataFrame, path: str) -> DataFrame:
    """Replaces the stored dimension and reads it back. Readers see the old rows until all new ones are stored."""
    return Dimension(df.sparkSession, path, df.schema).reload(df)


# --- calendar and clock -------------------------------------------------------------------
# Span of the stored calendar.
CALENDAR_START, CALENDAR_END = dt.date(2025, 1, 1), dt.date(2027, 12, 31)


CALENDAR_COLUMNS = (
    f"{date_key('d')} as date_key",
    "d as full_date",
    "day(d) as day_number",
    "month(d) as month_number",
    "date_format(d, 'MMMM') as month_name",
    "quarter(d) as quarter_number",
    "year(d) as year_number",
    f"{week_of_year_sunday('d')} as week_of_year",
    "date_format(d, 'EEEE') as day_name",
    "cast(date_format(d, 'EEEE') in ('Friday', 'Saturday') as int) as is_weekend",
)


def dim_date(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    span = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(span).alias("d")).selectExpr(*CALENDAR_COLUMNS)


def dim_date_spanning(df: DataFrame, date_column: str) -> DataFrame:
    """The calendar from the first to the last date of a table."""
    bounds = df.agg(F.min(date_column).alias("a"), F.max(date_column).alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("d"))
    return days.selectExpr(*CALENDAR_COLUMNS)


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    seconds = F.col("id").cast("int")
    parts = spark.range(86400).select(
        F.expr("cast(id div 3600 as int)").alias("hour_number"),
        F.expr("cast(id div 60 % 60 as int)").alias("minute_number"),
        (seconds % 60).alias("second_number"),
    )

    def two(column: str) -> Column:
        return F.lpad(F.col(column).cast("string"), 2, "0")

    hour, minute, second = two("hour_number"), two("minute_number"), two("second_number")
    quarter = F.expr("lpad(cast(minute_number div 15 * 15 as string), 2, '0')")
    return parts.select(
        (F.col("hour_number") * 10000 + F.col("minute_number") * 100 + F.col("second_number")).alias(
            "time_key"
        ),
        F.concat_ws(":", hour, minute, second).alias("full_time"),
        "hour_number",
        "minute_number",
        "second_number",
        quarter.alias("quarter_hour_bucket"),
        F.concat(hour, F.lit(":00")).alias("hour_bucket"),
    )


# --- parameters, rules, KPIs ------------------------------------------------------------
PARAMETER_SCHEMA = T.StructType(
    [
        T.StructField("parameter_code", T.StringType()),
        T.StructField("parameter_name", T.StringType()),
        T.StructField("parameter_category", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stage_name", T.StringType()),
        T.StructField("is_online", T.IntegerType()),
    ]
)

# Measured and derived parameters.
PARAMETERS = [
    ("raw_turbidity_ntu", "Raw Water Turbidity", "physical", "NTU", "Turbidity of incoming untreated water at raw water intake.", "raw_intake", 1),
    ("raw_ph", "Raw Water pH", "chemical", "pH", "pH at raw water intake before coagulation and treatment.", "raw_intake", 1),
    ("raw_conductivity_us_cm", "Raw Water Conductivity", "chemical", "uS/cm", "Electrical conductivity of raw water indicating dissolved salts.", "raw_intake", 1),
    ("raw_temperature_c", "Raw Water Temperature", "physical", "C", "Raw water temperature affecting process kinetics and disinfection.", "raw_intake", 1),
    ("raw_ammonia_mg_l", "Raw Water Ammonia", "chemical", "mg/L", "Ammonia concentration in raw water as a contamination indicator.", "raw_intake", 1),
    ("raw_alkalinity_mg_l", "Raw Water Alkalinity", "chemical", "mg/L as CaCO3", "Alkalinity of raw water important for coagulation performance.", "raw_intake", 1),
    ("settled_turbidity_ntu", "Settled Water Turbidity", "physical", "NTU", "Turbidity after sedimentation and clarification.", "sedimentation_outlet", 1),
    ("sludge_blanket_level_m", "Sludge Blanket Level", "operational", "m", "Estimated sludge blanket level inside sedimentation basin.", "sedimentation_outlet", 1),
    ("estimated_settling_efficiency_pct", "Estimated Settling Efficiency", "derived", "%", "Estimated sedimentation removal efficiency based on inlet/outlet turbidity.", "sedimentation_outlet", 1),
    ("filtered_turbidity_ntu", "Filtered Water Turbidity", "physical", "NTU", "Turbidity after filtration stage.", "filtration_outlet", 1),
    ("head_loss_m", "Filter Head Loss", "operational", "m", "Head loss across the filter media indicating clogging load.", "filtration_outlet", 1),
    ("filtration_rate_m_h", "Filtration Rate", "operational", "m/h", "Filtration rate through filter bed.", "filtration_outlet", 1),
    ("final_residual_chlorine_mg_l", "Final Residual Chlorine", "chemical", "mg/L", "Free residual chlorine at final outlet before distribution.", "final_outlet", 1),
    ("final_ph", "Final Water pH", "chemical", "pH", "Final treated water pH at plant outlet.", "final_outlet", 1),
    ("final_turbidity_ntu", "Final Water Turbidity", "physical", "NTU", "Final treated water turbidity at outlet.", "final_outlet", 1),
    ("turbidity_removal_pct", "Overall Turbidity Removal", "derived", "%", "Estimated overall turbidity removal from raw intake to final outlet.", "derived", 1),
    ("contamination_risk_score", "Contamination Risk Score", "derived", "score", "Composite score indicating chemical/physical process risk.", "derived", 1),
    ("bacterial_regrowth_risk_score", "Bacterial Regrowth Risk Score", "derived", "score", "Proxy score for microbial regrowth risk based on chlorine, turbidity, temperature, pH, and ammonia.", "derived", 1),
    ("process_performance_score", "Treatment Process Performance Score", "derived", "score", "Composite score reflecting treatment stage effectiveness.", "derived", 1),
]

RULE_SCHEMA = T.StructType(
    [
        T.StructField("parameter_code", T.StringType()),
        T.StructField("stage_name", T.StringType()),
        T.StructField("water_type", T.StringType()),
        *[
            T.StructField(f"{level}_{bound}", T.DoubleType())
            for level in ("safe", "warning", "critical")
            for bound in ("min", "max")
        ],
        T.StructField("rule_weight", T.DoubleType()),
        T.StructField("effective_from", T.DateType()),
        T.StructField("effective_to", T.DateType()),
        T.StructField("rule_source", T.StringType()),
    ]
)

# Safe, warning and critical range and weight of each parameter, and the rule
# set it belongs to.
THRESHOLD_RULES = [
    ("raw_turbidity_ntu", "raw_intake", 0.0, 50.0, 50.0, 150.0, 150.0, 1000.0, 0.12, "Operational Reference Rules"),
    ("raw_ph", "raw_intake", 6.8, 8.2, 6.5, 8.5, 0.0, 14.0, 0.08, "Operational Reference Rules"),
    ("raw_conductivity_us_cm", "raw_intake", 100.0, 1200.0, 1200.0, 1800.0, 1800.0, 6000.0, 0.05, "Operational Reference Rules"),
    ("raw_temperature_c", "raw_intake", 10.0, 30.0, 30.0, 35.0, 35.0, 50.0, 0.05, "Operational Reference Rules"),
    ("raw_ammonia_mg_l", "raw_intake", 0.0, 0.3, 0.3, 0.6, 0.6, 5.0, 0.12, "Operational Reference Rules"),
    ("raw_alkalinity_mg_l", "raw_intake", 40.0, 180.0, 20.0, 220.0, 0.0, 500.0, 0.06, "Operational Reference Rules"),
    ("settled_turbidity_ntu", "sedimentation_outlet", 0.0, 10.0, 10.0, 20.0, 20.0, 200.0, 0.1, "Operational Reference Rules"),
    ("sludge_blanket_level_m", "sedimentation_outlet", 0.0, 1.5, 1.5, 2.5, 2.5, 6.0, 0.06, "Operational Reference Rules"),
    ("estimated_settling_efficiency_pct", "sedimentation_outlet", 70.0, 100.0, 50.0, 70.0, 0.0, 50.0, 0.08, "Operational Reference Rules"),
    ("filtered_turbidity_ntu", "filtration_outlet", 0.0, 0.3, 0.3, 1.0, 1.0, 50.0, 0.12, "Operational Reference Rules"),
    ("head_loss_m", "filtration_outlet", 0.2, 2.0, 2.0, 2.8, 2.8, 6.0, 0.08, "Operational Reference Rules"),
    ("filtration_rate_m_h", "filtration_outlet", 4.0, 9.0, 9.0, 12.0, 12.0, 20.0, 0.06, "Operational Reference Rules"),
    ("final_residual_chlorine_mg_l", "final_outlet", 0.2, 1.0, 0.1, 1.5, 0.0, 3.0, 0.16, "Drinking Water Safety Rules"),
    ("final_ph", "final_outlet", 6.5, 8.5, 6.2, 8.8, 0.0, 14.0, 0.1, "Drinking Water Safety Rules"),
    ("final_turbidity_ntu", "final_outlet", 0.0, 0.3, 0.3, 1.0, 1.0, 10.0, 0.16, "Drinking Water Safety Rules"),
    ("turbidity_removal_pct", "derived", 95.0, 100.0, 85.0, 95.0, 0.0, 85.0, 0.1, "Derived Analytics Rules"),
    ("contamination_risk_score", "derived", 0.0, 30.0, 30.0, 60.0, 60.0, 100.0, 0.2, "Derived Analytics Rules"),
    ("bacterial_regrowth_risk_score", "derived", 0.0, 30.0, 30.0, 60.0, 60.0, 100.0, 0.2, "Derived Analytics Rules"),
    ("process_performance_score", "derived", 80.0, 100.0, 60.0, 80.0, 0.0, 60.0, 0.2, "Derived Analytics Rules"),
]
# From when the rules hold, and for what water.
RULES_EFFECTIVE_FROM = dt.date(2026, 5, 9)
RULES_WATER_TYPE = "Drinking"

KPI_SCHEMA = (
    "kpi_code string, kpi_name string, kpi_group string, definition string, "
    "source_object string, refresh_grain string, interpretation_hint string"
)

# KPI dictionary.
KPI_DEFINITIONS = [
    ("AVG_WQI", "Average WQI", "Water Quality", "Average Water Quality Index computed from valid treated-water readings only.", "fact_water_quality_index", "event / daily", "Higher is better; 90+ is Excellent."),
    ("OPEN_ALERTS", "Open Alerts", "Operational Risk", "Current unresolved alert incidents only. Repeated alert occurrences are merged into a single open incident per station, type and stage.", "fact_alert", "current", "Represents active operational or water-quality issues requiring attention."),
    ("CRITICAL_STATIONS", "Critical Stations", "Operational Risk", "Stations whose overall status is red because of Unsafe WQI, critical water-safety alert, or severe operational state.", "mart_station_latest_status", "current", "Represents stations that need urgent action."),
    ("VALID_READING_PCT", "Valid Reading %", "Data Trust", "Percentage of fact_sensor_reading rows classified as valid over total readings.", "mart_system_readiness_summary", "daily", "Higher is better; low values indicate poor telemetry trust."),
    ("DATA_QUALITY_SCORE", "Data Quality Score", "Data Trust", "Average score derived from sensor health state, anomalies, drift risk, and stale/duplicate indicators.", "mart_data_quality_monitor", "daily / sensor", "90+ Trusted, 75-89 Monitor, <75 At Risk."),
    ("OVERALL_STATUS", "Overall Station Status", "Decision Support", "Worst-case explainable status derived from separate water-quality and operational status layers.", "mart_station_latest_status", "current", "Used for map colors and triage queues."),
    ("WATER_STATUS", "Water Quality Status", "Decision Support", "Status derived from WQI and water-safety alerts affecting the final water delivered.", "mart_station_latest_status", "current", "Separates outcome quality from process condition."),
    ("OPS_STATUS", "Operational Status", "Decision Support", "Status derived from process alerts, telemetry freshness, and sensor-health evidence.", "mart_station_latest_status", "current", "Highlights operational risk before water quality degrades."),
]


def dim_parameter(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARAMETERS, PARAMETER_SCHEMA)


def dim_threshold_rule(spark: SparkSession) -> DataFrame:
    rows = [
        (code, stage, RULES_WATER_TYPE, *limits, weight, RULES_EFFECTIVE_FROM, None, source)
        for code, stage, *limits, weight, source in THRESHOLD_RULES
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def kpi_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KPI_DEFINITIONS, KPI_SCHEMA)
