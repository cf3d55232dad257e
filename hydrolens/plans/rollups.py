"""Aggregates below the marts.

All of them group raw rows once, at the sensor, station or hour grain, with map-side partial
aggregation. Dimensions are joined to these rollups only, never to raw rows, so a hot station
is collapsed before anything is joined or shuffled by governorate. Distinct counts are done
by grouping on the counted key first; averages keep exact decimal sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrolens import schema as S
from hydrolens.functions.common import (
    average_of_totals,
    combined_average,
    exact_avg,
    exact_totals,
    hours_before,
)
from hydrolens.functions.quality import PH_OUT_OF_BAND
from hydrolens.functions.scoring import data_quality_points
from hydrolens.operators.alerts import PROCESS_TYPES, WATER_TYPES
from hydrolens.operators.latest import first_per_key

SENSOR_DAY = ["summary_date", "station_id", "sensor_id"]
STATION_DAY = ["summary_date", "station_id"]


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def by_day(fact: DataFrame) -> DataFrame:
    return fact.withColumnRenamed("event_date", "summary_date")


def recent(fact: DataFrame, as_of: dt.datetime | str, hours: int) -> DataFrame:
    """Rows of the last hours. The event_date bound prunes partitions of stored facts."""
    start = hours_before(as_of, hours)
    return fact.filter(f"event_date >= to_date({start}) and event_timestamp >= {start}")


# --- station grain, current state ---------------------------------------------
def latest_wqi(wqi: DataFrame, keys: Sequence[str] = ("station_id",)) -> DataFrame:
    """Newest index row per key. With the date in the key, the result can be reduced further
    by the same function."""
    newest = [F.col("event_timestamp").desc(), F.col("reading_id").asc()]
    return first_per_key(
        wqi.select(
            *keys,
            "event_timestamp",
            "reading_id",
            "wqi_score",
            "wqi_class",
            "contamination_risk_score",
            "bacterial_regrowth_risk_score",
        ),
        keys,
        newest,
    )


def latest_reading(readings: DataFrame, keys: Sequence[str] = ("station_id",)) -> DataFrame:
    ts = F.col("event_timestamp")
    return readings.groupBy(*keys).agg(
        F.max(ts).alias("latest_reading_timestamp"),
        F.max(F.when(_is("quality_flag", "valid"), ts)).alias("latest_valid_reading_timestamp"),
    )


def recent_quality(readings: DataFrame, as_of: dt.datetime | str, hours: int) -> DataFrame:
    return (
        recent(readings, as_of, hours)
        .groupBy("station_id")
        .agg(
            F.count_if(_is("quality_flag", "invalid")).alias("invalid_count"),
            F.count_if(_is("quality_flag", "partial")).alias("partial_count"),
            F.count_if(_is("quality_flag", "suspicious")).alias("suspicious_count"),
            F.count_if(_is("quality_flag", "valid")).alias("valid_count"),
            F.count_if(F.col("anomaly_flag") == 1).alias("anomaly_count"),
        )
    )


def recent_health(health: DataFrame, as_of: dt.datetime | str, hours: int) -> DataFrame:
    return (
        recent(health, as_of, hours)
        .groupBy("station_id")
        .agg(
            exact_avg("coalesce(uptime_percentage, 0.0D)").alias("avg_uptime"),
            F.count_if(_is("health_status", "critical")).alias("critical_health_samples"),
            F.count_if(_is("health_status", "degraded")).alias("degraded_health_samples"),
            F.count_if(F.col("drift_risk_flag") == 1).alias("drift_risk_count"),
            F.count_if(F.col("stale_signal_flag") == 1).alias("stale_signal_count"),
            F.sum("anomaly_count").alias("anomaly_events"),
        )
    )


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(_is("status", "open"))


def active_alerts(alerts: DataFrame) -> DataFrame:
    """Open incidents (distinct type and stage) and open rows by severity and group.

    The distinct count is exact without a distinct: rows are first grouped by incident.
    """
    incidents = (
        open_alerts(alerts)
        .groupBy("station_id", "alert_type", F.coalesce("stage_name", F.lit("")).alias("stage_name"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(_is("severity_level", "critical")).alias("critical"),
            F.count_if(_is("severity_level", "warning")).alias("warning"),
        )
    )
    water = F.col("alert_type").isin(*WATER_TYPES)
    process = F.col("alert_type").isin(*PROCESS_TYPES)

    def total(column: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    return incidents.groupBy("station_id").agg(
        F.count("*").alias("active_alert_count"),
        F.sum("critical").alias("critical_open_alert_count"),
        F.sum("warning").alias("warning_open_alert_count"),
        total("n", water).alias("active_water_alert_count"),
        total("critical", water).alias("critical_water_alert_count"),
        total("warning", water).alias("warning_water_alert_count"),
        total("n", process).alias("active_process_alert_count"),
        total("critical", process).alias("critical_process_alert_count"),
        total("warning", process).alias("warning_process_alert_count"),
    )


def top_open_alert(alerts: DataFrame) -> DataFrame:
    """Per station the open alert to show: critical first, then newest, then by type."""
    columns = [
        "station_id",
        "alert_id",
        "event_timestamp",
        "alert_type",
        "severity_level",
        "parameter_code",
        "stage_name",
        "measured_value",
        "alert_message",
    ]
    return first_per_key(
        open_alerts(alerts).select(columns),
        ["station_id"],
        [
            _is("severity_level", "critical").desc(),
            F.col("event_timestamp").desc(),
            F.col("alert_type").asc(),
            F.col("alert_id").asc(),
        ],
    )


# --- sensor and station days -----------------------------------------------------
def reading_quality_daily(readings: DataFrame) -> DataFrame:
    return (
        by_day(readings)
        .groupBy(SENSOR_DAY)
        .agg(
            F.count("*").alias("total_readings_count"),
            *[
                F.count_if(_is("quality_flag", name)).alias(f"{name}_readings_count")
                for name in S.QUALITY_FLAGS
            ],
        )
    )


def sensor_health_daily(health: DataFrame) -> DataFrame:
    return (
        by_day(health)
        .groupBy(SENSOR_DAY)
        .agg(
            F.sum("duplicate_readings_count").alias("duplicate_readings_count"),
            F.sum("anomaly_count").alias("anomaly_count"),
            F.count_if(F.col("stale_signal_flag") == 1).alias("stale_signal_flag_count"),
            F.count_if(F.col("drift_risk_flag") == 1).alias("drift_risk_flag_count"),
            F.avg(F.expr(data_quality_points())).alias("data_quality_score"),
        )
    )


# Score columns of the index fact and the names their averages get.
WQI_AVERAGES = {
    "wqi_score": "avg_wqi",
    "contamination_risk_score": "avg_contamination_risk",
    "bacterial_regrowth_risk_score": "avg_bacterial_risk",
}


def wqi_totals_daily(wqi: DataFrame) -> DataFrame:
    """Sums and counts per station and day; they can be added up to any coarser grain."""
    totals = []
    for column in WQI_AVERAGES:
        totals += exact_totals(column)
    return (
        by_day(wqi)
        .groupBy(STATION_DAY)
        .agg(
            *totals,
            F.min("wqi_score").alias("min_wqi"),
            F.max("wqi_score").alias("max_wqi"),
            F.count_if(_is("wqi_class", "Unsafe")).alias("unsafe_events"),
            F.count_if(_is("wqi_class", "Watch")).alias("watch_events"),
        )
    )


def combined_wqi_averages() -> list[Column]:
    """Averages over a group of daily totals."""
    return [combined_average(column).alias(name) for column, name in WQI_AVERAGES.items()]


def station_wqi_daily(totals: DataFrame) -> DataFrame:
    avg_wqi, *risks = [
        average_of_totals(column).alias(name) for column, name in WQI_AVERAGES.items()
    ]
    return totals.select(*STATION_DAY, avg_wqi, "min_wqi", "max_wqi", *risks)


def station_alert_daily(alerts: DataFrame) -> DataFrame:
    return (
        by_day(alerts)
        .groupBy(STATION_DAY)
        .agg(
            F.count("*").alias("alert_count"),
            F.count_if(_is("severity_level", "critical")).alias("critical_alert_count"),
        )
    )


def station_dq_daily(data_quality: DataFrame) -> DataFrame:
    return data_quality.groupBy(STATION_DAY).agg(
        exact_avg("data_quality_score").alias("avg_data_quality_score"),
        F.sum("suspicious_readings_count").alias("suspicious_readings_count"),
        F.sum("invalid_readings_count").alias("invalid_readings_count"),
        F.sum("partial_readings_count").alias("partial_readings_count"),
    )


# --- governorate grain -------------------------------------------------------------
def governorates(stations: DataFrame) -> DataFrame:
    return stations.select("station_id", "governorate")


def alert_daily_governorate(alerts: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct incidents per day, critical incidents, and stations with any."""
    incidents = (
        by_day(alerts)
        .groupBy(*STATION_DAY, "alert_type", F.coalesce("stage_name", F.lit("")).alias("stage_name"))
        .agg(F.max(F.when(_is("severity_level", "critical"), 1).otherwise(0)).alias("critical"))
    )
    per_station = incidents.groupBy(STATION_DAY).agg(
        F.count("*").alias("incidents"), F.sum("critical").alias("critical")
    )
    return (
        per_station.join(governorates(stations), "station_id")
        .groupBy(F.col("summary_date").alias("alert_date"), "governorate")
        .agg(
            F.sum("incidents").alias("alert_count"),
            F.sum("critical").alias("critical_alert_count"),
            F.count("*").alias("affected_stations_count"),
        )
    )


def governorate_status_mix(station_status: DataFrame) -> DataFrame:
    return station_status.groupBy("governorate").agg(
        *[
            F.count_if(_is("overall_status_color", color)).alias(f"current_{color}_station_count")
            for color in S.STATUS_COLORS
        ]
    )


def governorate_dq_daily(data_quality: DataFrame) -> DataFrame:
    return data_quality.groupBy("summary_date", "governorate").agg(
        exact_avg("data_quality_score").alias("avg_data_quality_score")
    )


def governorate_wqi_daily(totals: DataFrame, stations: DataFrame) -> DataFrame:
    avg_wqi, *risks = combined_wqi_averages()
    return (
        totals.join(governorates(stations), "station_id")
        .groupBy("summary_date", "governorate")
        .agg(
            F.count("*").alias("stations_count"),
            avg_wqi,
            F.min("min_wqi").alias("min_wqi"),
            F.max("max_wqi").alias("max_wqi"),
            *risks,
        )
    )


# Trend parameters, their measure and what counts as a breach.
TREND_PARAMETERS = {
    "Raw Turbidity": ("raw_turbidity_ntu", "raw_turbidity_ntu > 50"),
    "Filtered Turbidity": ("filtered_turbidity_ntu", "filtered_turbidity_ntu > 0.5D"),
    "Final Turbidity": ("final_turbidity_ntu", "final_turbidity_ntu > 0.5D"),
    "Final Residual Chlorine": (
        "final_residual_chlorine_mg_l",
        "final_residual_chlorine_mg_l < 0.2D or final_residual_chlorine_mg_l > 1.0D",
    ),
    "Final pH": ("final_ph", PH_OUT_OF_BAND),
}


def parameter_hourly(readings: DataFrame) -> DataFrame:
    """One row per date, hour and station, with the totals of all five parameters: a single
    pass over the valid readings."""
    totals = []
    for measure, breach in TREND_PARAMETERS.values():
        value = F.col(measure)
        totals += [
            *exact_totals(measure),
            F.min(value).alias(f"min_{measure}"),
            F.max(value).alias(f"max_{measure}"),
            F.count_if(F.expr(breach)).alias(f"breach_{measure}"),
        ]
    return (
        readings.filter(_is("quality_flag", "valid"))
        .groupBy(
            F.col("event_date").alias("trend_date"),
            F.hour("event_timestamp").alias("time_bucket_hour"),
            "station_id",
        )
        .agg(*totals)
    )


def parameter_trend(hourly: DataFrame, stations: DataFrame) -> DataFrame:
    """Hourly totals → one row per date, hour, governorate and parameter."""
    keys = ["trend_date", "time_bucket_hour", "governorate"]
    combined = []
    for measure, _ in TREND_PARAMETERS.values():
        combined += [
            combined_average(measure).alias(f"avg_{measure}"),
            F.min(f"min_{measure}").alias(f"min_{measure}"),
            F.max(f"max_{measure}").alias(f"max_{measure}"),
            F.sum(f"breach_{measure}").alias(f"breach_{measure}"),
        ]
    wide = hourly.join(governorates(stations), "station_id").groupBy(keys).agg(*combined)
    long_rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("parameter_name"),
                F.col(f"avg_{measure}").alias("avg_value"),
                F.col(f"min_{measure}").alias("min_value"),
                F.col(f"max_{measure}").alias("max_value"),
                F.col(f"breach_{measure}").alias("breach_count"),
            )
            for name, (measure, _) in TREND_PARAMETERS.items()
        ]
    )
    return wide.select(*keys, F.inline(long_rows))


# --- national grain ----------------------------------------------------------------
def national_reading_daily(quality_daily: DataFrame) -> DataFrame:
    per_station = quality_daily.groupBy(STATION_DAY).agg(
        F.sum("total_readings_count").alias("total"),
        *[F.sum(f"{name}_readings_count").alias(name) for name in S.QUALITY_FLAGS],
    )
    return per_station.groupBy("summary_date").agg(
        F.sum("total").alias("total_readings"),
        *[F.sum(name).alias(f"{name}_readings") for name in S.QUALITY_FLAGS],
        F.count("*").alias("stations_reporting_count"),
    )


def national_alert_daily(alerts: DataFrame) -> DataFrame:
    return (
        by_day(alerts)
        .groupBy("summary_date")
        .agg(
            F.count_if(_is("status", "resolved")).alias("resolved_alert_count"),
            F.count_if(_is("severity_level", "critical")).alias("critical_alert_events"),
        )
    )


def national_wqi_daily(totals: DataFrame) -> DataFrame:
    return totals.groupBy("summary_date").agg(
        combined_average("wqi_score").alias("avg_wqi"),
        F.sum("unsafe_events").alias("unsafe_station_events"),
        F.sum("watch_events").alias("watch_station_events"),
    )


def national_dq_daily(data_quality: DataFrame) -> DataFrame:
    return data_quality.groupBy("summary_date").agg(
        exact_avg("data_quality_score").alias("avg_data_quality_score"),
        F.sum("duplicate_readings_count").alias("duplicate_readings_count"),
    )


def current_station_status(station_status: DataFrame) -> DataFrame:
    """One row. active_station_count counts every station, whatever its status."""
    return station_status.agg(
        F.count("*").alias("active_station_count"),
        *[
            F.count_if(_is("overall_status_color", color)).alias(f"{color}_station_count")
            for color in ("gray", "red", "orange", "yellow", "green")
        ],
    )


def open_alert_count(alerts: DataFrame) -> DataFrame:
    return open_alerts(alerts).agg(F.count("*").alias("open_alert_count"))
