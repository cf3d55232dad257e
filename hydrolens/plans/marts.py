"""The seven marts. Each is a pure function of facts, rollups and other marts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolens import schema as S
from hydrolens.functions import ladders
from hydrolens.functions.common import average_of_totals, minutes_between, moment
from hydrolens.functions.scoring import data_quality_band
from hydrolens.operators.alerts import ALERT_DOMAIN
from hydrolens.plans import rollups as R
from hydrolens.plans.records import station_wqi


@dataclass(frozen=True)
class Clock:
    """What "now" is and how far back the time-dependent operators look."""

    as_of: dt.datetime | str
    freshness_minutes: int = S.FRESHNESS_MINUTES
    lookback_hours: int = S.LOOKBACK_HOURS


def _or_zero(name: str) -> str:
    return f"coalesce({name}, 0) as {name}"


# --- latest status per station ------------------------------------------------------
def station_status_base(
    stations: DataFrame,
    newest_wqi: DataFrame,
    newest_reading: DataFrame,
    recent: DataFrame,
    active: DataFrame,
    top_alert: DataFrame,
    clock: Clock,
) -> DataFrame:
    """Every station with its one-row-per-station evidence, stations without any included."""
    wqi = newest_wqi.select(
        "station_id",
        F.col("wqi_score").alias("latest_wqi_score"),
        F.col("wqi_class").alias("latest_wqi_class"),
        F.col("contamination_risk_score").alias("latest_contamination_risk_score"),
        F.col("bacterial_regrowth_risk_score").alias("latest_bacterial_regrowth_risk_score"),
    )
    top = top_alert.select(
        "station_id",
        F.col("parameter_code").alias("dominant_risk_parameter"),
        F.col("alert_type").alias("latest_open_alert_type"),
        F.col("severity_level").alias("latest_open_alert_severity"),
    )
    newest_reading = newest_reading.select("station_id", "latest_reading_timestamp")
    recent = recent.select(
        "station_id",
        "invalid_count",
        "suspicious_count",
        "critical_health_samples",
        "degraded_health_samples",
        "drift_risk_count",
        "anomaly_events",
    )
    active = active.drop("critical_open_alert_count", "warning_open_alert_count")
    base = stations.select(
        "station_id",
        "station_name",
        "governorate",
        "latitude",
        "longitude",
        "water_source_type",
        "plant_capacity_m3_day",
        "operational_status",
    )
    for evidence in (wqi, newest_reading, recent, active, top):
        base = base.join(evidence, "station_id", "left")
    age = minutes_between("latest_reading_timestamp", moment(clock.as_of))
    others = [name for name in base.columns if name not in ladders.STATUS_COUNTS]
    return base.selectExpr(
        *others,
        *[f"coalesce({name}, 0) as {name}" for name in ladders.STATUS_COUNTS],
        f"cast({age} as int) as data_freshness_minutes",
    )


def with_status(base: DataFrame, clock: Clock) -> DataFrame:
    time = (clock.as_of, clock.freshness_minutes)
    return (
        base.selectExpr(
            "*",
            f"{ladders.water_status_color(*time)} as water_quality_status_color",
            f"{ladders.water_status_reason(*time)} as water_quality_status_reason",
            f"{ladders.ops_status_color(*time)} as operational_status_color",
            f"{ladders.ops_status_reason(*time)} as operational_status_reason",
        )
        .selectExpr(
            "*",
            f"{ladders.overall_status_color()} as overall_status_color",
            f"{ladders.overall_status_reason()} as overall_status_reason",
        )
        .selectExpr("*", f"{ladders.status_priority()} as status_priority")
    )


def station_latest_status(base: DataFrame, clock: Clock) -> DataFrame:
    return with_status(base, clock).selectExpr(
        "station_id",
        "station_name",
        "governorate",
        "latitude",
        "longitude",
        "water_source_type",
        "plant_capacity_m3_day",
        f"coalesce(latest_reading_timestamp, {moment(clock.as_of)}) as last_update_time",
        "latest_wqi_score",
        "latest_wqi_class",
        "latest_contamination_risk_score",
        "latest_bacterial_regrowth_risk_score",
        "active_alert_count",
        "active_water_alert_count",
        "active_process_alert_count",
        "dominant_risk_parameter",
        "latest_open_alert_type",
        "latest_open_alert_severity",
        "water_quality_status_color",
        "water_quality_status_reason",
        "operational_status_color",
        "operational_status_reason",
        "overall_status_color",
        "overall_status_reason",
        "overall_status_color as station_status_color",
        "overall_status_reason as station_status_reason",
        "status_priority",
        "data_freshness_minutes",
    )


# --- governorate daily summary ------------------------------------------------------
ALERT_COUNTS = ("alert_count", "critical_alert_count", "affected_stations_count")


def governorate_daily(days: DataFrame, alert_daily: DataFrame) -> DataFrame:
    """What a day's rows alone decide. Days and governorates without an index row have no row."""
    alert_daily = alert_daily.withColumnRenamed("alert_date", "summary_date")
    return days.join(alert_daily, ["summary_date", "governorate"], "left").selectExpr(
        "summary_date",
        "governorate",
        "stations_count",
        "avg_wqi",
        "min_wqi",
        "max_wqi",
        "avg_contamination_risk",
        "avg_bacterial_risk",
        *[_or_zero(name) for name in ALERT_COUNTS],
        "avg_data_quality_score",
    )


def governorate_daily_summary(daily: DataFrame, status_mix: DataFrame) -> DataFrame:
    """The present mix of station colours is the same on every day."""
    mix = [f"current_{color}_station_count" for color in S.STATUS_COLORS]
    return daily.join(status_mix, "governorate", "left").selectExpr(
        *daily.columns,
        *[_or_zero(name) for name in mix],
    )


# --- alert monitor ------------------------------------------------------------------
def alert_monitor(alerts: DataFrame, stations: DataFrame) -> DataFrame:
    named = stations.select("station_id", "station_name", "governorate")
    return alerts.join(named, "station_id").selectExpr(
        "alert_id",
        "station_id",
        "station_name",
        "governorate",
        "event_timestamp",
        "alert_type",
        f"{ALERT_DOMAIN} as alert_domain",
        "parameter_code as parameter_name",
        "stage_name",
        "severity_level",
        "measured_value",
        "alert_message",
        "status",
    )


# --- data-quality monitor -------------------------------------------------------------
def data_quality_monitor(quality: DataFrame, stations: DataFrame) -> DataFrame:
    """Sensor-days. Counts of readings and of health signals come from the same record, so neither
    side can be missing."""
    named = stations.select("station_id", "station_name", "governorate")
    return quality.join(named, "station_id").selectExpr(
        "summary_date",
        "station_id",
        "station_name",
        "governorate",
        "sensor_id",
        "total_readings_count",
        "valid_readings_count",
        "invalid_readings_count",
        "partial_readings_count",
        "duplicate_readings_count",
        "suspicious_readings_count",
        "anomaly_count",
        "stale_signal_flag_count",
        "drift_risk_flag_count",
        "data_quality_score",
        f"{data_quality_band('data_quality_score')} as data_quality_band",
    )


# --- station daily snapshot -----------------------------------------------------------
def station_daily_snapshot(
    station_days: DataFrame, alert_daily: DataFrame, stations: DataFrame
) -> DataFrame:
    """Station-days that have an index."""
    named = stations.select("station_id", "station_name", "governorate")
    joined = (
        station_wqi(station_days)
        .withColumn("avg_data_quality_score", average_of_totals("data_quality_score"))
        .join(alert_daily, R.STATION_DAY, "left")
        .join(named, "station_id")
        .selectExpr(
            "summary_date",
            "station_id",
            "station_name",
            "governorate",
            "avg_wqi",
            "min_wqi",
            "max_wqi",
            "avg_contamination_risk",
            "avg_bacterial_risk",
            _or_zero("alert_count"),
            _or_zero("critical_alert_count"),
            "suspicious_readings_count",
            "invalid_readings_count",
            "partial_readings_count",
            "avg_data_quality_score",
        )
    )
    return joined.selectExpr(
        "*",
        f"{ladders.snapshot_status_color()} as snapshot_status_color",
        f"{ladders.snapshot_status_reason()} as snapshot_status_reason",
    )


# --- system readiness -------------------------------------------------------------------
def percent(part: str, total: str) -> str:
    """Decimal percentage with two places, half up; null when the total is zero."""
    return f"cast(100.0 * {part} / nullif({total}, 0) as decimal(10,2))"


def readiness_daily(days: DataFrame, alert_daily: DataFrame) -> DataFrame:
    """What a day's rows alone decide, and the present status of the day's alerts."""
    return days.join(alert_daily, "summary_date", "left").selectExpr(
        "summary_date",
        "stations_reporting_count",
        "total_readings",
        *[f"{name}_readings" for name in S.QUALITY_FLAGS],
        *[
            f"{percent(f'{name}_readings', 'total_readings')} as {name}_readings_pct"
            for name in ("valid", "suspicious", "invalid")
        ],
        _or_zero("duplicate_readings_count"),
        _or_zero("resolved_alert_count"),
        _or_zero("critical_alert_events"),
        "avg_data_quality_score",
        "avg_wqi",
        "unsafe_station_events",
        "watch_station_events",
    )


def system_readiness_summary(
    daily: DataFrame, station_status: DataFrame, open_alerts: DataFrame
) -> DataFrame:
    """One row per day. The two current-state frames have one row each and repeat on every day."""
    # Both sides are ungrouped aggregates: exactly one row.
    current = F.broadcast(station_status.crossJoin(open_alerts))
    return daily.crossJoin(current).select(
        "summary_date",
        "stations_reporting_count",
        "active_station_count",
        "total_readings",
        "valid_readings",
        "suspicious_readings",
        "partial_readings",
        "invalid_readings",
        "valid_readings_pct",
        "suspicious_readings_pct",
        "invalid_readings_pct",
        "duplicate_readings_count",
        "open_alert_count",
        "resolved_alert_count",
        "critical_alert_events",
        "avg_data_quality_score",
        "avg_wqi",
        "unsafe_station_events",
        "watch_station_events",
        *[f"{color}_station_count" for color in S.STATUS_COLORS],
    )
