"""The four fact tables, as projections of the scored readings.

Every fact carries event_date, the partition column of the stored tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolens import schema as S
from hydrolens.functions import scoring
from hydrolens.functions.common import date_key, flag, time_key
from hydrolens.functions.quality import breached_parameter_count, is_business_row
from hydrolens.operators import alerts as A

EVENT_COLUMNS = ["station_id", "sensor_id", "event_timestamp", "event_date_key", "event_time_key"]

READING_COLUMNS = [
    "reading_id",
    *EVENT_COLUMNS,
    *S.MEASURES,
    "turbidity_removal_pct",
    "chlorine_compliance_flag",
    "filter_backwash_needed_flag",
    "contamination_risk_score",
    "bacterial_regrowth_risk_score",
    "quality_flag",
    "anomaly_flag",
    "breach_flag",
    "severity_level",
    "event_date",
]

WQI_COLUMNS = [
    "reading_id",  # not shown by the marts; makes "newest" unambiguous
    "station_id",
    "event_timestamp",
    "event_date_key",
    "event_time_key",
    "wqi_score",
    "wqi_class",
    "process_performance_score",
    "contamination_risk_score",
    "bacterial_regrowth_risk_score",
    "event_date",
]

HEALTH_COLUMNS = [
    *EVENT_COLUMNS,
    "uptime_percentage",
    "missing_readings_count",
    "duplicate_readings_count",
    "anomaly_count",
    "stale_signal_flag",
    "drift_risk_flag",
    "health_status",
    "event_date",
]

ALERT_COLUMNS = [
    "alert_id",
    *EVENT_COLUMNS,
    "alert_type",
    "parameter_code",
    "stage_name",
    "severity_level",
    "measured_value",
    "threshold_min",
    "threshold_max",
    "alert_message",
    "status",
    "event_date",
]

# Fixed value: number of parameters the index is said to use.
PARAMETERS_USED = 9
PARTIAL = "quality_flag = 'partial'"


@dataclass(frozen=True)
class Facts:
    stations: DataFrame
    readings: DataFrame
    wqi: DataFrame
    health: DataFrame
    alerts: DataFrame


def business_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(is_business_row())


def fact_sensor_reading(scored: DataFrame) -> DataFrame:
    return scored.select(READING_COLUMNS)


def fact_water_quality_index(scored: DataFrame) -> DataFrame:
    return business_rows(scored).selectExpr(
        *WQI_COLUMNS,
        f"{PARAMETERS_USED} as num_parameters_used",
        f"{breached_parameter_count()} as num_breached_parameters",
    )


def with_health(scored: DataFrame) -> DataFrame:
    """Adds uptime, counters, flags and status of the sensor for each reading."""
    return scored.selectExpr(
        "*",
        f"{scoring.uptime_percentage()} as uptime_percentage",
        f"{flag(PARTIAL)} as missing_readings_count",
        "0 as duplicate_readings_count",
        "anomaly_flag as anomaly_count",
        "0 as stale_signal_flag",
        f"{scoring.drift_risk_flag()} as drift_risk_flag",
    ).selectExpr("*", f"{scoring.health_status()} as health_status")


def fact_sensor_health(scored: DataFrame) -> DataFrame:
    return with_health(scored).select(HEALTH_COLUMNS)


def with_daily_batches(business: DataFrame) -> DataFrame:
    """Batch mode: one alert batch per event date."""
    return business.withColumn("batch", F.col("event_date"))


def alert_rows(state: DataFrame) -> DataFrame:
    """The alert fact from alerts with a status."""
    return (
        A.describe_alerts(state)
        .selectExpr(
            "*",
            f"{A.ALERT_ID} as alert_id",
            f"{date_key('event_timestamp')} as event_date_key",
            f"{time_key('event_timestamp')} as event_time_key",
        )
        .withColumn("event_date", F.to_date("event_timestamp"))
        .select(ALERT_COLUMNS)
    )


def fact_alert(log: DataFrame, clears: DataFrame) -> DataFrame:
    return alert_rows(A.alert_lifecycle(log, clears))


def daily_fact_alert(scored: DataFrame) -> DataFrame:
    """Alert fact of a whole history, replayed in daily batches."""
    business = with_daily_batches(business_rows(scored))
    return fact_alert(A.alert_log(business), A.last_clears(A.heartbeat_log(business)))
