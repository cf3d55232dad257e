"""From raw events to scored readings. Every step works on batch and streaming frames
alike except `dedup_readings`, whose streaming twin is in `hydrolens.streaming`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolens import schema as S
from hydrolens.functions import quality, scoring
from hydrolens.functions.common import date_key, time_key
from hydrolens.operators.latest import first_per_key

READING_KEY = ["station_id", "sensor_id", "event_timestamp"]


def decode_events(raw: DataFrame) -> DataFrame:
    """One JSON document per `value` → the 22 event columns; a bad document gives nulls."""
    text = F.col("value").cast("string")
    return raw.select(F.from_json(text, S.EVENT_SCHEMA).alias("data")).select("data.*")


def require_ids(events: DataFrame) -> DataFrame:
    return events.dropna(subset=["reading_id", "station_id", "sensor_id", "timestamp"])


def parse_event_time(events: DataFrame) -> DataFrame:
    """Adds event_timestamp; text that is no timestamp gives null."""
    return events.withColumn("event_timestamp", F.try_to_timestamp(F.col("timestamp")))


def warehouse_rows(events: DataFrame) -> DataFrame:
    """Rows that may enter the facts. Applied before scoring, so that rows bound to be
    dropped are neither scored nor kept in the de-duplication state."""
    return events.filter(
        "event_timestamp is not null and station_id is not null and sensor_id is not null"
    )


def dedup_readings(readings: DataFrame) -> DataFrame:
    """One reading per station, sensor and event time; the smallest reading_id survives."""
    return first_per_key(readings, READING_KEY, [F.col("reading_id").asc()])


def enrich(events: DataFrame, stations: DataFrame, sensors: DataFrame) -> DataFrame:
    """Left joins to both dimensions. Copies of dimension attributes that events carry are
    dropped first, so each name stays unique. The dimensions are joined by hash when their
    size is under spark.sql.autoBroadcastJoinThreshold and by sort-merge beyond it."""
    station_columns = [
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
    sensor_columns = ["sensor_id", "sensor_stage", "sensor_type", "sensor_status"]
    own = events.drop("water_source_type", "station_category")
    return own.join(stations.select(station_columns), "station_id", "left").join(
        sensors.select(sensor_columns), "sensor_id", "left"
    )


def validate(readings: DataFrame) -> DataFrame:
    return readings.selectExpr(
        "*",
        f"{quality.quality_flag()} as quality_flag",
        f"{quality.anomaly_flag()} as anomaly_flag",
        f"{quality.turbidity_removal_pct()} as turbidity_removal_pct",
        f"{quality.chlorine_compliance_flag()} as chlorine_compliance_flag",
        f"{quality.backwash_needed_flag()} as filter_backwash_needed_flag",
    )


def with_index(readings: DataFrame) -> DataFrame:
    """Adds the two scores and the class that the reading fact does not store."""
    return readings.selectExpr(
        "*",
        f"{scoring.process_performance()} as process_performance_score",
        f"{scoring.wqi_score()} as wqi_score",
    ).selectExpr("*", f"{scoring.wqi_class()} as wqi_class")


def score(validated: DataFrame) -> DataFrame:
    return with_index(
        validated.selectExpr(
            "*",
            f"{scoring.contamination_risk()} as contamination_risk_score",
            f"{scoring.regrowth_risk()} as bacterial_regrowth_risk_score",
            f"{quality.breach_flag()} as breach_flag",
            f"{date_key('event_timestamp')} as event_date_key",
            f"{time_key('event_timestamp')} as event_time_key",
            "to_date(event_timestamp) as event_date",
        ).selectExpr("*", f"{quality.severity_level()} as severity_level")
    )


def score_readings(readings: DataFrame) -> DataFrame:
    """Readings with event_timestamp → validated and scored readings. Narrow: no shuffle."""
    return score(validate(warehouse_rows(readings)))
