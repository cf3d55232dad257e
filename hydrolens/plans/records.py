"""Mergeable partial aggregates below the marts.

Two records hold all that the marts need of the readings: counters, sums, smallest and largest values
per sensor and day, and per station and hour. Both come from one pass each over the reading fact, as
hash aggregates over fixed-width values with map-side combining. Records of different batches of the
same key are merged by adding, or by taking the smaller or larger value, so a day is kept up to date
from its record and the new batches' records; its readings are not read again.

Coarser grains are folded from finer ones: sensor-day, station-day, then governorate-day or day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolens import schema as S
from hydrolens.functions.common import added, average_of_totals, combined_average, counted, exact_totals
from hydrolens.functions.quality import is_business_row
from hydrolens.functions.scoring import data_quality_points
from hydrolens.operators import ingest
from hydrolens.operators.alerts import ALERT_KEY
from hydrolens.plans import rollups as R
from hydrolens.plans.facts import with_health

HOUR = dt.timedelta(hours=1)


@dataclass(frozen=True)
class Record:
    """Keys of a record, its date column, and the columns that are added, minima and maxima."""

    keys: tuple[str, ...]
    date: str
    added: tuple[str, ...]
    least: tuple[str, ...] = ()
    most: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.added, *self.least, *self.most]

    def merged(self, *frames: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """Records of several frames as one, per key or per some of the keys."""
        keys = list(keys or self.keys)
        return reduce(DataFrame.unionByName, frames).groupBy(*keys).agg(
            *added(*self.added),
            *[F.expr(f"min({c}) as {c}") for c in self.least],
            *[F.expr(f"max({c}) as {c}") for c in self.most],
        )


def _totals_of(column: str) -> list[str]:
    return [f"{column}_whole", f"{column}_billionths", f"{column}_n"]


_FLAGS = tuple(f"{name}_readings_count" for name in S.QUALITY_FLAGS)
_INDEX_TOTALS = tuple(name for column in R.WQI_AVERAGES for name in _totals_of(column))
_INDEX = ("index_rows", "unsafe_events", "watch_events", *_INDEX_TOTALS)
_HEALTH = ("duplicate_readings_count", "anomaly_count", "stale_signal_flag_count", "drift_risk_flag_count")
_LATEST = ("latest_reading_timestamp", "latest_valid_reading_timestamp")

SENSOR_DAY = Record(
    tuple(R.SENSOR_DAY),
    "summary_date",
    ("total_readings_count", *_FLAGS, *_HEALTH, "quality_points", *_INDEX),
    ("min_wqi",),
    ("max_wqi", *_LATEST),
)
_RECENT_COUNTS = (
    *(f"{name}_count" for name in S.QUALITY_FLAGS),
    "anomaly_count",
    "critical_health_samples",
    "degraded_health_samples",
    "drift_risk_count",
    "stale_signal_count",
    "anomaly_events",
    *_totals_of("uptime_percentage"),
)
_MEASURES = tuple(measure for measure, _ in R.TREND_PARAMETERS.values())
STATION_HOUR = Record(
    ("trend_date", "time_bucket_hour", "station_id"),
    "trend_date",
    (
        *(name for m in _MEASURES for name in _totals_of(m)),
        *(f"breach_{m}" for m in _MEASURES),
        *_RECENT_COUNTS,
    ),
    tuple(f"min_{m}" for m in _MEASURES),
    tuple(f"max_{m}" for m in _MEASURES),
)


# --- from readings ------------------------------------------------------------------------
def sensor_day(readings: DataFrame) -> DataFrame:
    """The record of each sensor and day. Index columns count business rows only."""
    index_columns = [*R.WQI_AVERAGES, "wqi_class"]
    kept = ["event_timestamp", "quality_flag", *_HEALTH[:2], "stale_signal_flag", "drift_risk_flag", "health_status"]
    rows = (
        with_health(ingest.with_index(readings))
        .selectExpr(
            "event_date as summary_date",
            "station_id",
            "sensor_id",
            *kept,
            f"({is_business_row()}) as is_business",
            *[f"case when {is_business_row()} then {name} end as {name}" for name in index_columns],
        )
        .selectExpr("*", f"{data_quality_points()} as points")
    )
    totals = [total for column in R.WQI_AVERAGES for total in exact_totals(column)]
    counts = {f"{name}_readings_count": f"quality_flag = '{name}'" for name in S.QUALITY_FLAGS} | {
        "stale_signal_flag_count": "stale_signal_flag = 1",
        "drift_risk_flag_count": "drift_risk_flag = 1",
        "index_rows": "is_business",
        "unsafe_events": "wqi_class = 'Unsafe'",
        "watch_events": "wqi_class = 'Watch'",
    }
    found = rows.groupBy(*SENSOR_DAY.keys).agg(
        F.expr("count(*) as total_readings_count"),
        *counted(counts),
        *added("duplicate_readings_count", "anomaly_count"),
        F.expr("sum(points) as quality_points"),
        *totals,
        F.expr("min(wqi_score) as min_wqi"),
        F.expr("max(wqi_score) as max_wqi"),
        F.expr("max(event_timestamp) as latest_reading_timestamp"),
        F.expr("max(case when quality_flag = 'valid' then event_timestamp end) as latest_valid_reading_timestamp"),
    )
    return found.select(SENSOR_DAY.columns)


def station_hour(readings: DataFrame) -> DataFrame:
    """The record of each station and hour: trend parameters of valid rows, and the signals that the
    status of a station looks at."""
    rows = with_health(readings).selectExpr(
        "event_date as trend_date",
        "hour(event_timestamp) as time_bucket_hour",
        "station_id",
        "quality_flag",
        "anomaly_flag",
        "anomaly_count",
        "health_status",
        "drift_risk_flag",
        "stale_signal_flag",
        "coalesce(uptime_percentage, 0.0D) as uptime_percentage",
        *[f"case when quality_flag = 'valid' then {m} end as {m}" for m in _MEASURES],
    )
    parameters = []
    for measure, breach in R.TREND_PARAMETERS.values():
        parameters += [
            *exact_totals(measure),
            *counted({f"breach_{measure}": breach}),
            F.expr(f"min({measure}) as min_{measure}"),
            F.expr(f"max({measure}) as max_{measure}"),
        ]
    counts = {f"{name}_count": f"quality_flag = '{name}'" for name in S.QUALITY_FLAGS} | {
        "anomaly_count": "anomaly_flag = 1",
        "critical_health_samples": "health_status = 'critical'",
        "degraded_health_samples": "health_status = 'degraded'",
        "drift_risk_count": "drift_risk_flag = 1",
        "stale_signal_count": "stale_signal_flag = 1",
    }
    found = rows.groupBy(*STATION_HOUR.keys).agg(
        *parameters, *counted(counts), F.expr("sum(anomaly_count) as anomaly_events"), *exact_totals("uptime_percentage")
    )
    return found.select(STATION_HOUR.columns)


# --- from records ---------------------------------------------------------------------------
_SCORE = "cast(quality_points as double) / total_readings_count as data_quality_score"


def quality_of(days: DataFrame) -> DataFrame:
    """Sensor-days with the columns of the data-quality monitor."""
    return days.selectExpr(*SENSOR_DAY.keys, "total_readings_count", *_FLAGS, *_HEALTH, _SCORE)


STATION_DAY_TOTALS = ("total_readings_count", *_FLAGS, "duplicate_readings_count", *_INDEX)


def station_day(days: DataFrame) -> DataFrame:
    """Sensor-days added up per station, with the totals of the sensors' data-quality scores."""
    return days.selectExpr("*", _SCORE).groupBy(*R.STATION_DAY).agg(
        *added(*STATION_DAY_TOTALS),
        *exact_totals("data_quality_score"),
        F.expr("min(min_wqi) as min_wqi"),
        F.expr("max(max_wqi) as max_wqi"),
    )


def newest_reading(days: DataFrame) -> DataFrame:
    return days.groupBy("station_id").agg(*[F.expr(f"max({c}) as {c}") for c in _LATEST])


def station_wqi(stations_days: DataFrame) -> DataFrame:
    """Station-days that have an index, with the averages of the day."""
    averages = [average_of_totals(column).alias(name) for column, name in R.WQI_AVERAGES.items()]
    return stations_days.where("index_rows > 0").select("*", *averages)


def governorate_day(stations_days: DataFrame, stations: DataFrame) -> DataFrame:
    """Per day and governorate; days without an index row have no row."""
    avg_wqi, *risks = R.combined_wqi_averages()
    return (
        stations_days.join(R.governorates(stations), "station_id")
        .groupBy("summary_date", "governorate")
        .agg(
            F.expr("count_if(index_rows > 0) as stations_count"),
            avg_wqi,
            F.expr("min(min_wqi) as min_wqi"),
            F.expr("max(max_wqi) as max_wqi"),
            *risks,
            combined_average("data_quality_score").alias("avg_data_quality_score"),
        )
        .where("stations_count > 0")
    )


def national_day(stations_days: DataFrame, stations: DataFrame) -> DataFrame:
    """Per day. Data quality covers known stations, as the data-quality monitor does."""
    known = stations.select("station_id", F.lit(True).alias("is_known"))
    scores = _totals_of("data_quality_score") + ["duplicate_readings_count"]
    others = [name for name in stations_days.columns if name not in scores]
    rows = stations_days.join(known, "station_id", "left").selectExpr(
        *others, *[f"case when is_known then {name} end as {name}" for name in scores]
    )
    return rows.groupBy("summary_date").agg(
        F.expr("count(*) as stations_reporting_count"),
        F.expr("sum(total_readings_count) as total_readings"),
        *[F.expr(f"sum({name}_readings_count) as {name}_readings") for name in S.QUALITY_FLAGS],
        *added("duplicate_readings_count"),
        combined_average("data_quality_score").alias("avg_data_quality_score"),
        combined_average("wqi_score").alias("avg_wqi"),
        F.expr("sum(unsafe_events) as unsafe_station_events"),
        F.expr("sum(watch_events) as watch_station_events"),
    )


def parameter_hourly(hours: DataFrame) -> DataFrame:
    """Station-hours with valid readings."""
    return hours.where("valid_count > 0").drop(*_RECENT_COUNTS)


def recent(hours: DataFrame, readings: DataFrame, as_of: dt.datetime | str, lookback: int) -> DataFrame:
    """Signals of the last `lookback` hours per station. Whole hours come from their records; only the hour
    that the look-back cuts is read from the readings, and not at all when it begins on the hour."""
    start = dt.datetime.fromisoformat(str(as_of)) - dt.timedelta(hours=lookback)
    hour = start.replace(minute=0, second=0, microsecond=0)
    whole = hour if hour == start else hour + HOUR
    found = hours.where(
        f"trend_date >= date '{whole.date()}' and "
        f"(trend_date > date '{whole.date()}' or time_bucket_hour >= {whole.hour})"
    )
    if whole != start:
        cut = readings.where(
            f"event_date = date '{start.date()}' and event_timestamp >= timestamp '{start}' "
            f"and event_timestamp < timestamp '{whole}'"
        )
        found = found.unionByName(station_hour(cut))
    sums = [c for c in _RECENT_COUNTS if not c.startswith("uptime_percentage_")]
    return found.groupBy("station_id").agg(*added(*sums), combined_average("uptime_percentage").alias("avg_uptime"))


def all_alerts(closed: DataFrame, now: DataFrame) -> DataFrame:
    """Closed alerts that were not raised again, and those of the present state, which is the smaller side."""
    key = [*ALERT_KEY, "second"]
    second = F.date_trunc("second", "event_timestamp")
    again = now.select(*ALERT_KEY, second.alias("second"))
    kept = closed.withColumn("second", second).join(again, key, "left_anti").drop("second")
    return kept.unionByName(now)
