"""Read-side queries on the marts. Filters, sums and top-k run in Spark; optional filter
arguments left at None mean "all"."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrolens import schema as S
from hydrolens.functions import ladders
from hydrolens.functions.common import clamp, combined_average, exact_avg, exact_totals
from hydrolens.operators.quantiles import exact_quantiles


def _where(df: DataFrame, **equals: str | None) -> DataFrame:
    for column, value in equals.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def _distinct_where(column: str, condition: Column) -> Column:
    return F.count_distinct(F.when(condition, F.col(column)))


# --- national ---------------------------------------------------------------------------
def latest_readiness(readiness: DataFrame) -> DataFrame:
    return readiness.orderBy(F.col("summary_date").desc()).limit(1)


def status_distribution(station_status: DataFrame) -> DataFrame:
    return (
        station_status.groupBy("overall_status_color")
        .agg(F.count("*").alias("station_count"))
        .orderBy(F.col("station_count").desc(), "overall_status_color")
    )


def open_alerts(alert_monitor: DataFrame) -> DataFrame:
    return _where(alert_monitor, status="open")


def open_alert_types(alert_monitor: DataFrame) -> DataFrame:
    return (
        open_alerts(alert_monitor)
        .groupBy("alert_type", "severity_level")
        .agg(F.count("*").alias("count"))
        .orderBy("count", "alert_type", "severity_level")
    )


def _station_counts(station_status: DataFrame) -> DataFrame:
    """station_id is unique in the status mart, so counting rows counts stations."""
    return station_status.agg(
        F.count("station_id").alias("total_stations"),
        *[
            F.count_if(F.col("overall_status_color") == color).alias(f"{color}_stations")
            for color in ("green", "yellow", "orange", "red")
        ],
        F.avg("data_freshness_minutes").alias("avg_freshness"),
    )


def _open_alert_counts(alert_monitor: DataFrame) -> DataFrame:
    """alert_id is unique, so critical rows are critical alerts; stations are counted by
    grouping on them first."""
    per_station = (
        open_alerts(alert_monitor)
        .groupBy("station_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("severity_level") == "critical").alias("critical"),
        )
    )
    return per_station.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("open_alerts"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("open_critical_records"),
        F.count("*").alias("stations_with_open_alerts"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two ungrouped aggregates side by side: one row each."""
    return left.crossJoin(F.broadcast(right))


def executive_kpis(station_status: DataFrame, alert_monitor: DataFrame) -> DataFrame:
    return _beside(_station_counts(station_status), _open_alert_counts(alert_monitor)).select(
        "green_stations",
        "yellow_stations",
        "orange_stations",
        "red_stations",
        "open_alerts",
        F.col("open_critical_records").alias("open_critical"),
        F.col("stations_with_open_alerts").alias("stations_with_open"),
    )


def home_kpis(station_status: DataFrame, alert_monitor: DataFrame) -> DataFrame:
    return _beside(_station_counts(station_status), _open_alert_counts(alert_monitor)).select(
        "total_stations",
        "green_stations",
        "yellow_stations",
        "orange_stations",
        "red_stations",
        "open_critical_records",
        "stations_with_open_alerts",
        "avg_freshness",
    )


def readiness_score(
    station_status: DataFrame, alert_monitor: DataFrame, readiness: DataFrame
) -> DataFrame:
    """The platform's score, its label and the headline status, in one row."""
    day = latest_readiness(readiness).agg(
        F.coalesce(F.max("valid_readings_pct").cast("double"), F.lit(0.0)).alias("valid_readings_pct"),
        F.coalesce(F.max("avg_data_quality_score"), F.lit(0.0)).alias("avg_data_quality_score"),
    )

    def share(part: str) -> str:
        return f"coalesce(try_divide(cast({part} as double), total_stations), 0.0D)"

    alert_load = f"{share('stations_with_open_alerts')} * 65 - open_critical_records * 12"
    parts = [
        f"{share('green_stations')} * 100 as stable_pct",
        "valid_readings_pct",
        "avg_data_quality_score",
        f"{clamp(f'100.0D - {alert_load}')} as alert_control_score",
        f"{clamp('100.0D - coalesce(avg_freshness, 0.0D) * 3')} as freshness_score",
    ]
    # Weights.
    score = clamp(
        "stable_pct * 0.22D + valid_readings_pct * 0.25D + avg_data_quality_score * 0.25D "
        "+ alert_control_score * 0.18D + freshness_score * 0.10D"
    )
    return (
        _beside(home_kpis(station_status, alert_monitor), day)
        .selectExpr(*parts, f"{ladders.headline_status()} as headline_status")
        .selectExpr("*", f"{score} as platform_readiness_score")
        .selectExpr("*", f"{ladders.readiness_label('platform_readiness_score')} as readiness_label")
    )


def mart_health(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Number of marts that have rows. Each is probed for one row only."""
    probes = None
    for name, mart in marts.items():
        probe = mart.limit(1).select(F.lit(name).alias("mart_name"))
        probes = probe if probes is None else probes.unionByName(probe)
    return probes.agg(F.count("*").alias("ready_marts"))


def map_points(station_status: DataFrame) -> DataFrame:
    radius = F.coalesce("status_priority", F.lit(1)).cast("double") * 2500 + 3500
    return station_status.dropna(subset=["latitude", "longitude"]).select(
        "station_name",
        "governorate",
        "latitude",
        "longitude",
        "latest_wqi_score",
        "active_alert_count",
        "overall_status_color",
        F.expr(ladders.status_label()).alias("status_label"),
        "overall_status_reason",
        radius.alias("radius"),
    )


def priority_stations(station_status: DataFrame, n: int = 15) -> DataFrame:
    return (
        station_status.orderBy(
            F.col("status_priority").desc(), F.col("active_alert_count").desc(), "station_id"
        )
        .limit(n)
        .select(
            "station_name",
            "governorate",
            "latest_wqi_score",
            "latest_wqi_class",
            "active_alert_count",
            "overall_status_color",
            "overall_status_reason",
        )
    )


# --- governorates -----------------------------------------------------------------------
def governorate_latest_day(summary: DataFrame) -> DataFrame:
    last = summary.agg(F.max("summary_date").alias("summary_date"))  # one row
    return summary.join(F.broadcast(last), "summary_date")


def governorate_kpis(latest_day: DataFrame) -> DataFrame:
    return latest_day.agg(
        exact_avg("avg_wqi").alias("avg_wqi"),
        F.sum("alert_count").alias("total_alerts"),
        F.sum("critical_alert_count").alias("critical_alerts"),
        F.sum("current_green_station_count").alias("total_green"),
    )


def governorate_ranking(latest_day: DataFrame) -> DataFrame:
    mix = [f"current_{color}_station_count" for color in S.STATUS_COLORS]
    return latest_day.select(
        "summary_date",
        "governorate",
        "stations_count",
        "avg_wqi",
        "alert_count",
        "critical_alert_count",
        "affected_stations_count",
        "avg_data_quality_score",
        *mix,
    ).orderBy(F.col("critical_alert_count").desc(), F.col("alert_count").desc(), "governorate")


def status_mix_long(latest_day: DataFrame) -> DataFrame:
    mix = [f"current_{color}_station_count" for color in S.STATUS_COLORS]
    return latest_day.unpivot("governorate", mix, "status", "count").withColumn(
        "status", F.regexp_replace("status", "^current_|_station_count$", "")
    )


# --- one station ------------------------------------------------------------------------
def governorate_choices(station_status: DataFrame) -> DataFrame:
    return station_status.select("governorate").dropna().distinct().orderBy("governorate")


def station_choices(station_status: DataFrame, governorate: str | None = None) -> DataFrame:
    return (
        _where(station_status, governorate=governorate)
        .select("governorate", "station_name")
        .dropna()
        .distinct()
        .orderBy("station_name")
    )


def station_drilldown(station_status: DataFrame, station_name: str) -> DataFrame:
    """The row of one station; the smallest id if several share the name."""
    return _where(station_status, station_name=station_name).orderBy("station_id").limit(1)


def station_open_alerts(alert_monitor: DataFrame, station_id: str) -> DataFrame:
    return _where(alert_monitor, station_id=station_id, status="open").select(
        "event_timestamp",
        "alert_type",
        "alert_domain",
        "severity_level",
        "measured_value",
        "alert_message",
    )


def station_latest_dq(data_quality: DataFrame, station_id: str) -> DataFrame:
    return (
        _where(data_quality, station_id=station_id)
        .orderBy(F.col("summary_date").desc(), "sensor_id")
        .limit(1)
        .select("summary_date", "sensor_id", "data_quality_score", "data_quality_band")
    )


def station_history(snapshots: DataFrame, station_id: str) -> DataFrame:
    return (
        _where(snapshots, station_id=station_id)
        .select(
            "summary_date",
            "avg_wqi",
            "min_wqi",
            "max_wqi",
            "alert_count",
            "critical_alert_count",
            "snapshot_status_color",
            "snapshot_status_reason",
        )
        .orderBy(F.col("summary_date").desc())
    )


# --- trends -----------------------------------------------------------------------------
def trend_series(trend: DataFrame, parameter: str, governorate: str | None = None) -> DataFrame:
    return _where(trend, parameter_name=parameter, governorate=governorate).orderBy(
        "trend_date", "time_bucket_hour", "governorate"
    )


def trend_kpis(trend: DataFrame, parameter: str, governorate: str | None = None) -> DataFrame:
    chosen = _where(trend, parameter_name=parameter, governorate=governorate)
    return chosen.agg(
        exact_avg("avg_value").alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("breach_count").alias("total_breaches"),
        _distinct_where("governorate", F.col("breach_count") > 0).alias("affected_governorates"),
    )


def breach_by_governorate(
    trend: DataFrame, parameter: str, governorate: str | None = None
) -> DataFrame:
    return (
        _where(trend, parameter_name=parameter, governorate=governorate)
        .groupBy("governorate")
        .agg(F.sum("breach_count").alias("breach_count"))
        .orderBy("breach_count", "governorate")
    )


def breach_heatmap(trend: DataFrame) -> DataFrame:
    return trend.groupBy("governorate", "parameter_name").agg(
        F.sum("breach_count").alias("breach_count")
    )


# Quantiles shown by the box plot. The index lies between 0 and 100.
BOX = {"low": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "high": 1.0}
BOX_BUCKET = 0.05


def wqi_box(snapshots: DataFrame, governorate: str | None = None) -> DataFrame:
    """Box-plot figures of the daily average index per governorate and daily colour."""
    return exact_quantiles(
        _where(snapshots, governorate=governorate),
        ["governorate", "snapshot_status_color"],
        "avg_wqi",
        BOX,
        BOX_BUCKET,
    )


# --- data trust -------------------------------------------------------------------------
def _choose(data_quality: DataFrame, governorate: str | None, band: str | None) -> DataFrame:
    return _where(data_quality, governorate=governorate, data_quality_band=band)


# report column -> mart column
TRUST_SUMS = {
    "total_readings": "total_readings_count",
    "valid_readings": "valid_readings_count",
    "invalid_readings": "invalid_readings_count",
    "partial_readings": "partial_readings_count",
    "duplicate_readings": "duplicate_readings_count",
    "suspicious_readings": "suspicious_readings_count",
    "drift_flags": "drift_risk_flag_count",
}
BANDS = {"trusted_sensors": "Trusted", "monitor_sensors": "Monitor", "at_risk_sensors": "At Risk"}


def data_trust_kpis(
    data_quality: DataFrame, governorate: str | None = None, band: str | None = None
) -> DataFrame:
    """Distinct sensors per band are counted by grouping on the sensor first."""
    per_sensor = (
        _choose(data_quality, governorate, band)
        .groupBy("sensor_id")
        .agg(
            *exact_totals("data_quality_score"),
            *[F.sum(column).alias(name) for name, column in TRUST_SUMS.items()],
            *[F.bool_or(F.col("data_quality_band") == b).alias(name) for name, b in BANDS.items()],
        )
    )
    totals = per_sensor.agg(
        combined_average("data_quality_score").alias("avg_quality_score"),
        *[F.count_if(F.col(name)).alias(name) for name in BANDS],
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in TRUST_SUMS],
    )

    def pct(part: str) -> str:
        share = f"try_divide(cast({part}_readings as double), total_readings)"
        return f"coalesce({share} * 100, 0.0D) as {part}_pct"

    return totals.selectExpr("*", *[pct(part) for part in ("valid", "invalid", "suspicious")])


def band_distribution(
    data_quality: DataFrame, governorate: str | None = None, band: str | None = None
) -> DataFrame:
    return (
        _choose(data_quality, governorate, band)
        .groupBy("data_quality_band", "sensor_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("data_quality_band")
        .agg(F.count("*").alias("sensor_count"))
    )


def governorate_quality(
    data_quality: DataFrame, governorate: str | None = None, band: str | None = None
) -> DataFrame:
    return (
        _choose(data_quality, governorate, band)
        .groupBy("governorate")
        .agg(
            exact_avg("data_quality_score").alias("avg_data_quality_score"),
            F.sum("suspicious_readings_count").alias("suspicious_readings"),
            F.sum("invalid_readings_count").alias("invalid_readings"),
            F.sum("drift_risk_flag_count").alias("drift_flags"),
        )
        .orderBy("avg_data_quality_score", "governorate")
    )


def worst_sensors(
    data_quality: DataFrame, n: int = 20, governorate: str | None = None, band: str | None = None
) -> DataFrame:
    return (
        _choose(data_quality, governorate, band)
        .orderBy(
            "data_quality_score",
            F.col("suspicious_readings_count").desc(),
            F.col("drift_risk_flag_count").desc(),
            "summary_date",
            "sensor_id",
        )
        .limit(n)
        .select(
            "summary_date",
            "station_name",
            "governorate",
            "sensor_id",
            "suspicious_readings_count",
            "invalid_readings_count",
            "drift_risk_flag_count",
            "data_quality_score",
            "data_quality_band",
        )
    )


def dq_details(
    data_quality: DataFrame, governorate: str | None = None, band: str | None = None
) -> DataFrame:
    return (
        _choose(data_quality, governorate, band)
        .drop("station_id")
        .orderBy(
            "data_quality_score",
            F.col("suspicious_readings_count").desc(),
            "summary_date",
            "sensor_id",
        )
    )


# Names of the reliability signals.
SIGNALS = {
    "Valid Readings": "valid_readings",
    "Suspicious Readings": "suspicious_readings",
    "Invalid Readings": "invalid_readings",
    "Partial Readings": "partial_readings",
    "Duplicate Readings": "duplicate_readings",
    "Drift Risk Flags": "drift_flags",
}


def signal_breakdown(
    data_quality: DataFrame, governorate: str | None = None, band: str | None = None
) -> DataFrame:
    totals = _choose(data_quality, governorate, band).agg(
        *[
            F.coalesce(F.sum(TRUST_SUMS[column]), F.lit(0)).alias(signal)
            for signal, column in SIGNALS.items()
        ]
    )
    return totals.unpivot([], list(SIGNALS), "signal", "count")
