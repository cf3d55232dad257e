"""Named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens import schema as S
from hydrolens.functions import ladders, scoring
from hydrolens.functions.quality import breached_parameter_count
from hydrolens.operators import alerts as A
from hydrolens.operators import ingest
from hydrolens.plans import facts as facts_plan
from hydrolens.plans import marts as M
from hydrolens.plans import reports
from hydrolens.plans import rollups as R
from hydrolens.plans.martset import MartSet
from hydrolens.session import configure
from hydrolens.sources import derived, dimensions
from hydrolens.sources.folders import RunFolder
from hydrolens.sources.streams import json_file_stream
from hydrolens.sources.warehouse import MARTS, Warehouse
from hydrolens.streaming import telemetry

Query = Callable[[SparkSession, str], DataFrame]

# Time arguments that fit the given events (1 to 30 January 2024).
AS_OF = "2024-01-31 00:00:00"
DAY = M.Clock(AS_OF, freshness_minutes=1440, lookback_hours=24)
MONTH = M.Clock(AS_OF, freshness_minutes=1440, lookback_hours=720)

# Arguments of the drill-down queries.
STATION_ID, STATION_NAME = "ST-0010", "NATION_10"
GOVERNORATE, PARAMETER, BAND = "ASIA", "Final Turbidity", "Monitor"


# Columns of the readings view.
LATEST_STATION_READINGS = [
    "station_id",
    "sensor_id",
    "event_timestamp",
    "raw_turbidity_ntu",
    "raw_ph",
    "raw_conductivity_us_cm",
    "raw_temperature_c",
    "raw_ammonia_mg_l",
    "raw_alkalinity_mg_l",
    "settled_turbidity_ntu",
    "sludge_blanket_level_m",
    "filtered_turbidity_ntu",
    "head_loss_m",
    "filtration_rate_m_h",
    "final_residual_chlorine_mg_l",
    "final_ph",
    "final_turbidity_ntu",
    "turbidity_removal_pct",
    "contamination_risk_score",
    "bacterial_regrowth_risk_score",
    "quality_flag",
    "severity_level",
]


class Telemetry:
    """Frames derived from one folder of tables. Has the attributes of `Facts`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self._records: dict[str, DataFrame] = {}

    def _hold(self, record: DataFrame, name: str) -> DataFrame:
        """Records depend on the readings only: all mart sets share them."""
        if name not in self._records:
            self._records[name] = self.run.keep(record, name)
        return self._records[name]

    @cached_property
    def run(self) -> RunFolder:
        return RunFolder(self.spark)

    @cached_property
    def raw(self) -> DataFrame:
        return derived.readings(self.spark, self.sf_dir)

    @cached_property
    def scored(self) -> DataFrame:
        return ingest.score_readings(self.raw)

    @cached_property
    def business(self) -> DataFrame:
        return facts_plan.with_daily_batches(facts_plan.business_rows(self.scored))

    @cached_property
    def stations(self) -> DataFrame:
        return derived.stations(self.spark, self.sf_dir)

    @cached_property
    def sensors(self) -> DataFrame:
        return derived.sensors(self.spark, self.sf_dir)

    @cached_property
    def readings(self) -> DataFrame:
        return facts_plan.fact_sensor_reading(self.scored)

    @cached_property
    def wqi(self) -> DataFrame:
        return facts_plan.fact_water_quality_index(self.scored)

    @cached_property
    def health(self) -> DataFrame:
        return facts_plan.fact_sensor_health(self.scored)

    @cached_property
    def lazy_alerts(self) -> DataFrame:
        return facts_plan.daily_fact_alert(self.scored)

    @cached_property
    def alerts(self) -> DataFrame:
        """The alert fact, written once: the marts read it several times."""
        return self.run.keep(self.lazy_alerts, "fact_alert")

    @cached_property
    def day_alert_monitor(self) -> DataFrame:
        """The alert monitor alone reads the alert fact once, so nothing is written."""
        return M.alert_monitor(self.lazy_alerts, self.stations)

    @cached_property
    def day(self) -> MartSet:
        """Lazy marts over records that are written once: the marts' own plans read few facts."""
        return MartSet(self, DAY, hold=self._hold)

    @cached_property
    def month(self) -> MartSet:
        return MartSet(self, MONTH, hold=self._hold)

    @cached_property
    def stored(self) -> MartSet:
        """Marts written once each, for queries that read several of them."""
        return MartSet(self, DAY, self.run.keep, self._hold)


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals, and integers that can be null, as doubles: clients differ in how they return
    them."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) or f.name == "data_freshness_minutes"
            else f.name
            for f in df.schema.fields
        ]
    )


def _query(build: Callable[[Telemetry], DataFrame]) -> Query:
    return lambda spark, sf_dir: _comparable(build(Telemetry(spark, sf_dir)))


def _scored_column(name: str) -> Query:
    return _query(lambda t: t.scored.select("reading_id", name))


def _health_column(name: str) -> Query:
    return _query(lambda t: t.health.select("sensor_id", "event_timestamp", name))


def _status_column(name: str) -> Query:
    return _query(lambda t: M.with_status(t.day.status_base, DAY).select("station_id", name))


def _csv_scan(write: str, scan: Callable[[SparkSession, str], DataFrame]) -> Query:
    def build(t: Telemetry) -> DataFrame:
        path = f"{t.run.path}/{write}_csv"
        dimensions.export_csv(getattr(t, write), path)
        return scan(t.spark, path)

    return _query(build)


def _decoded_events(t: Telemetry) -> DataFrame:
    return ingest.require_ids(
        ingest.parse_event_time(ingest.decode_events(derived.as_event_json(t.raw)))
    ).select("reading_id", "station_id", "sensor_id", "event_timestamp", *S.MEASURES)


def _parameter_counts(t: Telemetry) -> DataFrame:
    """Reported values, smallest and largest per parameter of the scored readings."""
    codes = [row[0] for row in dimensions.PARAMETERS]
    totals = t.scored.agg(
        F.array(
            *[
                F.struct(
                    F.lit(code).alias("parameter_code"),
                    F.count(code).alias("reported_values"),
                    F.min(code).alias("min_value"),
                    F.max(code).alias("max_value"),
                )
                for code in codes
            ]
        ).alias("rows")
    )
    return totals.select(F.inline("rows"))


def _dim_date(t: Telemetry) -> DataFrame:
    days = t.readings.groupBy("event_date_key").agg(F.count("*").alias("readings"))
    calendar = dimensions.dim_date_spanning(t.readings, "event_date")
    counts = days.withColumnRenamed("event_date_key", "date_key")
    return calendar.join(counts, "date_key", "left").withColumn(
        "readings", F.coalesce("readings", F.lit(0))
    )


def _dim_time(t: Telemetry) -> DataFrame:
    """Every second of the clock with the readings that fall on it."""
    counts = t.readings.groupBy(F.col("event_time_key").alias("time_key")).agg(
        F.count("*").alias("readings")
    )
    clock = dimensions.dim_time(t.spark).join(counts, "time_key", "left")
    return clock.withColumn("readings", F.coalesce("readings", F.lit(0)))


def _dim_parameter(t: Telemetry) -> DataFrame:
    counts = _parameter_counts(t).select("parameter_code", "reported_values")
    catalogue = F.broadcast(dimensions.dim_parameter(t.spark))  # 19 rows
    return counts.join(catalogue, "parameter_code")


def _dim_threshold_rule(t: Telemetry) -> DataFrame:
    return _rule_spans(t, dimensions.dim_threshold_rule(t.spark))


def _rule_spans(t: Telemetry, rules: DataFrame) -> DataFrame:
    """Each rule (19 rows) with the span of the values that it is for."""
    span = _parameter_counts(t).select("parameter_code", "min_value", "max_value")
    return span.join(F.broadcast(rules), "parameter_code")


def _scanned_rules(t: Telemetry) -> DataFrame:
    """The rules through CSV and back."""
    path = f"{t.run.path}/rules_csv"
    dimensions.export_csv(dimensions.dim_threshold_rule(t.spark), path)
    return _rule_spans(t, dimensions.scan_threshold_rules(t.spark, path))


def _reloaded_parameters(t: Telemetry) -> DataFrame:
    """The parameters, stored twice in the same place and read back."""
    path = RunFolder(t.spark).path
    for _ in range(2):
        stored = dimensions.reload_dimension(dimensions.dim_parameter(t.spark), path)
    counts = _parameter_counts(t).select("parameter_code", "reported_values")
    return counts.join(F.broadcast(stored), "parameter_code")


def _kpi_dictionary(t: Telemetry) -> DataFrame:
    """Each KPI with the number of rows of the table it is computed from. The status mart has a row per station
    and the quality monitor one per sensor-day of a known station, so no mart is built to be counted."""
    days = t.day.sensor_days
    counts = {
        "fact_water_quality_index": days.agg(F.coalesce(F.sum("index_rows"), F.lit(0)).alias("source_rows")),
        "fact_alert": t.alerts.agg(F.count("*").alias("source_rows")),
        "mart_station_latest_status": t.stations.agg(F.count("*").alias("source_rows")),
        "mart_system_readiness_summary": days.agg(F.count_distinct("summary_date").alias("source_rows")),
        "mart_data_quality_monitor": days.join(t.stations.select("station_id"), "station_id").agg(
            F.count("*").alias("source_rows")
        ),
    }
    named = [frame.withColumn("source_object", F.lit(name)) for name, frame in counts.items()]
    definitions = F.broadcast(dimensions.kpi_dictionary(t.spark))  # 8 rows
    return reduce(DataFrame.unionByName, named).join(definitions, "source_object")


def _parameterised_sql(t: Telemetry) -> DataFrame:
    return t.spark.sql(
        "select quality_flag, count(*) as n from {readings} "
        "where station_id = :station and event_timestamp >= :since group by quality_flag",
        args={"station": STATION_ID, "since": "2024-01-15"},
        readings=t.readings,
    )


def _dq_keys(t: Telemetry) -> DataFrame:
    keys = R.SENSOR_DAY
    return t.day.quality_daily.select(keys).union(t.day.health_daily.select(keys)).distinct()


def _streamed(t: Telemetry) -> Warehouse:
    """Sends the readings, some of them twice, through the streaming path in one batch."""
    path = RunFolder(t.spark).path
    events = derived.as_event_json(derived.readings_with_duplicates(t.spark, t.sf_dir))
    events.write.text(f"{path}/events")
    warehouse = Warehouse(t.spark, f"{path}/warehouse", t.stations)
    telemetry.start(
        json_file_stream(t.spark, f"{path}/events"),
        warehouse,
        f"{path}/checkpoint",
        trigger={"availableNow": True},
        refresh_every=None,
    ).awaitTermination()
    return warehouse


def _streamed_readings(t: Telemetry) -> DataFrame:
    """Which copy of a repeated reading survives is open, so its id is left out."""
    facts = _streamed(t).table("fact_sensor_reading")
    return facts.drop("reading_id", "ingestion_time", "processing_time", "batch", "event_date")


def _streamed_enriched_readings(t: Telemetry) -> DataFrame:
    """The stream joined to the dimensions, through a file sink."""
    path = RunFolder(t.spark).path
    events, sink = f"{path}/events", f"{path}/enriched"
    derived.as_event_json(derived.readings_with_duplicates(t.spark, t.sf_dir)).write.text(events)
    stream = telemetry.enriched_stream(json_file_stream(t.spark, events), t.stations, t.sensors)
    columns = ingest.enrich(t.raw, t.stations, t.sensors).drop("reading_id", *S.MEASURES).columns
    query = (
        stream.select(columns)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    return t.spark.read.parquet(sink)


# Streamed warehouses of this session and what their queries reported, by application and folder of tables.
_REPLAYED: dict[tuple[str, str], tuple[Warehouse, list[tuple[int, int, int]], str]] = {}


def _replayed(t: Telemetry) -> tuple[Warehouse, list[tuple[int, int, int]], str]:
    """The whole loop over the event log: each delivery is one run of the streaming query on the same
    checkpoint, and the marts are refreshed every other delivery. Made once per session and folder of tables; it
    stays in the shared folder as long as the session.

    Returns the warehouse, per delivery the events read and those dropped as late, and the checkpoint.
    """
    known = (t.spark.sparkContext.applicationId, t.sf_dir)
    if known not in _REPLAYED:
        path, reports = RunFolder(t.spark).path, []
        log = derived.deliveries(t.spark, t.sf_dir)
        warehouse = Warehouse(t.spark, f"{path}/warehouse", t.stations)
        for delivery in range(derived.DELIVERIES):
            sent = log.where(F.col("delivery") == delivery).drop("delivery")
            derived.as_event_json(sent).write.text(f"{path}/events/delivery={delivery}")
            query = telemetry.start(
                json_file_stream(t.spark, f"{path}/events"),
                warehouse,
                f"{path}/checkpoint",
                trigger={"availableNow": True},
                refresh_every=None,
            )
            query.awaitTermination()
            if delivery % 2:
                warehouse.refresh(DAY)
            reports.append((delivery, *telemetry.late_events(query)))
        _REPLAYED[known] = warehouse, reports, f"{path}/checkpoint"
    return _REPLAYED[known]


def _streamed_mart(name: str) -> Query:
    return _query(lambda t: _replayed(t)[0].mart(name).drop("updated_at"))


def _streamed_alert_lifecycle(t: Telemetry) -> DataFrame:
    return _replayed(t)[0].alerts().select("alert_id", "severity_level", "status")


def _streamed_late_counts(t: Telemetry) -> DataFrame:
    return t.spark.createDataFrame(_replayed(t)[1], "delivery bigint, events bigint, late_events bigint")


def _streamed_state(t: Telemetry) -> DataFrame:
    """The keys that the de-duplication still holds after the last delivery."""
    return telemetry.held_keys(t.spark, _replayed(t)[2])


def _streamed_alerts(t: Telemetry) -> DataFrame:
    return _streamed(t).alerts().drop("event_date")


def _clock_columns() -> list[str]:
    return ["reading_id", "event_timestamp", "event_date_key", "event_time_key"]


def all_queries() -> dict[str, Query]:
    """Every registered query by name."""
    return {
        # --- sources, scans, sinks
        "scan_stations": _csv_scan("stations", dimensions.scan_stations),
        "scan_sensors": _csv_scan("sensors", dimensions.scan_sensors),
        "decode_events": _query(_decoded_events),
        "enriched_readings": _query(
            lambda t: ingest.enrich(t.raw, t.stations, t.sensors).drop(*S.MEASURES)
        ),
        "fact_sensor_reading": _query(lambda t: t.readings.drop("event_date")),
        "fact_water_quality_index": _query(lambda t: t.wqi.drop("event_date")),
        "fact_sensor_health": _query(lambda t: t.health.drop("event_date")),
        "fact_alert": _query(lambda t: t.lazy_alerts.drop("event_date")),
        "parameterised_sql": _query(_parameterised_sql),
        # --- cleaning and validation
        "quality_flag": _scored_column("quality_flag"),
        "anomaly_flag": _scored_column("anomaly_flag"),
        "turbidity_removal": _scored_column("turbidity_removal_pct"),
        "chlorine_compliance": _scored_column("chlorine_compliance_flag"),
        "backwash_needed": _scored_column("filter_backwash_needed_flag"),
        "breach_flag": _scored_column("breach_flag"),
        "severity_level": _scored_column("severity_level"),
        "event_keys": _query(lambda t: t.scored.select(*_clock_columns())),
        "business_rows": _query(
            lambda t: t.business.select("reading_id", "station_id", *S.BUSINESS_MEASURES)
        ),
        "latest_station_readings": _query(lambda t: t.readings.select(LATEST_STATION_READINGS)),
        # --- scores
        "contamination_risk": _scored_column("contamination_risk_score"),
        "regrowth_risk": _scored_column("bacterial_regrowth_risk_score"),
        "process_performance": _scored_column("process_performance_score"),
        "wqi_score": _scored_column("wqi_score"),
        "wqi_class": _scored_column("wqi_class"),
        "num_breached": _query(
            lambda t: t.business.selectExpr(
                "reading_id", f"{breached_parameter_count()} as num_breached_parameters"
            )
        ),
        "uptime_pct": _health_column("uptime_percentage"),
        "missing_readings": _health_column("missing_readings_count"),
        "drift_risk": _health_column("drift_risk_flag"),
        "health_status": _health_column("health_status"),
        "dq_health_points": _query(
            lambda t: t.health.selectExpr(
                "sensor_id",
                "event_timestamp",
                f"{scoring.data_quality_points()} as data_quality_points",
            )
        ),
        "dq_band": _query(
            lambda t: t.day.data_quality_monitor.select(
                "summary_date", "sensor_id", "data_quality_score", "data_quality_band"
            )
        ),
        "readiness_score": _query(
            lambda t: reports.readiness_score(
                t.stored.station_latest_status,
                t.stored.alert_monitor,
                t.stored.system_readiness_summary,
            )
        ),
        # --- alerts
        "alert_candidates": _query(
            lambda t: A.alert_candidates(facts_plan.business_rows(t.scored))
        ),
        "alert_id": _query(
            lambda t: A.alert_candidates(facts_plan.business_rows(t.scored)).selectExpr(
                "reading_id", "alert_type", f"{A.ALERT_ID} as alert_id"
            )
        ),
        "alert_latest": _query(lambda t: A.alert_log(t.business).drop("batch")),
        "alert_domain": _query(
            lambda t: A.alert_hits(t.business)
            .groupBy("alert_type")
            .agg(F.count("*").alias("hits"))
            .selectExpr("*", f"{A.ALERT_DOMAIN} as alert_domain")
        ),
        "alert_merge": _query(
            lambda t: A.describe_alerts(A.merge_alerts(A.alert_log(t.business)))
            .selectExpr("*", f"{A.ALERT_ID} as alert_id", "'open' as status")
            .drop("batch")
        ),
        "alert_resolve": _query(
            lambda t: A.describe_alerts(
                A.alert_lifecycle(
                    A.alert_log(t.business), A.last_clears(A.heartbeat_log(t.business))
                )
            )
            .filter("status = 'resolved'")
            .selectExpr(f"{A.ALERT_ID} as alert_id", "batch", "cleared_batch", "status")
        ),
        "alert_lifecycle": _query(lambda t: t.lazy_alerts.select("alert_id", "severity_level", "status")),
        # --- joins
        "station_status_base": _query(lambda t: t.day.status_base),
        "governorate_latest_day": _query(
            lambda t: reports.governorate_latest_day(t.stored.governorate_daily_summary)
        ),
        # --- aggregations
        "latest_reading": _query(lambda t: t.day.newest_reading),
        "recent_quality": _query(lambda t: R.recent_quality(t.readings, AS_OF, 24)),
        "recent_quality_720h": _query(lambda t: R.recent_quality(t.readings, AS_OF, 720)),
        "recent_health": _query(lambda t: R.recent_health(t.health, AS_OF, 24)),
        "recent_health_720h": _query(lambda t: R.recent_health(t.health, AS_OF, 720)),
        "active_alerts": _query(lambda t: R.active_alerts(t.lazy_alerts)),
        "alert_daily_governorate": _query(
            lambda t: R.alert_daily_governorate(t.lazy_alerts, t.stations)
        ),
        "governorate_status_mix": _query(
            lambda t: R.governorate_status_mix(t.day.station_latest_status)
        ),
        "governorate_dq_daily": _query(
            lambda t: R.governorate_dq_daily(t.day.data_quality_monitor)
        ),
        "governorate_daily": _query(
            lambda t: R.governorate_wqi_daily(t.day.wqi_totals, t.stations)
        ),
        "parameter_trend": _query(lambda t: t.day.parameter_trend),
        "reading_quality_daily": _query(lambda t: t.day.quality_daily),
        "sensor_health_daily": _query(lambda t: t.day.health_daily),
        "station_wqi_daily": _query(lambda t: R.station_wqi_daily(t.day.wqi_totals)),
        "station_alert_daily": _query(lambda t: R.station_alert_daily(t.lazy_alerts)),
        "station_dq_daily": _query(lambda t: R.station_dq_daily(t.day.data_quality_monitor)),
        "national_reading_daily": _query(lambda t: R.national_reading_daily(t.day.quality_daily)),
        "national_alert_daily": _query(lambda t: R.national_alert_daily(t.lazy_alerts)),
        "national_wqi_daily": _query(lambda t: R.national_wqi_daily(t.day.wqi_totals)),
        "national_dq_daily": _query(lambda t: R.national_dq_daily(t.day.data_quality_monitor)),
        "current_station_status": _query(
            lambda t: R.current_station_status(t.day.station_latest_status)
        ),
        "open_alert_count": _query(lambda t: R.open_alert_count(t.lazy_alerts)),
        "status_distribution": _query(
            lambda t: reports.status_distribution(t.day.station_latest_status)
        ),
        "open_alert_types": _query(lambda t: reports.open_alert_types(t.day_alert_monitor)),
        "executive_kpis": _query(
            lambda t: reports.executive_kpis(t.day.station_latest_status, t.day.alert_monitor)
        ),
        "governorate_kpis": _query(
            lambda t: reports.governorate_kpis(
                reports.governorate_latest_day(t.stored.governorate_daily_summary)
            )
        ),
        "trend_kpis": _query(lambda t: reports.trend_kpis(t.day.parameter_trend, PARAMETER)),
        "trend_kpis_governorate": _query(
            lambda t: reports.trend_kpis(t.day.parameter_trend, PARAMETER, GOVERNORATE)
        ),
        "breach_by_governorate": _query(
            lambda t: reports.breach_by_governorate(t.day.parameter_trend, PARAMETER)
        ),
        "breach_heatmap": _query(lambda t: reports.breach_heatmap(t.day.parameter_trend)),
        "wqi_box": _query(lambda t: reports.wqi_box(t.stored.station_daily_snapshot)),
        "data_trust_kpis": _query(lambda t: reports.data_trust_kpis(t.day.data_quality_monitor)),
        "data_trust_kpis_filtered": _query(
            lambda t: reports.data_trust_kpis(t.day.data_quality_monitor, GOVERNORATE, BAND)
        ),
        "band_distribution": _query(
            lambda t: reports.band_distribution(t.day.data_quality_monitor)
        ),
        "governorate_quality": _query(
            lambda t: reports.governorate_quality(t.day.data_quality_monitor)
        ),
        "home_kpis": _query(
            lambda t: reports.home_kpis(t.day.station_latest_status, t.day.alert_monitor)
        ),
        "mart_health": _query(lambda t: reports.mart_health(t.stored.all())),
        # --- latest row per key
        "latest_wqi": _query(lambda t: t.day.newest_wqi),
        "top_open_alert": _query(lambda t: R.top_open_alert(t.lazy_alerts)),
        # --- sort, limit, top-k
        "latest_readiness": _query(
            lambda t: reports.latest_readiness(t.stored.system_readiness_summary)
        ),
        "priority_stations": _query(
            lambda t: reports.priority_stations(t.day.station_latest_status)
        ),
        "map_points": _query(lambda t: reports.map_points(t.day.station_latest_status)),
        "governorate_ranking": _query(
            lambda t: reports.governorate_ranking(
                reports.governorate_latest_day(t.stored.governorate_daily_summary)
            )
        ),
        "worst_sensors": _query(lambda t: reports.worst_sensors(t.day.data_quality_monitor)),
        "dq_details": _query(lambda t: reports.dq_details(t.day.data_quality_monitor)),
        "station_latest_dq": _query(
            lambda t: reports.station_latest_dq(t.day.data_quality_monitor, STATION_ID)
        ),
        "station_history": _query(
            lambda t: reports.station_history(t.day.station_daily_snapshot, STATION_ID)
        ),
        "station_open_alerts": _query(
            lambda t: reports.station_open_alerts(t.day_alert_monitor, STATION_ID)
        ),
        "trend_series": _query(
            lambda t: reports.trend_series(t.day.parameter_trend, PARAMETER, GOVERNORATE)
        ),
        "governorate_choices": _query(
            lambda t: reports.governorate_choices(t.day.station_latest_status)
        ),
        "station_choices": _query(
            lambda t: reports.station_choices(t.day.station_latest_status, GOVERNORATE)
        ),
        "station_drilldown": _query(
            lambda t: reports.station_drilldown(t.day.station_latest_status, STATION_NAME)
        ),
        "open_alerts": _query(lambda t: reports.open_alerts(t.day_alert_monitor)),
        # --- set operations and reshaping
        "dq_keys": _query(_dq_keys),
        "status_mix_long": _query(
            lambda t: reports.status_mix_long(
                reports.governorate_latest_day(t.stored.governorate_daily_summary)
            )
        ),
        "signal_breakdown": _query(lambda t: reports.signal_breakdown(t.day.data_quality_monitor)),
        # --- dimensions
        "dim_date": _query(_dim_date),
        "dim_time": _query(_dim_time),
        "dim_parameter": _query(_dim_parameter),
        "dim_threshold_rule": _query(_dim_threshold_rule),
        "scan_threshold_rules": _query(_scanned_rules),
        "reload_dimension": _query(_reloaded_parameters),
        "kpi_dictionary": _query(_kpi_dictionary),
        # --- de-duplication and streaming
        "streamed_readings": _query(_streamed_readings),
        "streamed_alerts": _query(_streamed_alerts),
        "streamed_enriched_readings": _query(_streamed_enriched_readings),
        **{f"streamed_{name}": _streamed_mart(name) for name in MARTS},
        "streamed_alert_lifecycle": _query(_streamed_alert_lifecycle),
        "streamed_late_counts": _query(_streamed_late_counts),
        "streamed_state": _query(_streamed_state),
        "dedup_readings": _query(
            lambda t: ingest.dedup_readings(
                derived.readings_with_duplicates(t.spark, t.sf_dir)
            ).select("reading_id", "station_id", "sensor_id", "event_timestamp")
        ),
        # --- marts
        "mart_station_latest_status": _query(lambda t: t.day.station_latest_status),
        "mart_station_latest_status_720h": _query(lambda t: t.month.station_latest_status),
        "mart_governorate_daily_summary": _query(lambda t: t.day.governorate_daily_summary),
        "mart_parameter_trend": _query(lambda t: t.day.parameter_trend),
        "mart_alert_monitor": _query(lambda t: t.day_alert_monitor),
        "mart_data_quality_monitor": _query(lambda t: t.day.data_quality_monitor),
        "mart_station_daily_snapshot": _query(lambda t: t.day.station_daily_snapshot),
        "mart_system_readiness_summary": _query(lambda t: t.day.system_readiness_summary),
        # --- status ladders
        "water_status_color": _status_column("water_quality_status_color"),
        "water_status_reason": _status_column("water_quality_status_reason"),
        "ops_status_color": _status_column("operational_status_color"),
        "ops_status_reason": _status_column("operational_status_reason"),
        "overall_status": _query(
            lambda t: M.with_status(t.day.status_base, DAY).select(
                "station_id", "overall_status_color", "overall_status_reason"
            )
        ),
        "status_priority": _status_column("status_priority"),
        "data_freshness": _query(
            lambda t: t.day.station_latest_status.select(
                "station_id", "last_update_time", "data_freshness_minutes"
            )
        ),
        "status_label": _query(
            lambda t: t.day.station_latest_status.selectExpr(
                "station_id", f"{ladders.status_label()} as status_label"
            )
        ),
        "snapshot_status": _query(
            lambda t: t.day.station_daily_snapshot.select(
                "summary_date", "station_id", "snapshot_status_color", "snapshot_status_reason"
            )
        ),
        "readiness_pct": _query(
            lambda t: R.national_reading_daily(t.day.quality_daily).selectExpr(
                "summary_date",
                *[
                    f"{M.percent(f'{part}_readings', 'total_readings')} as {part}_readings_pct"
                    for part in ("valid", "suspicious", "invalid")
                ],
            )
        ),
    }
