"""Builds the marts in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from hydrolens.plans import marts as M
from hydrolens.plans import records
from hydrolens.plans import rollups as R
from hydrolens.plans.facts import Facts
from hydrolens.session import together

Keep = Callable[[DataFrame, str], DataFrame]


def _lazily(df: DataFrame, name: str) -> DataFrame:
    return df


class MartSet:
    """The seven marts over one set of facts.

    The marts are folded from two records of the readings (`records`), the newest index rows and the
    alerts. `keep(df, name)` may store a mart and return the stored table; it is called once per mart,
    before other marts read it. `hold` does the same for a record. By default all stay lazy, which is
    right when a query needs one of them once.
    """

    def __init__(self, facts: Facts, clock: M.Clock, keep: Keep = _lazily, hold: Keep = _lazily):
        self.facts, self.clock, self.keep, self.hold = facts, clock, keep, hold

    def _prepare(self, *names: str) -> None:
        """Frames that are stored before a mart reads them are stored side by side."""
        if self.hold is not _lazily:
            together(self.facts.stations.sparkSession, *[lambda name=name: getattr(self, name) for name in names])

    @property
    def alerts(self) -> DataFrame:
        return self.facts.alerts

    # --- records --------------------------------------------------------------------
    @cached_property
    def sensor_days(self) -> DataFrame:
        return self.hold(records.sensor_day(self.facts.readings), "sensor_days")

    @cached_property
    def station_hours(self) -> DataFrame:
        return self.hold(records.station_hour(self.facts.readings), "station_hours")

    @cached_property
    def station_days(self) -> DataFrame:
        return records.station_day(self.sensor_days)

    @cached_property
    def station_readings(self) -> DataFrame:
        return records.newest_reading(self.sensor_days)

    @cached_property
    def alerts_now(self) -> DataFrame:
        """Alerts among which all open ones are."""
        return self.facts.alerts

    @cached_property
    def recent(self) -> DataFrame:
        clock = self.clock
        return records.recent(self.station_hours, self.facts.readings, clock.as_of, clock.lookback_hours)

    # --- rollups ------------------------------------------------------------------
    @cached_property
    def quality_daily(self) -> DataFrame:
        return R.reading_quality_daily(self.facts.readings)

    @cached_property
    def health_daily(self) -> DataFrame:
        return R.sensor_health_daily(self.facts.health)

    @cached_property
    def wqi_totals(self) -> DataFrame:
        return R.wqi_totals_daily(self.facts.wqi)

    @cached_property
    def newest_wqi(self) -> DataFrame:
        return R.latest_wqi(self.facts.wqi)

    @cached_property
    def newest_reading(self) -> DataFrame:
        return R.latest_reading(self.facts.readings)

    @cached_property
    def parameter_hourly(self) -> DataFrame:
        return R.parameter_hourly(self.facts.readings)

    # --- marts --------------------------------------------------------------------
    @cached_property
    def status_base(self) -> DataFrame:
        self._prepare("sensor_days", "station_hours", "alerts")
        return M.station_status_base(
            self.facts.stations,
            self.newest_wqi,
            self.station_readings,
            self.recent,
            R.active_alerts(self.alerts_now),
            R.top_open_alert(self.alerts_now),
            self.clock,
        )

    @cached_property
    def station_latest_status(self) -> DataFrame:
        mart = M.station_latest_status(self.status_base, self.clock)
        return self.keep(mart, "mart_station_latest_status")

    @cached_property
    def data_quality_monitor(self) -> DataFrame:
        mart = M.data_quality_monitor(records.quality_of(self.sensor_days), self.facts.stations)
        return self.keep(mart, "mart_data_quality_monitor")

    @cached_property
    def governorate_daily(self) -> DataFrame:
        stations = self.facts.stations
        return M.governorate_daily(
            records.governorate_day(self.station_days, stations),
            R.alert_daily_governorate(self.facts.alerts, stations),
        )

    @cached_property
    def governorate_daily_summary(self) -> DataFrame:
        mix = R.governorate_status_mix(self.station_latest_status)  # it prepares what the days need, too
        mart = M.governorate_daily_summary(self.governorate_daily, mix)
        return self.keep(mart, "mart_governorate_daily_summary")

    @cached_property
    def parameter_trend(self) -> DataFrame:
        mart = R.parameter_trend(records.parameter_hourly(self.station_hours), self.facts.stations)
        return self.keep(mart, "mart_parameter_trend")

    @cached_property
    def alert_monitor(self) -> DataFrame:
        mart = M.alert_monitor(self.facts.alerts, self.facts.stations)
        return self.keep(mart, "mart_alert_monitor")

    @cached_property
    def station_daily_snapshot(self) -> DataFrame:
        self._prepare("sensor_days", "alerts")
        alert_daily = R.station_alert_daily(self.facts.alerts)
        mart = M.station_daily_snapshot(self.station_days, alert_daily, self.facts.stations)
        return self.keep(mart, "mart_station_daily_snapshot")

    @cached_property
    def readiness_daily(self) -> DataFrame:
        days = records.national_day(self.station_days, self.facts.stations)
        return M.readiness_daily(days, R.national_alert_daily(self.facts.alerts))

    @cached_property
    def system_readiness_summary(self) -> DataFrame:
        status = R.current_station_status(self.station_latest_status)
        mart = M.system_readiness_summary(
            self.readiness_daily,
            status,
            R.open_alert_count(self.alerts_now),
        )
        return self.keep(mart, "mart_system_readiness_summary")

    def all(self) -> dict[str, DataFrame]:
        return {
            "mart_station_latest_status": self.station_latest_status,
            "mart_data_quality_monitor": self.data_quality_monitor,
            "mart_governorate_daily_summary": self.governorate_daily_summary,
            "mart_parameter_trend": self.parameter_trend,
            "mart_alert_monitor": self.alert_monitor,
            "mart_station_daily_snapshot": self.station_daily_snapshot,
            "mart_system_readiness_summary": self.system_readiness_summary,
        }
