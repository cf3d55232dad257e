"""One DuckDB statement per registered query."""

from __future__ import annotations

import re

from hydrolens.sources import dimensions as dims
from oracle.tables import AS_OF, STREAMED_TABLES, TABLES, mean, n_if, pct, recent_health, recent_quality, total

MEASURES = (
    "raw_turbidity_ntu, raw_ph, raw_conductivity_us_cm, raw_temperature_c, raw_ammonia_mg_l, "
    "raw_alkalinity_mg_l, settled_turbidity_ntu, sludge_blanket_level_m, "
    "estimated_settling_efficiency_pct, filtered_turbidity_ntu, head_loss_m, "
    "filtration_rate_m_h, final_residual_chlorine_mg_l, final_ph, final_turbidity_ntu"
)
EVENT = "station_id, sensor_id, event_timestamp, event_date_key, event_time_key"
ALERT = (
    "alert_type, parameter_code, stage_name, severity_level, measured_value, threshold_min, "
    "threshold_max, alert_message"
)
COLORS = ("green", "yellow", "orange", "red", "gray")
MIX = ", ".join(f"current_{c}_station_count" for c in COLORS)


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"(values {body}) as t({columns})"


def _station_count(color: str) -> str:
    return f"{n_if(f"overall_status_color = '{color}'")} as {color}_stations"


def _per_parameter(columns: str) -> str:
    codes = [row[0] for row in dims.PARAMETERS]
    return " union all ".join(
        f"select '{c}' as parameter_code, {columns.replace('@', c)} from scored" for c in codes
    )


_BOX = {"low": "0.0D", "lower_quartile": "0.25D", "median": "0.5D", "upper_quartile": "0.75D", "high": "1.0D"}


def _quantile(name: str, fraction: str) -> str:
    position = f"((points - 1) * {fraction})"
    low = f"max(avg_wqi) filter (where rn = floor({position}))"
    high = f"max(avg_wqi) filter (where rn = ceil({position}))"
    weight = f"max({position} - floor({position}))"
    return f"{low} + ({high} - {low}) * {weight} as {name}"


_SIGNALS = [
    ("Valid Readings", "valid_readings_count"),
    ("Suspicious Readings", "suspicious_readings_count"),
    ("Invalid Readings", "invalid_readings_count"),
    ("Partial Readings", "partial_readings_count"),
    ("Duplicate Readings", "duplicate_readings_count"),
    ("Drift Risk Flags", "drift_risk_flag_count"),
]


def _trust(where: str) -> str:
    def band(name: str) -> str:
        return f"count(distinct case when data_quality_band = '{name}' then sensor_id end)"

    def share(part: str) -> str:
        return (
            f"coalesce(cast(sum({part}_readings_count) as double) "
            f"/ nullif(sum(total_readings_count), 0) * 100, 0.0D) as {part}_pct"
        )

    return f"""
select {mean("data_quality_score")} as avg_quality_score, {band("Trusted")} as trusted_sensors,
  {band("Monitor")} as monitor_sensors, {band("At Risk")} as at_risk_sensors,
  {total("total_readings_count")} as total_readings, {total("valid_readings_count")} as valid_readings,
  {total("invalid_readings_count")} as invalid_readings,
  {total("partial_readings_count")} as partial_readings,
  {total("duplicate_readings_count")} as duplicate_readings,
  {total("suspicious_readings_count")} as suspicious_readings,
  {total("drift_risk_flag_count")} as drift_flags,
  {share("valid")}, {share("invalid")}, {share("suspicious")}
from m_dq {where}"""


def _trend_kpis(where: str) -> str:
    return f"""
select {mean("avg_value")} as avg_value, min(min_value) as min_value, max(max_value) as max_value,
  {total("breach_count")} as total_breaches,
  count(distinct case when breach_count > 0 then governorate end) as affected_governorates
from m_trend where parameter_name = 'Final Turbidity' {where}"""


_STATIONS_NOW = f"""
select count(distinct station_id) as total_stations, {_station_count("green")},
  {_station_count("yellow")}, {_station_count("orange")}, {_station_count("red")},
  avg(data_freshness_minutes) as avg_freshness from m_station"""
_OPEN_NOW = f"""
select count(*) as open_alerts, {n_if("severity_level = 'critical'")} as open_critical_records,
  count(distinct station_id) as stations_with_open_alerts from m_alert where status = 'open'"""

_SCORE = f"""
select stable_pct, valid_readings_pct, avg_data_quality_score, alert_control_score, freshness_score,
  platform_readiness_score, headline_status,
  case when platform_readiness_score >= 90 then 'Stable'
       when platform_readiness_score >= 75 then 'Controlled Monitoring'
       when platform_readiness_score >= 60 then 'Elevated Operational Risk'
       else 'Attention Required' end as readiness_label
from (
  select *, least(100.0D, greatest(0.0D, stable_pct * 0.22D + valid_readings_pct * 0.25D
      + avg_data_quality_score * 0.25D + alert_control_score * 0.18D + freshness_score * 0.1D))
    as platform_readiness_score
  from (
    select cast(green_stations as double) / total_stations * 100 as stable_pct,
      valid_readings_pct, avg_data_quality_score,
      least(100.0D, greatest(0.0D, 100.0D
        - cast(stations_with_open_alerts as double) / total_stations * 65
        - open_critical_records * 12)) as alert_control_score,
      least(100.0D, greatest(0.0D, 100.0D - avg_freshness * 3)) as freshness_score,
      case when red_stations > 0 or open_critical_records > 0 then 'Attention Required'
           when orange_stations > 0 then 'Elevated Operational Risk'
           when yellow_stations > 0 then 'Controlled Monitoring' else 'Stable' end
        as headline_status
    from ({_STATIONS_NOW}) s, ({_OPEN_NOW}) o,
      (select valid_readings_pct, avg_data_quality_score from m_ready
       order by summary_date desc limit 1) d) p) q"""

_MARTS = ("m_station", "m_dq", "m_gov", "m_trend", "m_alert", "m_snapshot", "m_ready")

_RULE_COLUMNS = (
    "parameter_code, stage_name, safe_min, safe_max, warning_min, warning_max, critical_min, "
    "critical_max, rule_weight, rule_source"
)

STATEMENTS: dict[str, str] = {
    # --- sources, scans, sinks
    "scan_stations": """select station_id, station_name, governorate, city, latitude, longitude,
        water_source_type, station_category, plant_capacity_m3_day, operational_status
        from stations""",
    "scan_sensors": "select * from sensors",
    "decode_events": f"select reading_id, station_id, sensor_id, event_timestamp, {MEASURES} from readings",
    "enriched_readings": """select r.reading_id, r.station_id, r.sensor_id, r.event_timestamp,
        s.station_name, s.governorate, s.city, s.latitude, s.longitude, s.water_source_type,
        s.station_category, s.plant_capacity_m3_day, s.operational_status, n.sensor_stage,
        n.sensor_type, n.sensor_status
        from readings r left join stations s on s.station_id = r.station_id
        left join sensors n on n.sensor_id = r.sensor_id""",
    "fact_sensor_reading": f"""select reading_id, {EVENT}, {MEASURES}, turbidity_removal_pct,
        chlorine_compliance_flag, filter_backwash_needed_flag, contamination_risk_score,
        bacterial_regrowth_risk_score, quality_flag, anomaly_flag, breach_flag, severity_level
        from scored""",
    "fact_water_quality_index": """select reading_id, station_id, event_timestamp, event_date_key,
        event_time_key, wqi_score, wqi_class, process_performance_score, contamination_risk_score,
        bacterial_regrowth_risk_score, 9 as num_parameters_used, num_breached_parameters
        from business""",
    "fact_sensor_health": f"""select {EVENT}, uptime_percentage, missing_readings_count,
        duplicate_readings_count, anomaly_count, stale_signal_flag, drift_risk_flag, health_status
        from health""",
    "fact_alert": f"select alert_id, {EVENT}, {ALERT}, status from alerts",
    "parameterised_sql": """select quality_flag, count(*) as n from scored
        where station_id = 'ST-0010' and event_timestamp >= timestamp '2024-01-15 00:00:00'
        group by quality_flag""",
    # --- cleaning and validation
    "quality_flag": "select reading_id, quality_flag from scored",
    "anomaly_flag": "select reading_id, anomaly_flag from scored",
    "turbidity_removal": "select reading_id, turbidity_removal_pct from scored",
    "chlorine_compliance": "select reading_id, chlorine_compliance_flag from scored",
    "backwash_needed": "select reading_id, filter_backwash_needed_flag from scored",
    "breach_flag": "select reading_id, breach_flag from scored",
    "severity_level": "select reading_id, severity_level from scored",
    "event_keys": "select reading_id, event_timestamp, event_date_key, event_time_key from scored",
    "business_rows": """select reading_id, station_id, raw_turbidity_ntu, settled_turbidity_ntu,
        filtered_turbidity_ntu, final_turbidity_ntu, final_residual_chlorine_mg_l, final_ph, raw_ph
        from business""",
    "latest_station_readings": """select station_id, sensor_id, event_timestamp, raw_turbidity_ntu,
        raw_ph, raw_conductivity_us_cm, raw_temperature_c, raw_ammonia_mg_l, raw_alkalinity_mg_l,
        settled_turbidity_ntu, sludge_blanket_level_m, filtered_turbidity_ntu, head_loss_m,
        filtration_rate_m_h, final_residual_chlorine_mg_l, final_ph, final_turbidity_ntu,
        turbidity_removal_pct, contamination_risk_score, bacterial_regrowth_risk_score,
        quality_flag, severity_level from scored""",
    # --- scores
    "contamination_risk": "select reading_id, contamination_risk_score from scored",
    "regrowth_risk": "select reading_id, bacterial_regrowth_risk_score from scored",
    "process_performance": "select reading_id, process_performance_score from scored",
    "wqi_score": "select reading_id, wqi_score from scored",
    "wqi_class": "select reading_id, wqi_class from scored",
    "num_breached": "select reading_id, num_breached_parameters from business",
    "uptime_pct": "select sensor_id, event_timestamp, uptime_percentage from health",
    "missing_readings": "select sensor_id, event_timestamp, missing_readings_count from health",
    "drift_risk": "select sensor_id, event_timestamp, drift_risk_flag from health",
    "health_status": "select sensor_id, event_timestamp, health_status from health",
    "dq_health_points": """select sensor_id, event_timestamp,
        case health_status when 'healthy' then 95 when 'degraded' then 75 else 45 end
          as data_quality_points from health""",
    "dq_band": "select summary_date, sensor_id, data_quality_score, data_quality_band from m_dq",
    "readiness_score": _SCORE,
    # --- alerts
    "alert_candidates": f"""select reading_id, station_id, sensor_id, event_timestamp, {ALERT},
        'open' as status from candidates""",
    "alert_id": "select reading_id, alert_type, alert_id from candidates",
    "alert_latest": """select reading_id, station_id, sensor_id, event_timestamp, alert_type,
        severity_level, measured_value from alert_log""",
    "alert_domain": """select c.alert_type, count(*) as hits, max(m.alert_domain) as alert_domain
        from candidates c join (select distinct alert_type, alert_domain from m_alert) m
          on m.alert_type = c.alert_type group by c.alert_type""",
    "alert_merge": f"""select alert_id, reading_id, station_id, sensor_id, event_timestamp,
        {ALERT}, 'open' as status from alert_log""",
    "alert_resolve": """select l.alert_id, l.batch, c.cleared_batch, 'resolved' as status
        from alert_log l join clears c on c.alert_id = l.alert_id""",
    "alert_lifecycle": "select alert_id, severity_level, status from alerts",
    # --- joins
    "station_status_base": "select * from base24",
    "governorate_latest_day": "select * from gov_today",
    # --- aggregations
    "latest_reading": "select * from newest_reading",
    "recent_quality": recent_quality(24),
    "recent_quality_720h": recent_quality(720),
    "recent_health": recent_health(24),
    "recent_health_720h": recent_health(720),
    "active_alerts": "select * from active",
    "alert_daily_governorate": "select * from gov_alerts",
    "governorate_status_mix": "select * from gov_mix",
    "governorate_dq_daily": "select * from gov_dq",
    "governorate_daily": "select * from gov_wqi",
    "parameter_trend": "select * from m_trend",
    "reading_quality_daily": "select * from quality_day",
    "sensor_health_daily": "select * from health_day",
    "station_wqi_daily": "select * from station_wqi",
    "station_alert_daily": "select * from station_alerts",
    "station_dq_daily": "select * from station_dq",
    "national_reading_daily": "select * from nat_readings",
    "national_alert_daily": "select * from nat_alerts",
    "national_wqi_daily": "select * from nat_wqi",
    "national_dq_daily": "select * from nat_dq",
    "current_station_status": "select * from nat_stations",
    "open_alert_count": "select count(*) as open_alert_count from open_now",
    "status_distribution": """select overall_status_color, count(*) as station_count
        from m_station group by 1""",
    "open_alert_types": """select alert_type, severity_level, count(*) as count
        from m_alert where status = 'open' group by 1, 2""",
    "executive_kpis": f"""select green_stations, yellow_stations, orange_stations, red_stations,
        open_alerts, open_critical_records as open_critical,
        stations_with_open_alerts as stations_with_open
        from ({_STATIONS_NOW}) s, ({_OPEN_NOW}) o""",
    "governorate_kpis": f"""select {mean("avg_wqi")} as avg_wqi, {total("alert_count")} as total_alerts,
        {total("critical_alert_count")} as critical_alerts,
        {total("current_green_station_count")} as total_green from gov_today""",
    "trend_kpis": _trend_kpis(""),
    "trend_kpis_governorate": _trend_kpis("and governorate = 'ASIA'"),
    "breach_by_governorate": f"""select governorate, {total("breach_count")} as breach_count
        from m_trend where parameter_name = 'Final Turbidity' group by 1""",
    "breach_heatmap": f"""select governorate, parameter_name, {total("breach_count")} as breach_count
        from m_trend group by 1, 2""",
    "wqi_box": f"""select governorate, snapshot_status_color, max(points) as points,
        {", ".join(_quantile(name, f) for name, f in _BOX.items())}
        from (select governorate, snapshot_status_color, avg_wqi,
                row_number() over (partition by governorate, snapshot_status_color
                                   order by avg_wqi) - 1 as rn,
                count(*) over (partition by governorate, snapshot_status_color) as points
              from m_snapshot) x group by 1, 2""",
    "data_trust_kpis": _trust(""),
    "data_trust_kpis_filtered": _trust("where governorate = 'ASIA' and data_quality_band = 'Monitor'"),
    "band_distribution": """select data_quality_band, count(distinct sensor_id) as sensor_count
        from m_dq group by 1""",
    "governorate_quality": f"""select governorate, {mean("data_quality_score")} as avg_data_quality_score,
        {total("suspicious_readings_count")} as suspicious_readings,
        {total("invalid_readings_count")} as invalid_readings,
        {total("drift_risk_flag_count")} as drift_flags from m_dq group by 1""",
    "home_kpis": f"""select total_stations, green_stations, yellow_stations, orange_stations,
        red_stations, open_critical_records, stations_with_open_alerts, avg_freshness
        from ({_STATIONS_NOW}) s, ({_OPEN_NOW}) o""",
    "mart_health": "select count(*) as ready_marts from ("
    + " union all ".join(f"select count(*) as n from {m}" for m in _MARTS)
    + ") x where n > 0",
    # --- latest row per key
    "latest_wqi": "select * from newest_wqi",
    "top_open_alert": "select * from top_alert",
    # --- sort, limit, top-k
    "latest_readiness": "select * from m_ready order by summary_date desc limit 1",
    "priority_stations": """select station_name, governorate, latest_wqi_score, latest_wqi_class,
        active_alert_count, overall_status_color, overall_status_reason
        from m_station order by status_priority desc, active_alert_count desc, station_id
        limit 15""",
    "map_points": """select station_name, governorate, latitude, longitude, latest_wqi_score,
        active_alert_count, overall_status_color,
        case overall_status_color when 'green' then 'Stable' when 'yellow' then 'Monitor'
             when 'orange' then 'Risk' when 'red' then 'Critical' when 'gray' then 'No Data'
             else 'Unknown' end as status_label, overall_status_reason,
        cast(coalesce(status_priority, 1) * 2500 + 3500 as double) as radius
        from m_station where latitude is not null and longitude is not null""",
    "governorate_ranking": f"""select summary_date, governorate, stations_count, avg_wqi,
        alert_count, critical_alert_count, affected_stations_count, avg_data_quality_score, {MIX}
        from gov_today""",
    "worst_sensors": """select summary_date, station_name, governorate, sensor_id,
        suspicious_readings_count, invalid_readings_count, drift_risk_flag_count,
        data_quality_score, data_quality_band
        from m_dq order by data_quality_score, suspicious_readings_count desc,
          drift_risk_flag_count desc, summary_date, sensor_id limit 20""",
    "dq_details": "select * exclude (station_id) from m_dq",
    "station_latest_dq": """select summary_date, sensor_id, data_quality_score, data_quality_band
        from m_dq where station_id = 'ST-0010' order by summary_date desc, sensor_id limit 1""",
    "station_history": """select summary_date, avg_wqi, min_wqi, max_wqi, alert_count,
        critical_alert_count, snapshot_status_color, snapshot_status_reason
        from m_snapshot where station_id = 'ST-0010'""",
    "station_open_alerts": """select event_timestamp, alert_type, alert_domain, severity_level,
        measured_value, alert_message from m_alert
        where station_id = 'ST-0010' and status = 'open'""",
    "trend_series": """select * from m_trend
        where parameter_name = 'Final Turbidity' and governorate = 'ASIA'""",
    "governorate_choices": "select distinct governorate from m_station where governorate is not null",
    "station_choices": "select distinct governorate, station_name from m_station where governorate = 'ASIA'",
    "station_drilldown": "select * from m_station where station_name = 'NATION_10' order by station_id limit 1",
    "open_alerts": "select * from m_alert where status = 'open'",
    # --- set operations and reshaping
    "dq_keys": """select summary_date, station_id, sensor_id from quality_day
        union select summary_date, station_id, sensor_id from health_day""",
    "status_mix_long": " union all ".join(
        f"select governorate, '{c}' as status, current_{c}_station_count as count from gov_today"
        for c in COLORS
    ),
    "signal_breakdown": " union all ".join(
        f"select '{signal}' as signal, {total(column)} as count from m_dq"
        for signal, column in _SIGNALS
    ),
    # --- dimensions
    "dim_date": f"""select cast(strftime(d, '%Y%m%d') as int) as date_key, d as full_date,
        cast(day(d) as int) as day_number, cast(month(d) as int) as month_number,
        monthname(d) as month_name, cast(quarter(d) as int) as quarter_number,
        cast(year(d) as int) as year_number,
        cast(ceil((dayofyear(d) + dayofweek(date_trunc('year', d))) / 7.0D) as int) as week_of_year,
        dayname(d) as day_name,
        case when dayname(d) in ('Friday', 'Saturday') then 1 else 0 end as is_weekend,
        {n_if("reading_id is not null")} as readings
        from (select cast(unnest(generate_series((select min(event_date) from scored),
                (select max(event_date) from scored), interval 1 day)) as date) as d) c
        left join scored s on s.event_date = c.d group by d""",
    "dim_time": f"""select cast(strftime(c, '%H%M%S') as int) as time_key,
        strftime(c, '%H:%M:%S') as full_time, cast(hour(c) as int) as hour_number,
        cast(minute(c) as int) as minute_number, cast(second(c) as int) as second_number,
        case when minute(c) < 15 then '00' when minute(c) < 30 then '15'
             when minute(c) < 45 then '30' else '45' end as quarter_hour_bucket,
        strftime(c, '%H') || ':00' as hour_bucket, {n_if("reading_id is not null")} as readings
        from (select unnest(generate_series(timestamp '2000-01-01', timestamp '2000-01-01 23:59:59',
                interval 1 second)) as c) t
        left join scored s on s.event_time_key = cast(strftime(c, '%H%M%S') as int) group by c""",
    "dim_parameter": f"""select t.*, reported_values from
        ({_per_parameter("count(@) as reported_values")}) c join
        {_values(dims.PARAMETERS, "parameter_code, parameter_name, parameter_category, unit, description, stage_name, is_online")}
        on t.parameter_code = c.parameter_code""",
    "dim_threshold_rule": f"""select t.*, 'Drinking' as water_type,
        date '2026-05-09' as effective_from, cast(null as date) as effective_to, min_value, max_value from
        ({_per_parameter("min(@) as min_value, max(@) as max_value")}) c join
        {_values(dims.THRESHOLD_RULES, _RULE_COLUMNS)} on t.parameter_code = c.parameter_code""",
    "kpi_dictionary": f"""select t.*, source_rows from
        (select 'fact_water_quality_index' as source_object, count(*) as source_rows from business
         union all select 'fact_alert', count(*) from alerts
         union all select 'mart_station_latest_status', count(*) from m_station
         union all select 'mart_system_readiness_summary', count(*) from m_ready
         union all select 'mart_data_quality_monitor', count(*) from m_dq) c join
        {_values(dims.KPI_DEFINITIONS, "kpi_code, kpi_name, kpi_group, definition, source_object, refresh_grain, interpretation_hint")}
        on t.source_object = c.source_object""",
    # --- de-duplication and streaming
    "streamed_readings": f"""select {EVENT}, {MEASURES}, turbidity_removal_pct,
        chlorine_compliance_flag, filter_backwash_needed_flag, contamination_risk_score,
        bacterial_regrowth_risk_score, quality_flag, anomaly_flag, breach_flag, severity_level
        from scored""",
    "streamed_alerts": f"""select alert_id, {EVENT}, {ALERT}, 'open' as status
        from (select *, row_number() over (partition by station_id, alert_type
                                           order by event_timestamp desc, reading_id) as rn
              from candidates) x where rn = 1""",
    "dedup_readings": "select reading_id, station_id, sensor_id, event_timestamp from readings",
    # --- marts
    "mart_station_latest_status": "select * from m_station",
    "mart_station_latest_status_720h": "select * from m_station_month",
    "mart_governorate_daily_summary": "select * from m_gov",
    "mart_parameter_trend": "select * from m_trend",
    "mart_alert_monitor": "select * from m_alert",
    "mart_data_quality_monitor": "select * from m_dq",
    "mart_station_daily_snapshot": "select * from m_snapshot",
    "mart_system_readiness_summary": "select * from m_ready",
    # --- status ladders
    "water_status_color": "select station_id, water_quality_status_color from status24",
    "water_status_reason": "select station_id, water_quality_status_reason from status24",
    "ops_status_color": "select station_id, operational_status_color from status24",
    "ops_status_reason": "select station_id, operational_status_reason from status24",
    "overall_status": "select station_id, overall_status_color, overall_status_reason from status24",
    "status_priority": "select station_id, status_priority from status24",
    "data_freshness": f"""select station_id,
        coalesce(latest_reading_timestamp, {AS_OF}) as last_update_time, data_freshness_minutes
        from status24""",
    "status_label": """select station_id,
        case overall_status_color when 'green' then 'Stable' when 'yellow' then 'Monitor'
             when 'orange' then 'Risk' when 'red' then 'Critical' when 'gray' then 'No Data'
             else 'Unknown' end as status_label from m_station""",
    "snapshot_status": """select summary_date, station_id, snapshot_status_color,
        snapshot_status_reason from m_snapshot""",
    "readiness_pct": f"""select summary_date, {pct("valid")} as valid_readings_pct,
        {pct("suspicious")} as suspicious_readings_pct, {pct("invalid")} as invalid_readings_pct
        from nat_readings""",
}


def _needed(sql: str, tables: dict[str, str]) -> list[str]:
    """Tables a statement refers to, directly or through other tables, in definition order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        new = (words & tables.keys()) - found
        found |= new
        pending += [tables[name] for name in new]
    return [name for name in tables if name in found]


def statement(sql: str, tables: dict[str, str] = TABLES) -> str:
    parts = [f"{name} as materialized ({tables[name]})" for name in _needed(sql, tables)]
    text = f"with {', '.join(parts)}\n{sql}" if parts else sql
    return re.sub(r"\b(\d+(?:\.\d+)?)D\b", r"cast(\1 as double)", text)


# Round trips through files give what was written.
STATEMENTS["scan_threshold_rules"] = STATEMENTS["dim_threshold_rule"]
STATEMENTS["streamed_enriched_readings"] = (
    f"select * exclude (reading_id) from ({STATEMENTS['enriched_readings']}) e"
)
STATEMENTS["reload_dimension"] = STATEMENTS["dim_parameter"]

# Over the event log in deliveries.
STREAMED = {f"streamed_{name}": sql for name, sql in STATEMENTS.items() if name in (
    "mart_station_latest_status", "mart_governorate_daily_summary", "mart_parameter_trend", "mart_alert_monitor",
    "mart_data_quality_monitor", "mart_station_daily_snapshot", "mart_system_readiness_summary",
)} | {
    "streamed_alert_lifecycle": "select alert_id, severity_level, status from alerts",
    "streamed_late_counts": """select delivery, count(*) as events,
        count(*) filter (where event_timestamp <= late_until) as late_events
        from sent join limits using (delivery) group by delivery""",
    "streamed_state": """select station_id, sensor_id, event_timestamp from readings where event_timestamp > (
        select date_trunc('millisecond', max(event_timestamp)) - interval 10 minutes from sent)""",
}


def all_statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in STATEMENTS.items()} | {
        name: statement(sql, STREAMED_TABLES) for name, sql in STREAMED.items()
    }
