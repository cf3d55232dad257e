"""Common table expressions the statements are built from, written independently of the
Spark code. Double literals carry the suffix D, which `statements` turns into casts."""

from __future__ import annotations

AS_OF = "timestamp '2024-01-31 00:00:00'"
FRESH_FROM = f"{AS_OF} - interval 1440 minutes"

WATER = (
    "('HIGH_FINAL_TURBIDITY', 'LOW_FINAL_CHLORINE', 'FINAL_PH_OUT_OF_RANGE', "
    "'BACTERIAL_REGROWTH_RISK', 'CONTAMINATION_RISK_HIGH')"
)
PROCESS = (
    "('FILTER_BACKWASH_NEEDED', 'FILTER_EFFLUENT_TURBIDITY_HIGH', 'SLUDGE_BLANKET_HIGH', "
    "'RAW_AMMONIA_HIGH')"
)


def r2(x: str) -> str:
    """Two places, half up on the decimal text."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), 2) as double)"


def mean(x: str) -> str:
    """Average over exact integer sums of units and billionths."""
    rest = f"cast(sum(floor(({x} - floor({x})) * 1e9 + 0.5D)) as hugeint)"
    return (
        f"((cast(cast(sum(floor({x})) as hugeint) + {rest} // 1000000000 as double) "
        f"+ cast({rest} % 1000000000 as double) / 1e9) "
        f"/ nullif(cast(count({x}) as double), 0))"
    )


def n_if(condition: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


def total(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


TABLES: dict[str, str] = {}

TABLES["ev_base"] = """
select event_id, ts, user_id, event_type, value,
       cast(regexp_extract(props, '[0-9]+', 0) as int) as k, user_id % 25 as st
from events"""

TABLES["ev_raw"] = """
select concat('R', cast(event_id as varchar)) as reading_id,
  concat('ST-', lpad(cast(st as varchar), 4, '0')) as station_id,
  concat('ST-', lpad(cast(st as varchar), 4, '0'), '-U', cast(user_id as varchar)) as sensor_id,
  ts as event_timestamp,
  case when k = 0 then 210.0D + (event_id % 50)
       else 5.0D + ((event_id*7919) % 45000)/1000.0D end as raw_turbidity_ntu,
  case when k = 1 then null else 7.0D + ((event_id*31) % 900)/1000.0D end as raw_ph,
  300.0D + (event_id % 700) as raw_conductivity_us_cm,
  case when event_type = 'error' and k >= 90 then 20.0D + ((event_id*13) % 30000)/1000.0D
       else 20.0D + ((event_id*13) % 9000)/1000.0D end as raw_temperature_c,
  case when k between 2 and 3 then null
       when event_type = 'purchase' and k >= 90 then 0.25D + (value/100.0D)
       else ((event_id*17) % 280)/1000.0D end as raw_ammonia_mg_l,
  80.0D + (event_id % 60) as raw_alkalinity_mg_l,
  0.05D + ((event_id*104729) % 100)/1000.0D as c1,
  0.01D + ((event_id*1299709) % 60)/1000.0D as c2,
  event_id, event_type, k
from ev_base"""

TABLES["readings"] = """
select reading_id, station_id, sensor_id, event_timestamp, raw_turbidity_ntu, raw_ph,
  raw_conductivity_us_cm, raw_temperature_c, raw_ammonia_mg_l, raw_alkalinity_mg_l,
  case when k = 4 then raw_turbidity_ntu*1.5D when k = 19 then raw_turbidity_ntu*0.5D
       else raw_turbidity_ntu*c1 end as settled_turbidity_ntu,
  case when k between 5 and 6 then null
       when event_type = 'error' and k >= 80 then 2.6D + ((event_id*11) % 900)/1000.0D
       else 0.4D + ((event_id*11) % 900)/1000.0D end as sludge_blanket_level_m,
  100.0D*(1.0D-c1) as estimated_settling_efficiency_pct,
  case when k = 19 then 2.2D when k between 7 and 9 then raw_turbidity_ntu*c1*0.4D
       else raw_turbidity_ntu*c1*c2 end as filtered_turbidity_ntu,
  case when k = 10 then 0.15D
       when event_type = 'click' and k >= 85 then 2.7D + ((event_id*19) % 600)/1000.0D
       else 0.5D + ((event_id*19) % 1200)/1000.0D end as head_loss_m,
  5.0D + ((event_id*23) % 5000)/1000.0D as filtration_rate_m_h,
  case when k = 19 then 0.05D when k = 11 then null when k = 12 then 5.5D
       when event_type = 'view' and k >= 80 then ((event_id*29) % 250)/1000.0D
       else 0.35D + ((event_id*29) % 600)/1000.0D end as final_residual_chlorine_mg_l,
  case when k = 13 then 14.5D
       when k between 14 and 15 then 8.4D + ((event_id*37) % 400)/1000.0D
       else 7.0D + ((event_id*37) % 700)/1000.0D end as final_ph,
  case when k = 19 then 2.1D when k = 16 then raw_turbidity_ntu*c1*1.5D
       when k between 7 and 9 then raw_turbidity_ntu*c1*0.4D*0.95D
       when k between 17 and 18 then null
       else raw_turbidity_ntu*c1*c2*0.9D end as final_turbidity_ntu
from ev_raw"""

TABLES["stations"] = """
select concat('ST-', lpad(cast(key as varchar), 4, '0')) as station_id, name as station_name,
  governorate, name as city, 22.0D + key*0.4D as latitude, 25.0D + key*0.4D as longitude,
  case key % 4 when 0 then 'Nile' when 1 then 'Canal' when 2 then 'Groundwater'
       else 'Desalinated Blend' end as water_source_type,
  'Drinking' as station_category, 50000 + 10000*key as plant_capacity_m3_day,
  case when key % 12 = 7 then 'Inactive' when key % 12 = 3 then 'Under Maintenance'
       else 'Active' end as operational_status
from (select n_nationkey as key, n_name as name, r_name as governorate
      from nation join region on n_regionkey = r_regionkey
      union all select 25, 'NATION_25', 'AFRICA') s"""

TABLES["sensors"] = """
select distinct sensor_id, station_id, 'final_outlet' as sensor_stage,
  'final-quality-monitor' as sensor_type, 'Active' as sensor_status
from readings"""

PH_OUT = "(final_ph < 6.5D or final_ph > 8.5D)"

TABLES["checked"] = """
select *,
  case
    when raw_turbidity_ntu is null or settled_turbidity_ntu is null
      or filtered_turbidity_ntu is null or final_turbidity_ntu is null
      or final_residual_chlorine_mg_l is null or final_ph is null then 'partial'
    when raw_ph not between 0 and 14 or final_ph not between 0 and 14
      or raw_turbidity_ntu not between 0 and 1000
      or settled_turbidity_ntu not between 0 and 300
      or filtered_turbidity_ntu not between 0 and 100
      or final_turbidity_ntu not between 0 and 20
      or final_residual_chlorine_mg_l not between 0 and 5
      or estimated_settling_efficiency_pct not between 0 and 100 then 'invalid'
    when settled_turbidity_ntu > raw_turbidity_ntu * 1.1D
      or filtered_turbidity_ntu > settled_turbidity_ntu * 1.2D
      or final_turbidity_ntu > filtered_turbidity_ntu * 1.2D
      or abs(final_ph - raw_ph) > 1.5D or head_loss_m < 0.2D then 'suspicious'
    else 'valid' end as quality_flag,
  case when raw_turbidity_ntu > 200 or final_turbidity_ntu > 2.0D
      or final_residual_chlorine_mg_l < 0.1D or head_loss_m > 2.8D
      or sludge_blanket_level_m > 2.5D then 1 else 0 end as anomaly_flag,
  @removal as turbidity_removal_pct,
  case when final_residual_chlorine_mg_l between 0.2D and 1.0D then 1 else 0 end
    as chlorine_compliance_flag,
  case when head_loss_m > 2.8D or filtered_turbidity_ntu > 0.8D then 1 else 0 end
    as filter_backwash_needed_flag,
  least(100.0D, @contamination) as contamination_risk_score,
  least(100.0D, @regrowth) as bacterial_regrowth_risk_score,
  least(100.0D, greatest(0.0D, @process)) as process_performance_score,
  least(100.0D, greatest(0.0D, @wqi)) as wqi_score,
  case when final_residual_chlorine_mg_l < 0.2D or final_turbidity_ntu > 0.3D or @ph
      or filtered_turbidity_ntu > 0.3D or head_loss_m > 2.8D or raw_ammonia_mg_l > 0.3D
    then 1 else 0 end as breach_flag,
  cast(strftime(event_timestamp, '%Y%m%d') as int) as event_date_key,
  cast(strftime(event_timestamp, '%H%M%S') as int) as event_time_key,
  cast(event_timestamp as date) as event_date
from readings
"""
TABLES["checked"] = (
    TABLES["checked"]
    .replace(
        "@removal",
        r2(
            "((raw_turbidity_ntu - final_turbidity_ntu) "
            "/ greatest(raw_turbidity_ntu, 0.1D) * 100)"
        ),
    )
    .replace(
        "@contamination",
        r2(
            "((case when raw_ammonia_mg_l > 0.3D then (raw_ammonia_mg_l - 0.3D)*40 else 0.0D end)"
            " + (case when raw_turbidity_ntu > 50 then (raw_turbidity_ntu - 50)*0.15D else 0.0D end)"
            " + (case when settled_turbidity_ntu > 10 then (settled_turbidity_ntu - 10)*1.2D else 0.0D end)"
            " + (case when filtered_turbidity_ntu > 0.3D then (filtered_turbidity_ntu - 0.3D)*18 else 0.0D end)"
            " + (case when final_turbidity_ntu > 0.3D then (final_turbidity_ntu - 0.3D)*22 else 0.0D end)"
            " + (case when @ph then 15.0D else 0.0D end))"
        ),
    )
    .replace(
        "@regrowth",
        r2(
            "((case when final_residual_chlorine_mg_l < 0.2D then (0.2D - final_residual_chlorine_mg_l)*150 else 0.0D end)"
            " + (case when final_turbidity_ntu > 0.3D then (final_turbidity_ntu - 0.3D)*25 else 0.0D end)"
            " + (case when raw_temperature_c > 28 then (raw_temperature_c - 28)*3.5D else 0.0D end)"
            " + (case when raw_ammonia_mg_l > 0.2D then (raw_ammonia_mg_l - 0.2D)*35 else 0.0D end)"
            " + (case when @ph then 12.0D else 0.0D end))"
        ),
    )
    .replace(
        "@process",
        r2(
            "(100.0D - ((case when settled_turbidity_ntu > 10 then (settled_turbidity_ntu - 10)*1.5D else 0.0D end)"
            " + (case when filtered_turbidity_ntu > 0.3D then (filtered_turbidity_ntu - 0.3D)*15 else 0.0D end)"
            " + (case when head_loss_m > 2.0D then (head_loss_m - 2.0D)*18 else 0.0D end)"
            " + (case when filtration_rate_m_h > 9.0D then (filtration_rate_m_h - 9.0D)*6 else 0.0D end)"
            " + (case when final_turbidity_ntu > 0.3D then (final_turbidity_ntu - 0.3D)*20 else 0.0D end)))"
        ),
    )
    .replace(
        "@wqi",
        r2(
            "(100.0D - ((case when final_turbidity_ntu > 0.3D then least((final_turbidity_ntu - 0.3D)*20, 35.0D) else 0.0D end)"
            " + (case when final_residual_chlorine_mg_l < 0.2D then least((0.2D - final_residual_chlorine_mg_l)*120, 30.0D) else 0.0D end)"
            " + (case when @ph then 15.0D else 0.0D end)"
            " + (case when raw_ammonia_mg_l > 0.3D then least((raw_ammonia_mg_l - 0.3D)*35, 20.0D) else 0.0D end)))"
        ),
    )
    .replace("@ph", PH_OUT)
)

TABLES["scored"] = """
select *,
  case when wqi_score >= 90 then 'Excellent' when wqi_score >= 75 then 'Good'
       when wqi_score >= 60 then 'Watch' else 'Unsafe' end as wqi_class,
  case when final_residual_chlorine_mg_l < 0.1D or final_turbidity_ntu > 1.0D
         or head_loss_m > 2.8D or bacterial_regrowth_risk_score >= 60
         or contamination_risk_score >= 60 then 'critical'
       when breach_flag = 1 or anomaly_flag = 1 then 'warning' else 'normal' end
    as severity_level
from checked"""

TABLES["business"] = f"""
select *, event_date as batch,
  cast(coalesce(final_residual_chlorine_mg_l < 0.2D, false) as int)
  + cast(coalesce(final_turbidity_ntu > 0.3D, false) as int)
  + cast(coalesce({PH_OUT}, false) as int)
  + cast(coalesce(filtered_turbidity_ntu > 0.3D, false) as int)
  + cast(coalesce(head_loss_m > 2.8D, false) as int)
  + cast(coalesce(raw_ammonia_mg_l > 0.3D, false) as int) as num_breached_parameters
from scored
where quality_flag = 'valid' and raw_ph is not null"""

TABLES["health"] = """
select *,
  case when quality_flag = 'invalid' then 'critical'
       when drift_risk_flag = 1 or anomaly_count >= 1 or missing_readings_count >= 1
         or quality_flag = 'suspicious' then 'degraded'
       else 'healthy' end as health_status
from (select station_id, sensor_id, event_timestamp, event_date_key, event_time_key, event_date,
        quality_flag,
        case quality_flag when 'valid' then 100.0D when 'partial' then 85.0D
             when 'suspicious' then 70.0D when 'invalid' then 40.0D else 60.0D end
          as uptime_percentage,
        case when quality_flag = 'partial' then 1 else 0 end as missing_readings_count,
        0 as duplicate_readings_count, anomaly_flag as anomaly_count, 0 as stale_signal_flag,
        case when (final_residual_chlorine_mg_l < 0.1D and final_turbidity_ntu < 0.3D)
               or (raw_turbidity_ntu > 120 and settled_turbidity_ntu < 1.0D)
             then 1 else 0 end as drift_risk_flag
      from scored) h"""

# --- alerts -------------------------------------------------------------------------
# (type, parameter, stage, condition, severity, min, max, message)
_ALERTS = [
    ("LOW_FINAL_CHLORINE", "final_residual_chlorine_mg_l", "final_outlet",
     "final_residual_chlorine_mg_l < 0.2D",
     "case when final_residual_chlorine_mg_l < 0.1D then 'critical' else 'warning' end",
     "0.2D", "1.0D", "Residual chlorine at final outlet is below safe threshold."),
    ("HIGH_FINAL_TURBIDITY", "final_turbidity_ntu", "final_outlet", "final_turbidity_ntu > 0.5D",
     "case when final_turbidity_ntu > 1.0D then 'critical' else 'warning' end",
     "0.0D", "0.5D", "Final outlet turbidity exceeds acceptable drinking-water range."),
    ("FINAL_PH_OUT_OF_RANGE", "final_ph", "final_outlet", PH_OUT, "'warning'",
     "6.5D", "8.5D", "Final outlet pH is outside the recommended operating range."),
    ("FILTER_BACKWASH_NEEDED", "head_loss_m", "filtration_outlet", "head_loss_m > 2.8D",
     "'critical'", "0.2D", "2.8D", "Filter head loss indicates urgent backwash requirement."),
    ("FILTER_EFFLUENT_TURBIDITY_HIGH", "filtered_turbidity_ntu", "filtration_outlet",
     "filtered_turbidity_ntu > 0.5D", "'warning'", "0.0D", "0.5D",
     "Filtered water turbidity is above recommended value."),
    ("RAW_AMMONIA_HIGH", "raw_ammonia_mg_l", "raw_intake", "raw_ammonia_mg_l > 0.3D", "'warning'",
     "0.0D", "0.3D", "Raw water ammonia is elevated and may indicate contamination pressure."),
    ("SLUDGE_BLANKET_HIGH", "sludge_blanket_level_m", "sedimentation_outlet",
     "sludge_blanket_level_m > 2.5D", "'warning'", "0.0D", "2.5D",
     "Sludge blanket level is high and may impact clarification performance."),
    ("BACTERIAL_REGROWTH_RISK", "bacterial_regrowth_risk_score", "derived",
     "bacterial_regrowth_risk_score >= 60", "'critical'", "0.0D", "30.0D",
     "Proxy bacterial regrowth risk is critically elevated."),
    ("CONTAMINATION_RISK_HIGH", "contamination_risk_score", "derived",
     "contamination_risk_score >= 60", "'critical'", "0.0D", "30.0D",
     "Composite contamination risk score is critically high."),
]

TABLES["candidates"] = "\nunion all\n".join(
    f"""select reading_id, station_id, sensor_id, event_timestamp, event_date_key, event_time_key,
  batch, '{kind}' as alert_type, '{code}' as parameter_code, '{stage}' as stage_name,
  {severity} as severity_level, {code} as measured_value, {low} as threshold_min,
  {high} as threshold_max, '{message}' as alert_message,
  concat(station_id, '-', '{kind}', '-', '{stage}', '-',
         strftime(event_timestamp, '%Y%m%d-%H%M%S')) as alert_id
from business where {condition}"""
    for kind, code, stage, condition, severity, low, high, message in _ALERTS
)

TABLES["alert_log"] = """
select * exclude (rn) from (
  select *, row_number() over (partition by batch, station_id, alert_type, stage_name
                               order by event_timestamp desc, reading_id) as rn
  from candidates) x
where rn = 1"""

TABLES["beats"] = "select distinct batch, station_id from business"

# Open until a later batch of the station lacks the type.
TABLES["clears"] = """
select l.alert_id, max(b.batch) as cleared_batch
from alert_log l join beats b on b.station_id = l.station_id and b.batch > l.batch
where not exists (select 1 from alert_log o
                  where o.batch = b.batch and o.station_id = l.station_id
                    and o.alert_type = l.alert_type and o.stage_name = l.stage_name)
group by l.alert_id"""

TABLES["alerts"] = """
select l.*, cast(l.event_timestamp as date) as event_date,
  case when c.alert_id is null then 'open' else 'resolved' end as status
from alert_log l left join clears c on c.alert_id = l.alert_id"""

TABLES["open_now"] = "select * from alerts where status = 'open'"

# --- station grain ---------------------------------------------------------------------
TABLES["newest_wqi"] = """
select station_id, event_timestamp, reading_id, wqi_score, wqi_class, contamination_risk_score,
  bacterial_regrowth_risk_score
from (select *, row_number() over (partition by station_id
                                   order by event_timestamp desc, reading_id) as rn
      from business) x where rn = 1"""

TABLES["newest_reading"] = """
select station_id, max(event_timestamp) as latest_reading_timestamp,
  max(case when quality_flag = 'valid' then event_timestamp end) as latest_valid_reading_timestamp
from scored group by station_id"""


def recent_quality(hours: int) -> str:
    return f"""
select station_id, {n_if("quality_flag = 'invalid'")} as invalid_count,
  {n_if("quality_flag = 'partial'")} as partial_count,
  {n_if("quality_flag = 'suspicious'")} as suspicious_count,
  {n_if("quality_flag = 'valid'")} as valid_count, {n_if("anomaly_flag = 1")} as anomaly_count
from scored where event_timestamp >= {AS_OF} - interval {hours} hours group by station_id"""


def recent_health(hours: int) -> str:
    return f"""
select station_id, {mean("uptime_percentage")} as avg_uptime,
  {n_if("health_status = 'critical'")} as critical_health_samples,
  {n_if("health_status = 'degraded'")} as degraded_health_samples,
  {n_if("drift_risk_flag = 1")} as drift_risk_count,
  {n_if("stale_signal_flag = 1")} as stale_signal_count, {total("anomaly_count")} as anomaly_events
from health where event_timestamp >= {AS_OF} - interval {hours} hours group by station_id"""


TABLES["active"] = f"""
select station_id,
  cast(count(distinct concat(alert_type, '|', coalesce(stage_name, ''))) as bigint)
    as active_alert_count,
  {n_if("severity_level = 'critical'")} as critical_open_alert_count,
  {n_if("severity_level = 'warning'")} as warning_open_alert_count,
  {n_if(f"alert_type in {WATER}")} as active_water_alert_count,
  {n_if(f"alert_type in {WATER} and severity_level = 'critical'")} as critical_water_alert_count,
  {n_if(f"alert_type in {WATER} and severity_level = 'warning'")} as warning_water_alert_count,
  {n_if(f"alert_type in {PROCESS}")} as active_process_alert_count,
  {n_if(f"alert_type in {PROCESS} and severity_level = 'critical'")} as critical_process_alert_count,
  {n_if(f"alert_type in {PROCESS} and severity_level = 'warning'")} as warning_process_alert_count
from open_now group by station_id"""

TABLES["top_alert"] = """
select station_id, alert_id, event_timestamp, alert_type, severity_level, parameter_code,
  stage_name, measured_value, alert_message
from (select *, row_number() over (
        partition by station_id
        order by case when severity_level = 'critical' then 0 else 1 end, event_timestamp desc,
                 alert_type, alert_id) as rn
      from open_now) x where rn = 1"""

# --- M1 ------------------------------------------------------------------------------------
_STATUS_COUNTS = (
    "active_alert_count",
    "active_water_alert_count",
    "active_process_alert_count",
    "critical_water_alert_count",
    "warning_water_alert_count",
    "critical_process_alert_count",
    "warning_process_alert_count",
    "invalid_count",
    "suspicious_count",
    "critical_health_samples",
    "degraded_health_samples",
    "drift_risk_count",
    "anomaly_events",
)


def status_base(hours: int) -> str:
    zeros = ", ".join(f"coalesce({name}, 0) as {name}" for name in _STATUS_COUNTS)
    return f"""
select s.station_id, station_name, governorate, latitude, longitude, water_source_type,
  plant_capacity_m3_day, operational_status, w.wqi_score as latest_wqi_score,
  w.wqi_class as latest_wqi_class, w.contamination_risk_score as latest_contamination_risk_score,
  w.bacterial_regrowth_risk_score as latest_bacterial_regrowth_risk_score,
  latest_reading_timestamp, t.parameter_code as dominant_risk_parameter,
  t.alert_type as latest_open_alert_type, t.severity_level as latest_open_alert_severity, {zeros},
  cast(date_diff('minute', latest_reading_timestamp, {AS_OF}) as double) as data_freshness_minutes
from stations s
left join newest_wqi w on w.station_id = s.station_id
left join newest_reading r on r.station_id = s.station_id
left join ({recent_quality(hours)}) q on q.station_id = s.station_id
left join ({recent_health(hours)}) h on h.station_id = s.station_id
left join active a on a.station_id = s.station_id
left join top_alert t on t.station_id = s.station_id"""


_STALE = f"latest_reading_timestamp < {FRESH_FROM}"


def status(base: str) -> str:
    return f"""
select *,
  case overall_status_color when 'gray' then 0 when 'green' then 1 when 'yellow' then 2
       when 'orange' then 3 when 'red' then 4 else 1 end as status_priority
from (
select *,
  case when 'gray' in (wc, oc) then 'gray' when 'red' in (wc, oc) then 'red'
       when 'orange' in (wc, oc) then 'orange' when 'yellow' in (wc, oc) then 'yellow'
       else 'green' end as overall_status_color,
  case when 'gray' in (wc, oc) then
         case when operational_status <> 'Active' then 'Station not active / under maintenance'
              when data_freshness_minutes is null then 'No incoming telemetry yet'
              else 'Recent valid data is unavailable or stale' end
       when wc = 'red' then water_quality_status_reason when oc = 'red' then operational_status_reason
       when wc = 'orange' then water_quality_status_reason
       when oc = 'orange' then operational_status_reason
       when wc = 'yellow' then water_quality_status_reason
       when oc = 'yellow' then operational_status_reason
       else 'All monitored quality and operational signals are stable' end as overall_status_reason
from (
select *, water_quality_status_color as wc, operational_status_color as oc from (
select *,
  case when operational_status <> 'Active' or latest_reading_timestamp is null or {_STALE}
         or latest_wqi_class is null then 'gray'
       when latest_wqi_class = 'Unsafe' or critical_water_alert_count >= 2 then 'red'
       when latest_wqi_class = 'Watch' and warning_water_alert_count >= 3 then 'orange'
       when warning_water_alert_count in (1, 2) then 'yellow'
       else 'green' end as water_quality_status_color,
  case when operational_status <> 'Active' then 'Station not active / under maintenance'
       when latest_reading_timestamp is null then 'No sensor data received yet'
       when {_STALE} then 'No recent data in the freshness window'
       when latest_wqi_class is null then 'No valid water-quality readings available for WQI'
       when critical_water_alert_count >= 1 and latest_open_alert_type is not null
         then 'Critical water-safety alert: ' || latest_open_alert_type
       when latest_wqi_class = 'Unsafe' then 'Water Quality Index is Unsafe'
       when latest_wqi_class = 'Watch' then 'Water Quality Index is in Watch range'
       when warning_water_alert_count >= 2 then 'Multiple water-quality warnings are open'
       when warning_water_alert_count = 1 then 'One water-quality warning is open'
       else 'Water quality is stable and compliant' end as water_quality_status_reason,
  case when operational_status <> 'Active' or latest_reading_timestamp is null or {_STALE} then 'gray'
       when critical_process_alert_count >= 2 or critical_health_samples >= 8
         or invalid_count >= 40 then 'red'
       when critical_process_alert_count = 1 or warning_process_alert_count >= 5
         or drift_risk_count >= 20 or suspicious_count >= 40 or degraded_health_samples >= 20
         then 'orange'
       when warning_process_alert_count between 2 and 4 or suspicious_count between 10 and 39
         or degraded_health_samples between 5 and 19 or anomaly_events >= 5 then 'yellow'
       else 'green' end as operational_status_color,
  case when operational_status <> 'Active' then 'Station not active / under maintenance'
       when latest_reading_timestamp is null then 'No sensor stream available'
       when {_STALE} then 'Telemetry feed is stale'
       when critical_process_alert_count >= 2 then 'Multiple critical operational alerts are open'
       when critical_health_samples >= 8 then 'Repeated critical sensor-health evidence detected'
       when invalid_count >= 40 then 'High invalid-reading load in the last 24 hours'
       when critical_process_alert_count = 1
         then 'One critical operational alert requires intervention'
       when warning_process_alert_count >= 5 then 'Multiple operational warnings are open'
       when drift_risk_count >= 20 then 'Persistent sensor drift risk detected'
       when suspicious_count >= 40 then 'High suspicious-reading load in the last 24 hours'
       when degraded_health_samples >= 20 then 'Sensor health shows repeated degradation'
       when warning_process_alert_count between 2 and 4
         then 'Operational warnings require follow-up'
       when suspicious_count between 10 and 39
         then 'Moderate suspicious-reading volume needs review'
       when degraded_health_samples between 5 and 19
         then 'Sensor health shows repeated degradation'
       when anomaly_events >= 5
         then 'Multiple operational anomalies observed in the last 24 hours'
       else 'Operations are stable' end as operational_status_reason
from {base}) s0) s1) s2"""


def latest_status(scored_status: str) -> str:
    return f"""
select station_id, station_name, governorate, latitude, longitude, water_source_type,
  plant_capacity_m3_day, coalesce(latest_reading_timestamp, {AS_OF}) as last_update_time,
  latest_wqi_score, latest_wqi_class, latest_contamination_risk_score,
  latest_bacterial_regrowth_risk_score, coalesce(active_alert_count, 0) as active_alert_count,
  coalesce(active_water_alert_count, 0) as active_water_alert_count,
  coalesce(active_process_alert_count, 0) as active_process_alert_count,
  dominant_risk_parameter, latest_open_alert_type, latest_open_alert_severity,
  water_quality_status_color, water_quality_status_reason, operational_status_color,
  operational_status_reason, overall_status_color, overall_status_reason,
  overall_status_color as station_status_color, overall_status_reason as station_status_reason,
  status_priority, data_freshness_minutes
from {scored_status}"""


TABLES["base24"] = status_base(24)
TABLES["base720"] = status_base(720)
TABLES["status24"] = status("base24")
TABLES["status720"] = status("base720")
TABLES["m_station"] = latest_status("status24")
TABLES["m_station_month"] = latest_status("status720")

# --- M5 ------------------------------------------------------------------------------------
TABLES["quality_day"] = f"""
select event_date as summary_date, station_id, sensor_id, count(*) as total_readings_count,
  {n_if("quality_flag = 'valid'")} as valid_readings_count,
  {n_if("quality_flag = 'partial'")} as partial_readings_count,
  {n_if("quality_flag = 'invalid'")} as invalid_readings_count,
  {n_if("quality_flag = 'suspicious'")} as suspicious_readings_count
from scored group by all"""

TABLES["health_day"] = f"""
select event_date as summary_date, station_id, sensor_id,
  {total("duplicate_readings_count")} as duplicate_readings_count,
  {total("anomaly_count")} as anomaly_count,
  {n_if("stale_signal_flag = 1")} as stale_signal_flag_count,
  {n_if("drift_risk_flag = 1")} as drift_risk_flag_count,
  sum(case health_status when 'healthy' then 95 when 'degraded' then 75 else 45 end)
    / cast(count(*) as double) as data_quality_score
from health group by event_date, station_id, sensor_id"""

TABLES["m_dq"] = """
select k.summary_date, k.station_id, station_name, governorate, k.sensor_id,
  coalesce(total_readings_count, 0) as total_readings_count,
  coalesce(valid_readings_count, 0) as valid_readings_count,
  coalesce(invalid_readings_count, 0) as invalid_readings_count,
  coalesce(partial_readings_count, 0) as partial_readings_count,
  coalesce(duplicate_readings_count, 0) as duplicate_readings_count,
  coalesce(suspicious_readings_count, 0) as suspicious_readings_count,
  coalesce(anomaly_count, 0) as anomaly_count,
  coalesce(stale_signal_flag_count, 0) as stale_signal_flag_count,
  coalesce(drift_risk_flag_count, 0) as drift_risk_flag_count,
  coalesce(data_quality_score, 95.0D) as data_quality_score,
  case when coalesce(data_quality_score, 95.0D) >= 90 then 'Trusted'
       when coalesce(data_quality_score, 95.0D) >= 75 then 'Monitor'
       else 'At Risk' end as data_quality_band
from (select summary_date, station_id, sensor_id from quality_day
      union select summary_date, station_id, sensor_id from health_day) k
join stations s on s.station_id = k.station_id
left join quality_day q on q.summary_date = k.summary_date and q.station_id = k.station_id
  and q.sensor_id = k.sensor_id
left join health_day h on h.summary_date = k.summary_date and h.station_id = k.station_id
  and h.sensor_id = k.sensor_id"""

# --- M2, M3, M4, M6, M7 ------------------------------------------------------------------------
TABLES["gov_alerts"] = """
select cast(a.event_timestamp as date) as alert_date, governorate,
  count(distinct concat(a.station_id, '|', alert_type, '|', stage_name)) as alert_count,
  count(distinct case when severity_level = 'critical'
        then concat(a.station_id, '|', alert_type, '|', stage_name) end) as critical_alert_count,
  count(distinct a.station_id) as affected_stations_count
from alerts a join stations s on s.station_id = a.station_id group by 1, 2"""

TABLES["gov_mix"] = "select governorate, " + ", ".join(
    f"{n_if(f"overall_status_color = '{c}'")} as current_{c}_station_count"
    for c in ("green", "yellow", "orange", "red", "gray")
) + " from m_station group by governorate"

TABLES["gov_dq"] = f"""
select summary_date, governorate, {mean("data_quality_score")} as avg_data_quality_score
from m_dq group by summary_date, governorate"""

TABLES["gov_wqi"] = f"""
select event_date as summary_date, governorate, count(distinct b.station_id) as stations_count,
  {mean("wqi_score")} as avg_wqi, min(wqi_score) as min_wqi, max(wqi_score) as max_wqi,
  {mean("contamination_risk_score")} as avg_contamination_risk,
  {mean("bacterial_regrowth_risk_score")} as avg_bacterial_risk
from business b join stations s on s.station_id = b.station_id group by 1, 2"""

TABLES["m_gov"] = """
select w.*, coalesce(alert_count, 0) as alert_count,
  coalesce(critical_alert_count, 0) as critical_alert_count,
  coalesce(affected_stations_count, 0) as affected_stations_count, avg_data_quality_score,
  coalesce(current_green_station_count, 0) as current_green_station_count,
  coalesce(current_yellow_station_count, 0) as current_yellow_station_count,
  coalesce(current_orange_station_count, 0) as current_orange_station_count,
  coalesce(current_red_station_count, 0) as current_red_station_count,
  coalesce(current_gray_station_count, 0) as current_gray_station_count
from gov_wqi w
left join gov_alerts a on a.alert_date = w.summary_date and a.governorate = w.governorate
left join gov_mix m on m.governorate = w.governorate
left join gov_dq d on d.summary_date = w.summary_date and d.governorate = w.governorate"""

TABLES["gov_today"] = (
    "select * from m_gov where summary_date = (select max(summary_date) from m_gov)"
)

_TREND = [
    ("Raw Turbidity", "raw_turbidity_ntu", "raw_turbidity_ntu > 50"),
    ("Filtered Turbidity", "filtered_turbidity_ntu", "filtered_turbidity_ntu > 0.5D"),
    ("Final Turbidity", "final_turbidity_ntu", "final_turbidity_ntu > 0.5D"),
    (
        "Final Residual Chlorine",
        "final_residual_chlorine_mg_l",
        "final_residual_chlorine_mg_l < 0.2D or final_residual_chlorine_mg_l > 1.0D",
    ),
    ("Final pH", "final_ph", PH_OUT),
]
TABLES["m_trend"] = "\nunion all\n".join(
    f"""select event_date as trend_date, cast(hour(event_timestamp) as int) as time_bucket_hour,
  governorate, '{name}' as parameter_name, {mean(measure)} as avg_value,
  min({measure}) as min_value, max({measure}) as max_value, {n_if(breach)} as breach_count
from scored f join stations s on s.station_id = f.station_id
where quality_flag = 'valid' group by 1, 2, 3"""
    for name, measure, breach in _TREND
)

TABLES["m_alert"] = """
select alert_id, a.station_id, station_name, governorate, event_timestamp, alert_type,
  case when alert_type in ('HIGH_FINAL_TURBIDITY', 'LOW_FINAL_CHLORINE', 'FINAL_PH_OUT_OF_RANGE')
         then 'water_quality'
       when alert_type in ('FILTER_BACKWASH_NEEDED', 'FILTER_EFFLUENT_TURBIDITY_HIGH',
                           'SLUDGE_BLANKET_HIGH') then 'process'
       when alert_type = 'RAW_AMMONIA_HIGH' then 'source_water'
       when alert_type in ('BACTERIAL_REGROWTH_RISK', 'CONTAMINATION_RISK_HIGH')
         then 'derived_risk' else 'other' end as alert_domain,
  parameter_code as parameter_name, stage_name, severity_level, measured_value, alert_message,
  status
from alerts a join stations s on s.station_id = a.station_id"""

TABLES["station_wqi"] = f"""
select event_date as summary_date, station_id, {mean("wqi_score")} as avg_wqi,
  min(wqi_score) as min_wqi, max(wqi_score) as max_wqi,
  {mean("contamination_risk_score")} as avg_contamination_risk,
  {mean("bacterial_regrowth_risk_score")} as avg_bacterial_risk
from business group by 1, 2"""

TABLES["station_alerts"] = f"""
select event_date as summary_date, station_id, count(*) as alert_count,
  {n_if("severity_level = 'critical'")} as critical_alert_count
from alerts group by 1, 2"""

TABLES["station_dq"] = f"""
select summary_date, station_id, {mean("data_quality_score")} as avg_data_quality_score,
  {total("suspicious_readings_count")} as suspicious_readings_count,
  {total("invalid_readings_count")} as invalid_readings_count,
  {total("partial_readings_count")} as partial_readings_count
from m_dq group by 1, 2"""

TABLES["m_snapshot"] = """
select *,
  case when min_wqi < 60 or critical_alert_count >= 3 then 'red'
       when min_wqi < 75 or alert_count >= 12 or suspicious_readings_count >= 10 then 'orange'
       when avg_wqi < 90 or alert_count between 3 and 11
         or suspicious_readings_count between 3 and 9 then 'yellow'
       else 'green' end as snapshot_status_color,
  case when min_wqi < 60 then 'Daily minimum WQI reached Unsafe range'
       when critical_alert_count >= 3 then 'Multiple critical alerts occurred during the day'
       when min_wqi < 75 then 'Daily minimum WQI reached Watch range'
       when alert_count >= 12 then 'High alert volume was recorded during the day'
       when suspicious_readings_count >= 10 then 'High suspicious-reading volume during the day'
       when avg_wqi < 90 then 'Average WQI was below Excellent'
       when alert_count between 3 and 11 then 'Some alerts were recorded during the day'
       when suspicious_readings_count between 3 and 9
         then 'Some suspicious readings were recorded during the day'
       else 'Daily performance remained stable' end as snapshot_status_reason
from (select w.summary_date, w.station_id, station_name, governorate, avg_wqi, min_wqi, max_wqi,
        avg_contamination_risk, avg_bacterial_risk, coalesce(alert_count, 0) as alert_count,
        coalesce(critical_alert_count, 0) as critical_alert_count,
        coalesce(suspicious_readings_count, 0) as suspicious_readings_count,
        coalesce(invalid_readings_count, 0) as invalid_readings_count,
        coalesce(partial_readings_count, 0) as partial_readings_count, avg_data_quality_score
      from station_wqi w join stations s on s.station_id = w.station_id
      left join station_alerts a on a.summary_date = w.summary_date and a.station_id = w.station_id
      left join station_dq d on d.summary_date = w.summary_date and d.station_id = w.station_id) x"""

TABLES["nat_readings"] = f"""
select event_date as summary_date, count(*) as total_readings,
  {n_if("quality_flag = 'valid'")} as valid_readings,
  {n_if("quality_flag = 'partial'")} as partial_readings,
  {n_if("quality_flag = 'invalid'")} as invalid_readings,
  {n_if("quality_flag = 'suspicious'")} as suspicious_readings,
  count(distinct station_id) as stations_reporting_count
from scored group by 1"""

TABLES["nat_alerts"] = f"""
select event_date as summary_date, {n_if("status = 'resolved'")} as resolved_alert_count,
  {n_if("severity_level = 'critical'")} as critical_alert_events
from alerts group by 1"""

TABLES["nat_wqi"] = f"""
select event_date as summary_date, {mean("wqi_score")} as avg_wqi,
  {n_if("wqi_class = 'Unsafe'")} as unsafe_station_events,
  {n_if("wqi_class = 'Watch'")} as watch_station_events
from business group by 1"""

TABLES["nat_dq"] = f"""
select summary_date, {mean("data_quality_score")} as avg_data_quality_score,
  {total("duplicate_readings_count")} as duplicate_readings_count
from m_dq group by 1"""

TABLES["nat_stations"] = "select count(*) as active_station_count, " + ", ".join(
    f"{n_if(f"overall_status_color = '{c}'")} as {c}_station_count"
    for c in ("gray", "red", "orange", "yellow", "green")
) + " from m_station"


def pct(part: str) -> str:
    """Two places, half up, in integer arithmetic."""
    return f"(((20000 * {part}_readings + total_readings) // (2 * total_readings)) / 100.0D)"


TABLES["m_ready"] = f"""
select r.summary_date, stations_reporting_count, active_station_count, total_readings,
  valid_readings, suspicious_readings, partial_readings, invalid_readings,
  {pct("valid")} as valid_readings_pct, {pct("suspicious")} as suspicious_readings_pct,
  {pct("invalid")} as invalid_readings_pct,
  coalesce(duplicate_readings_count, 0) as duplicate_readings_count,
  (select count(*) from open_now) as open_alert_count,
  coalesce(resolved_alert_count, 0) as resolved_alert_count,
  coalesce(critical_alert_events, 0) as critical_alert_events, avg_data_quality_score, avg_wqi,
  coalesce(unsafe_station_events, 0) as unsafe_station_events,
  coalesce(watch_station_events, 0) as watch_station_events, green_station_count,
  yellow_station_count, orange_station_count, red_station_count, gray_station_count
from nat_readings r
left join nat_alerts a on a.summary_date = r.summary_date
left join nat_wqi w on w.summary_date = r.summary_date
left join nat_dq d on d.summary_date = r.summary_date
cross join nat_stations"""


# --- the event log in deliveries ----------------------------------------------------------
_SENT = """
select * exclude (n, cut), case when n % 97 = 5 and cut < 5 then cut + 1 else cut end as delivery from numbered
union all
select * exclude (n, cut), case when n % 97 = 5 and cut < 5 then cut + 1 else cut end from numbered where n % 250 = 0
union all
select * exclude (n, cut), cut + 1 from numbered where n % 400 = 7 and n % 97 <> 5 and cut < 5"""

# Events up to ten minutes before the newest of the deliveries before (whole milliseconds) are late.
_LIMITS = """
select delivery, date_trunc('millisecond', max(max(event_timestamp)) over (
    order by delivery rows between unbounded preceding and 1 preceding)) - interval 10 minutes as late_until
from sent group by delivery"""

_ON_TIME = """
select distinct on (station_id, sensor_id, event_timestamp) s.*
from sent s join limits using (delivery)
where late_until is null or event_timestamp > late_until
order by station_id, sensor_id, event_timestamp, delivery"""

# The same tables over what arrives on time; a delivery is a batch of the alert lifecycle.
STREAMED_TABLES: dict[str, str] = {}
for _name, _sql in TABLES.items():
    if _name == "readings":
        STREAMED_TABLES["readings_once"] = _sql
        STREAMED_TABLES["numbered"] = """
select *, cast(substr(reading_id, 2) as bigint) as n,
  least(date_diff('day', date '2024-01-01', cast(event_timestamp as date)) // 5, 5) as cut
from readings_once"""
        STREAMED_TABLES["sent"] = _SENT
        STREAMED_TABLES["limits"] = _LIMITS
        STREAMED_TABLES["readings"] = _ON_TIME
    elif _name == "business":
        STREAMED_TABLES["business"] = _sql.replace("event_date as batch", "delivery as batch")
    else:
        STREAMED_TABLES[_name] = _sql
