"""Values just below, at and above each limit, and nulls."""

import pytest

from hydrolens.functions import ladders, quality, scoring
from hydrolens.functions.common import date_key, minutes_between, text, time_key, week_of_year_sunday

GOOD = {
    "event_timestamp": "timestamp '2024-01-01 00:00:00'",
    "raw_turbidity_ntu": "20D",
    "raw_ph": "7.2D",
    "raw_temperature_c": "25D",
    "raw_ammonia_mg_l": "0.1D",
    "settled_turbidity_ntu": "4D",
    "sludge_blanket_level_m": "1D",
    "estimated_settling_efficiency_pct": "80D",
    "filtered_turbidity_ntu": "0.2D",
    "head_loss_m": "1.5D",
    "filtration_rate_m_h": "7D",
    "final_residual_chlorine_mg_l": "0.5D",
    "final_ph": "7.2D",
    "final_turbidity_ntu": "0.2D",
}


def evaluate(spark, cases, expression, columns):
    """One row per case: the given columns with the case's changes."""
    rows = [
        "select " + ", ".join([f"{i} as id"] + [f"{v} as {k}" for k, v in (columns | c).items()])
        for i, c in enumerate(cases)
    ]
    df = spark.sql(" union all ".join(rows))
    return [r[0] for r in df.selectExpr("id", f"{expression} as x").orderBy("id").select("x").collect()]


def check(spark, expression, cases, columns=GOOD):
    got = evaluate(spark, [changes for changes, _ in cases], expression, columns)
    assert got == [expected for _, expected in cases]


NULL = "cast(null as double)"


def test_quality_flag(spark):
    cases = [({}, "valid"), ({"event_timestamp": "cast(null as timestamp)"}, "invalid")]
    for name in quality.S.KEY_MEASURES:
        cases.append(({name: NULL}, "partial"))
    # A missing raw pH is no reason to reject.
    cases.append(({"raw_ph": NULL}, "valid"))
    cases.append(({"head_loss_m": NULL}, "valid"))
    cases.append(({"estimated_settling_efficiency_pct": NULL}, "valid"))
    # Missing goes before impossible.
    cases.append(({"final_ph": NULL, "raw_ph": "15D"}, "partial"))
    cases += [
        ({"raw_ph": "14.01D", "final_ph": "13D"}, "invalid"),
        ({"raw_ph": "14D", "final_ph": "12.5D"}, "valid"),
        ({"raw_ph": "14D", "final_ph": "12.4D"}, "suspicious"),
        ({"raw_ph": "-0.1D"}, "invalid"),
        ({"final_ph": "14.5D"}, "invalid"),
        ({"raw_turbidity_ntu": "1000D"}, "valid"),
        ({"raw_turbidity_ntu": "1000.5D"}, "invalid"),
        ({"settled_turbidity_ntu": "300D", "raw_turbidity_ntu": "900D"}, "valid"),
        ({"settled_turbidity_ntu": "301D", "raw_turbidity_ntu": "900D"}, "invalid"),
        ({"filtered_turbidity_ntu": "101D"}, "invalid"),
        ({"final_turbidity_ntu": "20.5D"}, "invalid"),
        ({"final_residual_chlorine_mg_l": "5D"}, "valid"),
        ({"final_residual_chlorine_mg_l": "5.1D"}, "invalid"),
        ({"estimated_settling_efficiency_pct": "100.1D"}, "invalid"),
        ({"settled_turbidity_ntu": "22.1D"}, "suspicious"),
        ({"settled_turbidity_ntu": "21.9D"}, "valid"),
        ({"filtered_turbidity_ntu": "4.81D"}, "suspicious"),
        ({"final_turbidity_ntu": "0.25D"}, "suspicious"),
        ({"head_loss_m": "0.2D"}, "valid"),
        ({"head_loss_m": "0.19D"}, "suspicious"),
    ]
    check(spark, quality.quality_flag(), cases)


def test_flags(spark):
    check(
        spark,
        quality.anomaly_flag(),
        [
            ({}, 0),
            ({"raw_turbidity_ntu": "200D"}, 0),
            ({"raw_turbidity_ntu": "200.1D"}, 1),
            ({"final_turbidity_ntu": "2.1D"}, 1),
            ({"final_residual_chlorine_mg_l": "0.1D"}, 0),
            ({"final_residual_chlorine_mg_l": "0.09D"}, 1),
            ({"head_loss_m": "2.9D"}, 1),
            ({"sludge_blanket_level_m": "2.5D"}, 0),
            ({"sludge_blanket_level_m": "2.6D"}, 1),
            # null or true is true, null or false is not
            ({"head_loss_m": NULL, "sludge_blanket_level_m": "3D"}, 1),
            ({"head_loss_m": NULL}, 0),
        ],
    )
    check(
        spark,
        quality.chlorine_compliance_flag(),
        [
            ({"final_residual_chlorine_mg_l": v}, expected)
            for v, expected in [("0.19D", 0), ("0.2D", 1), ("1D", 1), ("1.01D", 0), (NULL, 0)]
        ],
    )
    check(
        spark,
        quality.backwash_needed_flag(),
        [({}, 0), ({"head_loss_m": "2.81D"}, 1), ({"filtered_turbidity_ntu": "0.81D"}, 1)],
    )
    check(
        spark,
        quality.breached_parameter_count(),
        [
            ({}, 0),
            ({"final_ph": "6.4D", "raw_ammonia_mg_l": "0.31D"}, 2),
            ({"final_ph": "8.5D", "raw_ammonia_mg_l": NULL}, 0),
        ],
    )
    check(
        spark,
        quality.turbidity_removal_pct(),
        [
            ({}, 99.0),
            ({"raw_turbidity_ntu": NULL}, None),
            ({"final_turbidity_ntu": NULL}, None),
            ({"raw_turbidity_ntu": "0.05D", "final_turbidity_ntu": "0.2D"}, -150.0),
        ],
    )


def test_severity(spark):
    columns = GOOD | {
        "breach_flag": "0",
        "anomaly_flag": "0",
        "bacterial_regrowth_risk_score": "0D",
        "contamination_risk_score": "0D",
    }
    check(
        spark,
        quality.severity_level(),
        [
            ({}, "normal"),
            ({"breach_flag": "1"}, "warning"),
            ({"anomaly_flag": "1"}, "warning"),
            ({"final_turbidity_ntu": "1.01D"}, "critical"),
            ({"bacterial_regrowth_risk_score": "60D"}, "critical"),
            ({"contamination_risk_score": "59.99D"}, "normal"),
        ],
        columns,
    )


def test_scores(spark):
    check(
        spark,
        scoring.wqi_score(),
        [
            ({}, 100.0),
            ({"final_turbidity_ntu": "1.3D"}, 80.0),
            ({"final_turbidity_ntu": "9D"}, 65.0),  # capped at 35
            ({"final_residual_chlorine_mg_l": "0.1D"}, 88.0),
            ({"final_ph": "8.6D"}, 85.0),
            ({"raw_ammonia_mg_l": "5D"}, 80.0),  # capped at 20
            ({"raw_ammonia_mg_l": NULL}, 100.0),
            (
                {
                    "final_turbidity_ntu": "9D",
                    "final_residual_chlorine_mg_l": "-1D",
                    "final_ph": "2D",
                    "raw_ammonia_mg_l": "5D",
                },
                0.0,
            ),
        ],
    )
    check(
        spark,
        scoring.contamination_risk(),
        [({}, 0.0), ({"raw_turbidity_ntu": "150D"}, 15.0), ({"raw_ammonia_mg_l": "10D"}, 100.0)],
    )
    check(
        spark,
        scoring.regrowth_risk(),
        [({}, 0.0), ({"raw_temperature_c": "30D"}, 7.0), ({"final_ph": "9D"}, 12.0)],
    )
    check(
        spark,
        scoring.process_performance(),
        [({}, 100.0), ({"head_loss_m": "3D"}, 82.0), ({"settled_turbidity_ntu": "200D"}, 0.0)],
    )
    check(
        spark,
        scoring.wqi_class(),
        [
            ({"wqi_score": f"{v}D"}, name)
            for v, name in [
                (90, "Excellent"),
                (89.99, "Good"),
                (75, "Good"),
                (74.99, "Watch"),
                (60, "Watch"),
                (59.99, "Unsafe"),
            ]
        ],
        {},
    )


def test_health(spark):
    columns = {
        "quality_flag": "'valid'",
        "drift_risk_flag": "0",
        "anomaly_count": "0",
        "missing_readings_count": "0",
    }
    check(
        spark,
        scoring.health_status(),
        [
            ({}, "healthy"),
            ({"quality_flag": "'invalid'", "anomaly_count": "1"}, "critical"),
            ({"anomaly_count": "1"}, "degraded"),
            ({"drift_risk_flag": "1"}, "degraded"),
            ({"missing_readings_count": "1"}, "degraded"),
            ({"quality_flag": "'suspicious'"}, "degraded"),
        ],
        columns,
    )
    check(
        spark,
        scoring.uptime_percentage(),
        [
            ({"quality_flag": f"'{flag}'"}, value)
            for flag, value in [
                ("valid", 100.0),
                ("partial", 85.0),
                ("suspicious", 70.0),
                ("invalid", 40.0),
                ("other", 60.0),
            ]
        ],
        {},
    )
    check(
        spark,
        scoring.drift_risk_flag(),
        [
            ({}, 0),
            ({"final_residual_chlorine_mg_l": "0.05D"}, 1),
            ({"final_residual_chlorine_mg_l": "0.05D", "final_turbidity_ntu": "0.3D"}, 0),
            ({"raw_turbidity_ntu": "121D", "settled_turbidity_ntu": "0.9D"}, 1),
            ({"final_residual_chlorine_mg_l": NULL}, 0),
        ],
    )


NOW = "2024-01-31 00:00:00"
STATUS = {
    "operational_status": "'Active'",
    "latest_reading_timestamp": f"timestamp '{NOW}'",
    "latest_wqi_score": "95D",
    "latest_wqi_class": "'Excellent'",
    "latest_open_alert_type": "cast(null as string)",
    "data_freshness_minutes": "0",
    **{name: "0" for name in ladders.STATUS_COUNTS},
}


def test_water_status(spark):
    cases = [
        ({}, "green", "Water quality is stable and compliant"),
        ({"operational_status": "'Inactive'"}, "gray", "Station not active / under maintenance"),
        (
            {"latest_reading_timestamp": "cast(null as timestamp)"},
            "gray",
            "No sensor data received yet",
        ),
        (
            {"latest_reading_timestamp": "timestamp '2024-01-30 23:39:59'"},
            "gray",
            "No recent data in the freshness window",
        ),
        (
            {"latest_reading_timestamp": "timestamp '2024-01-30 23:40:00'"},
            "green",
            "Water quality is stable and compliant",
        ),
        (
            {"latest_wqi_score": NULL, "latest_wqi_class": "cast(null as string)"},
            "gray",
            "No valid water-quality readings available for WQI",
        ),
        ({"latest_wqi_class": "'Unsafe'"}, "red", "Water Quality Index is Unsafe"),
        (
            {"critical_water_alert_count": "2", "latest_open_alert_type": "'X'"},
            "red",
            "Critical water-safety alert: X",
        ),
        # One critical alert gives the reason but not the colour.
        (
            {"critical_water_alert_count": "1", "latest_open_alert_type": "'X'"},
            "green",
            "Critical water-safety alert: X",
        ),
        (
            {"latest_wqi_class": "'Watch'", "warning_water_alert_count": "3"},
            "orange",
            "Water Quality Index is in Watch range",
        ),
        (
            {"latest_wqi_class": "'Watch'"},
            "green",
            "Water Quality Index is in Watch range",
        ),
        # Three warnings without Watch stay green.
        ({"warning_water_alert_count": "3"}, "green", "Multiple water-quality warnings are open"),
        ({"warning_water_alert_count": "2"}, "yellow", "Multiple water-quality warnings are open"),
        ({"warning_water_alert_count": "1"}, "yellow", "One water-quality warning is open"),
    ]
    check(spark, ladders.water_status_color(NOW, 20), [(c, color) for c, color, _ in cases], STATUS)
    check(spark, ladders.water_status_reason(NOW, 20), [(c, why) for c, _, why in cases], STATUS)


def test_ops_status(spark):
    cases = [
        ({}, "green", "Operations are stable"),
        ({"operational_status": "'Inactive'"}, "gray", "Station not active / under maintenance"),
        (
            {"latest_reading_timestamp": "cast(null as timestamp)"},
            "gray",
            "No sensor stream available",
        ),
        (
            {"latest_reading_timestamp": "timestamp '2024-01-30 23:39:59'"},
            "gray",
            "Telemetry feed is stale",
        ),
        ({"critical_process_alert_count": "2"}, "red", "Multiple critical operational alerts are open"),
        ({"critical_health_samples": "8"}, "red", "Repeated critical sensor-health evidence detected"),
        ({"critical_health_samples": "7"}, "green", "Operations are stable"),
        ({"invalid_count": "40"}, "red", "High invalid-reading load in the last 24 hours"),
        (
            {"critical_process_alert_count": "1"},
            "orange",
            "One critical operational alert requires intervention",
        ),
        ({"warning_process_alert_count": "5"}, "orange", "Multiple operational warnings are open"),
        ({"drift_risk_count": "20"}, "orange", "Persistent sensor drift risk detected"),
        ({"suspicious_count": "40"}, "orange", "High suspicious-reading load in the last 24 hours"),
        ({"degraded_health_samples": "20"}, "orange", "Sensor health shows repeated degradation"),
        ({"warning_process_alert_count": "4"}, "yellow", "Operational warnings require follow-up"),
        ({"warning_process_alert_count": "2"}, "yellow", "Operational warnings require follow-up"),
        ({"warning_process_alert_count": "1"}, "green", "Operations are stable"),
        ({"suspicious_count": "39"}, "yellow", "Moderate suspicious-reading volume needs review"),
        ({"suspicious_count": "10"}, "yellow", "Moderate suspicious-reading volume needs review"),
        ({"suspicious_count": "9"}, "green", "Operations are stable"),
        ({"degraded_health_samples": "5"}, "yellow", "Sensor health shows repeated degradation"),
        (
            {"anomaly_events": "5"},
            "yellow",
            "Multiple operational anomalies observed in the last 24 hours",
        ),
        ({"anomaly_events": "4"}, "green", "Operations are stable"),
    ]
    check(spark, ladders.ops_status_color(NOW, 20), [(c, color) for c, color, _ in cases], STATUS)
    check(spark, ladders.ops_status_reason(NOW, 20), [(c, why) for c, _, why in cases], STATUS)


@pytest.mark.parametrize(
    "water,ops,color,reason",
    [
        ("gray", "red", "gray", "Recent valid data is unavailable or stale"),
        ("red", "red", "red", "w"),
        ("green", "red", "red", "o"),
        ("orange", "yellow", "orange", "w"),
        ("yellow", "orange", "orange", "o"),
        ("yellow", "green", "yellow", "w"),
        ("green", "green", "green", "All monitored quality and operational signals are stable"),
    ],
)
def test_overall_status(spark, water, ops, color, reason):
    columns = STATUS | {
        "water_quality_status_color": text(water),
        "operational_status_color": text(ops),
        "water_quality_status_reason": "'w'",
        "operational_status_reason": "'o'",
    }
    check(spark, ladders.overall_status_color(), [({}, color)], columns)
    check(spark, ladders.overall_status_reason(), [({}, reason)], columns)


def test_overall_gray_reasons(spark):
    columns = STATUS | {
        "water_quality_status_color": "'gray'",
        "operational_status_color": "'gray'",
        "water_quality_status_reason": "'w'",
        "operational_status_reason": "'o'",
    }
    check(
        spark,
        ladders.overall_status_reason(),
        [
            ({"operational_status": "'Inactive'"}, "Station not active / under maintenance"),
            ({"data_freshness_minutes": "cast(null as int)"}, "No incoming telemetry yet"),
        ],
        columns,
    )


def test_snapshot_status(spark):
    columns = {
        "min_wqi": "95D",
        "avg_wqi": "97D",
        "alert_count": "0",
        "critical_alert_count": "0",
        "suspicious_readings_count": "0",
    }
    cases = [
        ({}, "green", "Daily performance remained stable"),
        ({"min_wqi": "59.9D"}, "red", "Daily minimum WQI reached Unsafe range"),
        ({"critical_alert_count": "3"}, "red", "Multiple critical alerts occurred during the day"),
        ({"critical_alert_count": "2"}, "green", "Daily performance remained stable"),
        ({"min_wqi": "60D"}, "orange", "Daily minimum WQI reached Watch range"),
        ({"alert_count": "12"}, "orange", "High alert volume was recorded during the day"),
        (
            {"suspicious_readings_count": "10"},
            "orange",
            "High suspicious-reading volume during the day",
        ),
        ({"avg_wqi": "89.9D", "min_wqi": "75D"}, "yellow", "Average WQI was below Excellent"),
        ({"alert_count": "11"}, "yellow", "Some alerts were recorded during the day"),
        ({"alert_count": "3"}, "yellow", "Some alerts were recorded during the day"),
        (
            {"suspicious_readings_count": "3"},
            "yellow",
            "Some suspicious readings were recorded during the day",
        ),
        ({"suspicious_readings_count": "2"}, "green", "Daily performance remained stable"),
    ]
    check(spark, ladders.snapshot_status_color(), [(c, x) for c, x, _ in cases], columns)
    check(spark, ladders.snapshot_status_reason(), [(c, x) for c, _, x in cases], columns)


def test_platform_labels(spark):
    check(
        spark,
        ladders.readiness_label("s"),
        [
            ({"s": f"{v}D"}, name)
            for v, name in [
                (90, "Stable"),
                (89.9, "Controlled Monitoring"),
                (75, "Controlled Monitoring"),
                (60, "Elevated Operational Risk"),
                (59.9, "Attention Required"),
            ]
        ],
        {},
    )
    none = dict.fromkeys(
        ["red_stations", "orange_stations", "yellow_stations", "open_critical_records"], "0"
    )
    check(
        spark,
        ladders.headline_status(),
        [
            ({}, "Stable"),
            ({"yellow_stations": "1"}, "Controlled Monitoring"),
            ({"orange_stations": "1", "yellow_stations": "1"}, "Elevated Operational Risk"),
            ({"red_stations": "1"}, "Attention Required"),
            ({"open_critical_records": "1"}, "Attention Required"),
        ],
        none,
    )
    check(
        spark,
        ladders.status_label("c"),
        [({"c": "'GREEN'"}, "Stable"), ({"c": "'gray'"}, "No Data"), ({"c": "'blue'"}, "Unknown")],
        {},
    )


def test_time_parts(spark):
    check(
        spark,
        minutes_between("a", "b"),
        [
            ({"a": "timestamp '2024-01-01 10:00:59'", "b": "timestamp '2024-01-01 10:01:01'"}, 1),
            ({"a": "timestamp '2024-01-01 10:00:00'", "b": "timestamp '2024-01-01 10:00:59'"}, 0),
            ({"a": "cast(null as timestamp)", "b": "timestamp '2024-01-01 10:00:59'"}, None),
        ],
        {},
    )
    check(spark, date_key("t"), [({"t": "timestamp '2024-03-09 01:02:03'"}, 20240309)], {})
    check(spark, time_key("t"), [({"t": "timestamp '2024-03-09 01:02:03'"}, 10203)], {})
    check(
        spark,
        week_of_year_sunday("d"),
        [
            ({"d": "date '2025-01-01'"}, 1),
            ({"d": "date '2025-01-04'"}, 1),
            ({"d": "date '2025-01-05'"}, 2),
            ({"d": "date '2025-12-31'"}, 53),
        ],
        {},
    )


def test_totals_carry_full_units(spark):
    """Billionths never pass one unit, so totals of totals stay far below the bigint limit."""
    from pyspark.sql import functions as F

    from hydrolens.functions import common

    values = spark.range(1000).select(F.lit(0.999999999).alias("x"))
    totals = values.agg(*common.exact_totals("x")).first()
    assert (totals.x_whole, totals.x_billionths, totals.x_n) == (999, 999999000, 1000)
    many = spark.range(30).select(
        F.lit(10**17).alias("x_whole"), F.lit(999999999).alias("x_billionths"), F.lit(10**17).alias("x_n")
    )
    assert many.agg(common.combined_average("x")).first()[0] == 1.0
    assert values.agg(common.exact_avg("x")).first()[0] == 0.999999999
