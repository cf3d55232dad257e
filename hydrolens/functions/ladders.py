"""Status ladders of stations, days and the platform, as SQL expressions.

Colour and reason of one status have separate ladders whose limits differ on purpose.
"""

from __future__ import annotations

import datetime as dt

from hydrolens import schema as S
from hydrolens.functions.common import any_of, case, ladder, minutes_before, text

NOT_ACTIVE = "operational_status <> 'Active'"
SILENT = "latest_reading_timestamp is null"
NO_WQI = "latest_wqi_score is null"

# Counts of stations that have no row in a joined frame are zero.
STATUS_COUNTS = (
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


def _stale(as_of: dt.datetime | str, freshness_minutes: int) -> str:
    return f"latest_reading_timestamp < {minutes_before(as_of, freshness_minutes)}"


def water_status_color(as_of: dt.datetime | str, freshness_minutes: int) -> str:
    return ladder(
        [
            (any_of(NOT_ACTIVE, SILENT, _stale(as_of, freshness_minutes), NO_WQI), "gray"),
            (any_of("latest_wqi_class = 'Unsafe'", "critical_water_alert_count >= 2"), "red"),
            ("latest_wqi_class = 'Watch' and warning_water_alert_count >= 3", "orange"),
            ("warning_water_alert_count between 1 and 2", "yellow"),
        ],
        "green",
    )


def water_status_reason(as_of: dt.datetime | str, freshness_minutes: int) -> str:
    # Reasons.
    branches = [
        (NOT_ACTIVE, text("Station not active / under maintenance")),
        (SILENT, text("No sensor data received yet")),
        (_stale(as_of, freshness_minutes), text("No recent data in the freshness window")),
        (NO_WQI, text("No valid water-quality readings available for WQI")),
        (
            "critical_water_alert_count >= 1 and latest_open_alert_type is not null",
            f"concat({text('Critical water-safety alert: ')}, latest_open_alert_type)",
        ),
        ("latest_wqi_class = 'Unsafe'", text("Water Quality Index is Unsafe")),
        ("latest_wqi_class = 'Watch'", text("Water Quality Index is in Watch range")),
        ("warning_water_alert_count >= 2", text("Multiple water-quality warnings are open")),
        ("warning_water_alert_count = 1", text("One water-quality warning is open")),
    ]
    return case(branches, text("Water quality is stable and compliant"))


def ops_status_color(as_of: dt.datetime | str, freshness_minutes: int) -> str:
    red = any_of(
        "critical_process_alert_count >= 2",
        "critical_health_samples >= 8",
        "invalid_count >= 40",
    )
    orange = any_of(
        "critical_process_alert_count = 1",
        "warning_process_alert_count >= 5",
        "drift_risk_count >= 20",
        "suspicious_count >= 40",
        "degraded_health_samples >= 20",
    )
    yellow = any_of(
        "warning_process_alert_count between 2 and 4",
        "suspicious_count between 10 and 39",
        "degraded_health_samples between 5 and 19",
        "anomaly_events >= 5",
    )
    return ladder(
        [
            (any_of(NOT_ACTIVE, SILENT, _stale(as_of, freshness_minutes)), "gray"),
            (red, "red"),
            (orange, "orange"),
            (yellow, "yellow"),
        ],
        "green",
    )


def ops_status_reason(as_of: dt.datetime | str, freshness_minutes: int) -> str:
    # Reasons.
    return ladder(
        [
            (NOT_ACTIVE, "Station not active / under maintenance"),
            (SILENT, "No sensor stream available"),
            (_stale(as_of, freshness_minutes), "Telemetry feed is stale"),
            ("critical_process_alert_count >= 2", "Multiple critical operational alerts are open"),
            ("critical_health_samples >= 8", "Repeated critical sensor-health evidence detected"),
            ("invalid_count >= 40", "High invalid-reading load in the last 24 hours"),
            (
                "critical_process_alert_count = 1",
                "One critical operational alert requires intervention",
            ),
            ("warning_process_alert_count >= 5", "Multiple operational warnings are open"),
            ("drift_risk_count >= 20", "Persistent sensor drift risk detected"),
            ("suspicious_count >= 40", "High suspicious-reading load in the last 24 hours"),
            ("degraded_health_samples >= 20", "Sensor health shows repeated degradation"),
            (
                "warning_process_alert_count between 2 and 4",
                "Operational warnings require follow-up",
            ),
            (
                "suspicious_count between 10 and 39",
                "Moderate suspicious-reading volume needs review",
            ),
            (
                "degraded_health_samples between 5 and 19",
                "Sensor health shows repeated degradation",
            ),
            (
                "anomaly_events >= 5",
                "Multiple operational anomalies observed in the last 24 hours",
            ),
        ],
        "Operations are stable",
    )


# Colours from worst to best; gray hides all others.
WORST_FIRST = ("gray", "red", "orange", "yellow")


def _either(color: str) -> str:
    return f"water_quality_status_color = '{color}' or operational_status_color = '{color}'"


def overall_status_color() -> str:
    return ladder([(_either(color), color) for color in WORST_FIRST], "green")


def overall_status_reason() -> str:
    """The reason of the colour that won; water goes before operations."""
    # Reasons.
    gray_reason = ladder(
        [
            (NOT_ACTIVE, "Station not active / under maintenance"),
            ("data_freshness_minutes is null", "No incoming telemetry yet"),
        ],
        "Recent valid data is unavailable or stale",
    )
    branches = [(_either("gray"), gray_reason)]
    for color in WORST_FIRST[1:]:
        branches += [
            (f"water_quality_status_color = '{color}'", "water_quality_status_reason"),
            (f"operational_status_color = '{color}'", "operational_status_reason"),
        ]
    return case(branches, text("All monitored quality and operational signals are stable"))


def status_priority(color: str = "overall_status_color") -> str:
    ranks = [(f"{color} = '{name}'", str(rank)) for name, rank in S.COLOR_PRIORITY.items()]
    return case(ranks, "1")


def status_label(color: str = "overall_status_color") -> str:
    return ladder(
        [(f"lower({color}) = '{name}'", label) for name, label in S.COLOR_LABELS.items()],
        "Unknown",
    )


def snapshot_status_color() -> str:
    return ladder(
        [
            (any_of("min_wqi < 60", "critical_alert_count >= 3"), "red"),
            (
                any_of("min_wqi < 75", "alert_count >= 12", "suspicious_readings_count >= 10"),
                "orange",
            ),
            (
                any_of(
                    "avg_wqi < 90",
                    "alert_count between 3 and 11",
                    "suspicious_readings_count between 3 and 9",
                ),
                "yellow",
            ),
        ],
        "green",
    )


def snapshot_status_reason() -> str:
    # Reasons.
    return ladder(
        [
            ("min_wqi < 60", "Daily minimum WQI reached Unsafe range"),
            ("critical_alert_count >= 3", "Multiple critical alerts occurred during the day"),
            ("min_wqi < 75", "Daily minimum WQI reached Watch range"),
            ("alert_count >= 12", "High alert volume was recorded during the day"),
            (
                "suspicious_readings_count >= 10",
                "High suspicious-reading volume during the day",
            ),
            ("avg_wqi < 90", "Average WQI was below Excellent"),
            ("alert_count between 3 and 11", "Some alerts were recorded during the day"),
            (
                "suspicious_readings_count between 3 and 9",
                "Some suspicious readings were recorded during the day",
            ),
        ],
        "Daily performance remained stable",
    )


def readiness_label(score: str) -> str:
    # Labels.
    return ladder(
        [
            (f"{score} >= 90", "Stable"),
            (f"{score} >= 75", "Controlled Monitoring"),
            (f"{score} >= 60", "Elevated Operational Risk"),
        ],
        "Attention Required",
    )


def headline_status() -> str:
    # Labels.
    return ladder(
        [
            ("red_stations > 0 or open_critical_records > 0", "Attention Required"),
            ("orange_stations > 0", "Elevated Operational Risk"),
            ("yellow_stations > 0", "Controlled Monitoring"),
        ],
        "Stable",
    )
