"""Risk, performance and water-quality scores and sensor health, as SQL expressions.

A score is a sum of penalties, one for each measure beyond its limit.
"""

from __future__ import annotations

from hydrolens.functions.common import any_of, case, clamp, flag, ladder, num
from hydrolens.functions.quality import PH_OUT_OF_BAND


def _penalty(condition: str, amount: str, cap: float | None) -> str:
    if cap is not None:
        amount = f"least({amount}, {num(cap)})"
    return f"case when {condition} then {amount} else 0.0D end"


def above(measure: str, limit: float, weight: float, cap: float | None = None) -> str:
    excess = f"({measure} - {num(limit)}) * {num(weight)}"
    return _penalty(f"{measure} > {num(limit)}", excess, cap)


def below(measure: str, limit: float, weight: float, cap: float | None = None) -> str:
    shortfall = f"({num(limit)} - {measure}) * {num(weight)}"
    return _penalty(f"{measure} < {num(limit)}", shortfall, cap)


def ph_penalty(points: float) -> str:
    return _penalty(PH_OUT_OF_BAND, num(points), None)


def risk(penalties: list[str]) -> str:
    """Penalties added up, at most 100."""
    return f"least(100.0D, round({' + '.join(penalties)}, 2))"


def merit(penalties: list[str]) -> str:
    """100 less the penalties, between 0 and 100."""
    return clamp(f"round(100.0D - ({' + '.join(penalties)}), 2)")


# Fixed values below: limits, weights and caps of the scores.
def contamination_risk() -> str:
    return risk(
        [
            above("raw_ammonia_mg_l", 0.30, 40),
            above("raw_turbidity_ntu", 50, 0.15),
            above("settled_turbidity_ntu", 10, 1.2),
            above("filtered_turbidity_ntu", 0.3, 18),
            above("final_turbidity_ntu", 0.3, 22),
            ph_penalty(15),
        ]
    )


def regrowth_risk() -> str:
    return risk(
        [
            below("final_residual_chlorine_mg_l", 0.20, 150),
            above("final_turbidity_ntu", 0.30, 25),
            above("raw_temperature_c", 28, 3.5),
            above("raw_ammonia_mg_l", 0.20, 35),
            ph_penalty(12),
        ]
    )


def process_performance() -> str:
    return merit(
        [
            above("settled_turbidity_ntu", 10, 1.5),
            above("filtered_turbidity_ntu", 0.3, 15),
            above("head_loss_m", 2.0, 18),
            above("filtration_rate_m_h", 9.0, 6),
            above("final_turbidity_ntu", 0.3, 20),
        ]
    )


def wqi_score() -> str:
    return merit(
        [
            above("final_turbidity_ntu", 0.3, 20, cap=35),
            below("final_residual_chlorine_mg_l", 0.20, 120, cap=30),
            ph_penalty(15),
            above("raw_ammonia_mg_l", 0.30, 35, cap=20),
        ]
    )


def wqi_class(score: str = "wqi_score") -> str:
    return ladder(
        [(f"{score} >= 90", "Excellent"), (f"{score} >= 75", "Good"), (f"{score} >= 60", "Watch")],
        "Unsafe",
    )


# Uptime credited for a reading of each quality.
UPTIME_BY_QUALITY = {"valid": 100.0, "partial": 85.0, "suspicious": 70.0, "invalid": 40.0}
UPTIME_UNKNOWN = 60.0


def uptime_percentage() -> str:
    return case(
        [(f"quality_flag = '{name}'", num(uptime)) for name, uptime in UPTIME_BY_QUALITY.items()],
        num(UPTIME_UNKNOWN),
    )


def drift_risk_flag() -> str:
    return flag(
        any_of(
            "final_residual_chlorine_mg_l < 0.10D and final_turbidity_ntu < 0.30D",
            "raw_turbidity_ntu > 120 and settled_turbidity_ntu < 1.0D",
        )
    )


def health_status() -> str:
    """Needs drift_risk_flag, anomaly_count and missing_readings_count as columns."""
    degraded = any_of(
        "drift_risk_flag = 1",
        "anomaly_count >= 1",
        "missing_readings_count >= 1",
        "quality_flag = 'suspicious'",
    )
    return ladder([("quality_flag = 'invalid'", "critical"), (degraded, "degraded")], "healthy")


def data_quality_points() -> str:
    return case([("health_status = 'healthy'", "95"), ("health_status = 'degraded'", "75")], "45")


def data_quality_band(score: str) -> str:
    return ladder([(f"{score} >= 90", "Trusted"), (f"{score} >= 75", "Monitor")], "At Risk")
