"""Row-level validation as SQL expressions: quality flag, anomaly, compliance, severity."""

from __future__ import annotations

from hydrolens import schema as S
from hydrolens.functions.common import any_of, flag, ladder, num

PH_OUT_OF_BAND = f"final_ph < {num(S.PH_SAFE[0])} or final_ph > {num(S.PH_SAFE[1])}"

# Limits whose breach is counted per reading.
BREACHES = (
    "final_residual_chlorine_mg_l < 0.20D",
    "final_turbidity_ntu > 0.30D",
    PH_OUT_OF_BAND,
    "filtered_turbidity_ntu > 0.30D",
    "head_loss_m > 2.8D",
    "raw_ammonia_mg_l > 0.30D",
)

# What makes a reading anomalous.
ANOMALIES = (
    "raw_turbidity_ntu > 200",
    "final_turbidity_ntu > 2.0D",
    "final_residual_chlorine_mg_l < 0.10D",
    "head_loss_m > 2.8D",
    "sludge_blanket_level_m > 2.5D",
)

# What makes a reading critical.
CRITICAL = (
    "final_residual_chlorine_mg_l < 0.10D",
    "final_turbidity_ntu > 1.0D",
    "head_loss_m > 2.8D",
    "bacterial_regrowth_risk_score >= 60",
    "contamination_risk_score >= 60",
)


def quality_flag() -> str:
    """invalid / partial / suspicious / valid.

    Missing key measures are looked at first, then physical ranges, then the relation
    between treatment stages. A null operand makes a check pass.
    """
    impossible = [
        (f"not ({name} between {low} and {high})", "invalid")
        for name, (low, high) in S.PHYSICAL_RANGES.items()
    ]
    rising_turbidity = [
        (f"{lower} > {upper} * {num(factor)}", "suspicious")
        for lower, upper, factor in S.STAGE_FACTORS
    ]
    return ladder(
        [
            ("event_timestamp is null", "invalid"),
            (any_of(*(f"{name} is null" for name in S.KEY_MEASURES)), "partial"),
            *impossible,
            *rising_turbidity,
            (f"abs(final_ph - raw_ph) > {num(S.MAX_PH_SHIFT)}", "suspicious"),
            (f"head_loss_m < {num(S.MIN_HEAD_LOSS)}", "suspicious"),
        ],
        "valid",
    )


def anomaly_flag() -> str:
    return flag(any_of(*ANOMALIES))


def turbidity_removal_pct() -> str:
    # greatest() skips nulls, but the numerator is null when either measure is.
    removed = "(raw_turbidity_ntu - final_turbidity_ntu) / greatest(raw_turbidity_ntu, 0.1D)"
    return f"round({removed} * 100, 2)"


def chlorine_compliance_flag() -> str:
    return flag("final_residual_chlorine_mg_l between 0.20D and 1.00D")


def backwash_needed_flag() -> str:
    return flag("head_loss_m > 2.8D or filtered_turbidity_ntu > 0.8D")


def breach_flag() -> str:
    return flag(any_of(*BREACHES))


def breached_parameter_count() -> str:
    return " + ".join(flag(condition) for condition in BREACHES)


def severity_level() -> str:
    """Needs breach_flag, anomaly_flag and the two risk scores as columns."""
    warning = "breach_flag = 1 or anomaly_flag = 1"
    return ladder([(any_of(*CRITICAL), "critical"), (warning, "warning")], "normal")


def is_business_row() -> str:
    """Valid readings that carry every measure the index and alerts need."""
    present = [f"{name} is not null" for name in S.BUSINESS_MEASURES]
    return " and ".join(["quality_flag = 'valid'", *present])
