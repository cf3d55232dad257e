"""Alert rules, candidates and the open/resolved lifecycle.

The lifecycle needs no row updates. Two logs are kept, both written once per batch:

* the alert log holds the newest candidate per batch, station and alert type;
* the heartbeat log holds, per batch and station, which alert types were raised.

An alert is open until a later batch has business rows for its station and does not raise
its type again. So the status follows from the last batch that cleared the type, which is
one aggregate over the heartbeats.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolens.functions.common import case, ladder, num, text
from hydrolens.operators.latest import first_per_key


@dataclass(frozen=True)
class AlertRule:
    alert_type: str
    parameter_code: str
    stage_name: str
    fires: str
    critical: str
    threshold_min: float
    threshold_max: float
    message: str


# Alert types, limits, severities and messages.
RULES = (
    AlertRule(
        "LOW_FINAL_CHLORINE",
        "final_residual_chlorine_mg_l",
        "final_outlet",
        "final_residual_chlorine_mg_l < 0.20D",
        "final_residual_chlorine_mg_l < 0.10D",
        0.20,
        1.00,
        "Residual chlorine at final outlet is below safe threshold.",
    ),
    AlertRule(
        "HIGH_FINAL_TURBIDITY",
        "final_turbidity_ntu",
        "final_outlet",
        "final_turbidity_ntu > 0.50D",
        "final_turbidity_ntu > 1.0D",
        0.0,
        0.50,
        "Final outlet turbidity exceeds acceptable drinking-water range.",
    ),
    AlertRule(
        "FINAL_PH_OUT_OF_RANGE",
        "final_ph",
        "final_outlet",
        "final_ph < 6.5D or final_ph > 8.5D",
        "false",
        6.5,
        8.5,
        "Final outlet pH is outside the recommended operating range.",
    ),
    AlertRule(
        "FILTER_BACKWASH_NEEDED",
        "head_loss_m",
        "filtration_outlet",
        "head_loss_m > 2.8D",
        "true",
        0.2,
        2.8,
        "Filter head loss indicates urgent backwash requirement.",
    ),
    AlertRule(
        "FILTER_EFFLUENT_TURBIDITY_HIGH",
        "filtered_turbidity_ntu",
        "filtration_outlet",
        "filtered_turbidity_ntu > 0.50D",
        "false",
        0.0,
        0.50,
        "Filtered water turbidity is above recommended value.",
    ),
    AlertRule(
        "RAW_AMMONIA_HIGH",
        "raw_ammonia_mg_l",
        "raw_intake",
        "raw_ammonia_mg_l > 0.30D",
        "false",
        0.0,
        0.30,
        "Raw water ammonia is elevated and may indicate contamination pressure.",
    ),
    AlertRule(
        "SLUDGE_BLANKET_HIGH",
        "sludge_blanket_level_m",
        "sedimentation_outlet",
        "sludge_blanket_level_m > 2.5D",
        "false",
        0.0,
        2.5,
        "Sludge blanket level is high and may impact clarification performance.",
    ),
    AlertRule(
        "BACTERIAL_REGROWTH_RISK",
        "bacterial_regrowth_risk_score",
        "derived",
        "bacterial_regrowth_risk_score >= 60",
        "true",
        0.0,
        30.0,
        "Proxy bacterial regrowth risk is critically elevated.",
    ),
    AlertRule(
        "CONTAMINATION_RISK_HIGH",
        "contamination_risk_score",
        "derived",
        "contamination_risk_score >= 60",
        "true",
        0.0,
        30.0,
        "Composite contamination risk score is critically high.",
    ),
)

# Types counted as water alerts and as process alerts.
WATER_TYPES = (
    "HIGH_FINAL_TURBIDITY",
    "LOW_FINAL_CHLORINE",
    "FINAL_PH_OUT_OF_RANGE",
    "BACTERIAL_REGROWTH_RISK",
    "CONTAMINATION_RISK_HIGH",
)
PROCESS_TYPES = (
    "FILTER_BACKWASH_NEEDED",
    "FILTER_EFFLUENT_TURBIDITY_HIGH",
    "SLUDGE_BLANKET_HIGH",
    "RAW_AMMONIA_HIGH",
)

# Domain shown for a type.
DOMAINS = {
    "water_quality": ("HIGH_FINAL_TURBIDITY", "LOW_FINAL_CHLORINE", "FINAL_PH_OUT_OF_RANGE"),
    "process": (
        "FILTER_BACKWASH_NEEDED",
        "FILTER_EFFLUENT_TURBIDITY_HIGH",
        "SLUDGE_BLANKET_HIGH",
    ),
    "source_water": ("RAW_AMMONIA_HIGH",),
    "derived_risk": ("BACTERIAL_REGROWTH_RISK", "CONTAMINATION_RISK_HIGH"),
}

# What identifies the alert of one rule at one station.
ALERT_KEY = ["station_id", "alert_type"]


def alert_hits(business: DataFrame) -> DataFrame:
    """One narrow row per fired rule; what is fixed per rule is added by `describe_alerts`.

    All rules are looked at in one pass. A rule that does not fire gives a null value, and its
    row goes no further than the generator.
    """
    rows = [
        f"'{rule.alert_type}', case when {rule.fires} then {rule.parameter_code} end, "
        f"{rule.critical}"
        for rule in RULES
    ]
    carried = ["reading_id", "station_id", "sensor_id", "event_timestamp"]
    carried += [name for name in ["batch"] if name in business.columns]
    severity = ladder([("is_critical", "critical")], "warning")
    return (
        business.selectExpr(
            *carried,
            f"stack({len(RULES)}, {', '.join(rows)}) as (alert_type, measured_value, is_critical)",
        )
        .filter("measured_value is not null")
        .selectExpr(*carried, "alert_type", f"{severity} as severity_level", "measured_value")
    )


def _rule_text(attribute: str) -> str:
    return case(
        [(f"alert_type = '{rule.alert_type}'", text(getattr(rule, attribute))) for rule in RULES],
        "null",
    )


def _rule_number(attribute: str) -> str:
    return case(
        [(f"alert_type = '{rule.alert_type}'", num(getattr(rule, attribute))) for rule in RULES],
        "null",
    )


def describe_alerts(hits: DataFrame) -> DataFrame:
    """Adds parameter, stage, thresholds and message of the rule, without a join."""
    return hits.selectExpr(
        "*",
        f"{_rule_text('parameter_code')} as parameter_code",
        f"{_rule_text('stage_name')} as stage_name",
        f"{_rule_number('threshold_min')} as threshold_min",
        f"{_rule_number('threshold_max')} as threshold_max",
        f"{_rule_text('message')} as alert_message",
    )


def alert_candidates(business: DataFrame) -> DataFrame:
    return describe_alerts(alert_hits(business)).withColumn("status", F.lit("open"))


# Station, type, stage and event second.
ALERT_ID = (
    "concat_ws('-', station_id, alert_type, replace(coalesce(stage_name, 'na'), ' ', '_'), "
    "date_format(event_timestamp, 'yyyyMMdd'), date_format(event_timestamp, 'HHmmss'))"
)

ALERT_DOMAIN = ladder(
    [
        (f"alert_type in ({', '.join(text(t) for t in types)})", name)
        for name, types in DOMAINS.items()
    ],
    "other",
)


def alert_log(business: DataFrame) -> DataFrame:
    """Newest hit per batch, station and type. `business` has a `batch` column."""
    newest = [F.col("event_timestamp").desc(), F.col("reading_id").asc()]
    return first_per_key(alert_hits(business), ["batch", *ALERT_KEY], newest)


def heartbeat_log(business: DataFrame) -> DataFrame:
    """One row per batch and station, with one boolean per alert type."""
    return business.groupBy("batch", "station_id").agg(
        *[
            F.expr(f"bool_or(coalesce({rule.fires}, false))").alias(rule.alert_type)
            for rule in RULES
        ]
    )


def merge_alerts(log: DataFrame) -> DataFrame:
    """One row per alert: a later batch overwrites the same station, type and second."""
    with_second = log.withColumn("__second", F.date_trunc("second", "event_timestamp"))
    return first_per_key(
        with_second, [*ALERT_KEY, "__second"], [F.col("batch").desc()]
    ).drop("__second")


def last_clears(heartbeats: DataFrame) -> DataFrame:
    """Per station and type, the last batch that reported without raising the type.

    Two hash aggregates over fixed-width values: rows of a hot station are combined in the
    map tasks, first to its batches, then to one row."""
    types = [rule.alert_type for rule in RULES]
    cleared = heartbeats.groupBy("station_id").agg(
        *[F.max(F.when(~F.col(name), F.col("batch"))).alias(name) for name in types]
    )
    return cleared.unpivot("station_id", types, "alert_type", "cleared_batch").filter(
        "cleared_batch is not null"
    )


def newer_clears(*clears: DataFrame) -> DataFrame:
    """The later of several frames of last clears, per station and type."""
    together = reduce(DataFrame.unionByName, clears)
    return together.groupBy(ALERT_KEY).agg(F.max("cleared_batch").alias("cleared_batch"))


def alert_lifecycle(log: DataFrame, clears: DataFrame) -> DataFrame:
    """Merged alerts with their status and the batch they were last raised in."""
    joined = merge_alerts(log).join(clears, ALERT_KEY, "left")
    status = ladder([("cleared_batch > batch", "resolved")], "open")
    return joined.withColumn("status", F.expr(status))
