"""Invariants of facts and marts, exact averages, quantiles and plan shapes."""

import math
import random
import re

import numpy as np
import pytest

from hydrolens.functions.common import exact_avg
from hydrolens.operators.latest import first_per_key
from hydrolens.operators.quantiles import exact_quantiles
from hydrolens.plans import reports

MARTS = {
    "mart_station_latest_status": ["station_id"],
    "mart_governorate_daily_summary": ["summary_date", "governorate"],
    "mart_parameter_trend": ["trend_date", "time_bucket_hour", "governorate", "parameter_name"],
    "mart_alert_monitor": ["alert_id"],
    "mart_data_quality_monitor": ["summary_date", "station_id", "sensor_id"],
    "mart_station_daily_snapshot": ["summary_date", "station_id"],
    "mart_system_readiness_summary": ["summary_date"],
}


@pytest.fixture(scope="module")
def marts(telemetry):
    return telemetry.stored.all()


@pytest.mark.parametrize("name", MARTS)
def test_mart_keys_are_unique(marts, name):
    mart = marts[name]
    assert mart.count() == mart.select(MARTS[name]).distinct().count() > 0


def test_flags_partition_the_readings(marts):
    for row in marts["mart_system_readiness_summary"].collect():
        parts = [row[f"{flag}_readings"] for flag in ("valid", "partial", "invalid", "suspicious")]
        assert sum(parts) == row["total_readings"]
        colors = [row[f"{c}_station_count"] for c in ("green", "yellow", "orange", "red", "gray")]
        assert sum(colors) == row["active_station_count"] == 26


def test_scores_are_bounded(telemetry):
    names = [
        "wqi_score",
        "process_performance_score",
        "contamination_risk_score",
        "bacterial_regrowth_risk_score",
    ]
    bad = " or ".join(f"not ({name} between 0 and 100)" for name in names)
    assert telemetry.scored.filter(bad).isEmpty()


def test_alerts_are_open_or_resolved(marts, telemetry):
    alerts = marts["mart_alert_monitor"]
    assert alerts.filter("status not in ('open', 'resolved')").isEmpty()
    assert reports.mart_health(marts).first()["ready_marts"] == 7


def test_filters_of_reports(marts):
    quality = marts["mart_data_quality_monitor"]
    everything = reports.data_trust_kpis(quality).first()
    parts = [
        reports.data_trust_kpis(quality, band=band).first() for band in reports.BANDS.values()
    ]
    assert everything["total_readings"] == sum(p["total_readings"] for p in parts) == 1000
    nothing = reports.data_trust_kpis(quality, governorate="nowhere").first()
    assert nothing["total_readings"] == 0 and nothing["valid_pct"] == 0.0
    assert nothing["avg_quality_score"] is None


def test_exact_avg_does_not_depend_on_order(spark):
    values = [random.Random(1).uniform(-5, 1000) for _ in range(2000)]
    shuffled = sorted(values)
    schema = "x double"
    a = spark.createDataFrame([(v,) for v in values], schema).repartition(7)
    b = spark.createDataFrame([(v,) for v in shuffled], schema).repartition(3)
    got = {df.agg(exact_avg("x")).first()[0] for df in (a, b)}
    assert len(got) == 1
    assert math.isclose(got.pop(), math.fsum(values) / len(values), abs_tol=1e-9)
    assert spark.createDataFrame([(None,)], schema).agg(exact_avg("x")).first()[0] is None


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    found = first_per_key(df, ["k"], [df.v.desc()])
    assert {r["k"]: r["v"] for r in found.collect()}[0] == 2997
    assert found.count() == 2001


def test_quantiles_against_numpy(spark):
    rng = random.Random(2)
    rows = [("even", rng.uniform(0, 100)) for _ in range(501)]
    rows += [("hot", 100.0)] * 400 + [("hot", 99.999), ("hot", 3.0)]
    rows += [("one", 42.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    fractions = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    found = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", fractions, 0.05).collect()}
    assert found.keys() == {"even", "hot", "one", "two"}
    for group, row in found.items():
        values = [v for g, v in rows if g == group]
        assert row["points"] == len(values)
        for name, fraction in fractions.items():
            assert math.isclose(row[name], np.quantile(values, fraction), abs_tol=1e-9)


# --- plans ------------------------------------------------------------------------------
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_is_limited_before_the_shuffle(telemetry):
    text = plan(telemetry.day.newest_wqi)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_rollups_use_hash_aggregates(telemetry):
    for frame in (
        telemetry.day.quality_daily,
        telemetry.day.wqi_totals,
        telemetry.day.parameter_hourly,
        telemetry.day.health_daily,
        telemetry.day.newest_reading,
    ):
        text = plan(frame)
        assert "HashAggregate" in text and "SortAggregate" not in text
        assert text.count("Exchange hashpartitioning") == 1


def test_recent_hours_prune_stored_partitions(spark, telemetry, tmp_path):
    from hydrolens.plans import rollups as R

    path = str(tmp_path / "fact")
    telemetry.readings.write.partitionBy("event_date").parquet(path)
    text = plan(R.recent_quality(spark.read.parquet(path), "2024-01-31 00:00:00", 24))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-01-30", text)
    assert "GreaterThanOrEqual(event_timestamp" in text
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", scan)) == {
        "station_id",
        "event_timestamp",
        "quality_flag",
        "anomaly_flag",
    }
