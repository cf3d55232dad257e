"""The alert lifecycle against a batch-by-batch replay."""

import pytest
from pyspark.sql import functions as F

from hydrolens.operators import alerts as A
from hydrolens.plans import facts as facts_plan


def replay(hits, beats):
    """MERGE by alert id and resolve, one batch after the other."""
    table = {}
    for batch in sorted({b for b, _ in beats}):
        newest = {}
        raised = set()
        for hit in (h for h in hits if h["batch"] == batch):
            key = (hit["station_id"], hit["alert_type"])
            raised.add(key)
            best = newest.get(key)
            if best is None or (hit["event_timestamp"], best["reading_id"]) > (
                best["event_timestamp"],
                hit["reading_id"],
            ):
                newest[key] = hit
        for (station, kind), hit in newest.items():
            second = hit["event_timestamp"].replace(microsecond=0)
            table[(station, kind, second)] = [hit["reading_id"], "open"]
        reporting = {s for b, s in beats if b == batch}
        for (station, kind, _), row in table.items():
            if row[1] == "open" and station in reporting and (station, kind) not in raised:
                row[1] = "resolved"
    return {(s, k, t, row[0], row[1]) for (s, k, t), row in table.items()}


def closed_form(business):
    alerts = A.alert_lifecycle(A.alert_log(business), A.last_clears(A.heartbeat_log(business)))
    rows = alerts.select("station_id", "alert_type", "event_timestamp", "reading_id", "status")
    return {
        (r[0], r[1], r[2].replace(microsecond=0), r[3], r[4]) for r in rows.collect()
    }


@pytest.mark.parametrize("hours", [24, 36, 5])
def test_lifecycle_equals_replay(telemetry, hours):
    """Batches of several lengths; with 5 hours many stations skip batches."""
    business = facts_plan.business_rows(telemetry.scored).withColumn(
        "batch", F.floor(F.unix_timestamp("event_timestamp") / (hours * 3600))
    )
    hits = [r.asDict() for r in A.alert_hits(business).collect()]
    beats = {(r[0], r[1]) for r in business.select("batch", "station_id").distinct().collect()}
    expected = replay(hits, beats)
    assert closed_form(business) == expected
    assert {row[4] for row in expected} == {"open", "resolved"}


COLUMNS = {rule.parameter_code: "0D" for rule in A.RULES} | {
    "final_residual_chlorine_mg_l": "0.5D",
    "final_ph": "7D",
    "head_loss_m": "1D",
}


def frame(spark, rows):
    """rows: (batch, reading_id, station, sensor, second, {changed measures})"""
    selects = []
    for batch, reading, station, sensor, stamp, changes in rows:
        cells = [
            f"{batch}L as batch",
            f"'{reading}' as reading_id",
            f"'{station}' as station_id",
            f"'{sensor}' as sensor_id",
            f"timestamp '2024-01-01 {stamp}' as event_timestamp",
        ]
        cells += [f"{v} as {k}" for k, v in (COLUMNS | changes).items()]
        selects.append("select " + ", ".join(cells))
    return spark.sql(" union all ".join(selects))


LOW = {"final_residual_chlorine_mg_l": "0.15D"}
VERY_LOW = {"final_residual_chlorine_mg_l": "0.05D"}


def states(spark, rows):
    business = frame(spark, rows)
    found = A.alert_lifecycle(A.alert_log(business), A.last_clears(A.heartbeat_log(business)))
    return {(r["reading_id"], r["severity_level"], r["status"]) for r in found.collect()}


def test_same_second_in_a_later_batch_overwrites_and_reopens(spark):
    rows = [
        (1, "a", "S", "x", "10:00:00", LOW),
        (2, "b", "S", "x", "10:05:00", {}),  # resolves
        (3, "c", "S", "y", "10:00:00.5", VERY_LOW),  # same second as a
    ]
    assert states(spark, rows) == {("c", "critical", "open")}


def test_each_batch_adds_an_open_row_until_cleared(spark):
    rows = [
        (1, "a", "S", "x", "10:00:00", LOW),
        (2, "b", "S", "x", "10:01:00", LOW),
        (3, "c", "T", "x", "10:02:00", {}),  # another station reports
    ]
    assert states(spark, rows) == {("a", "warning", "open"), ("b", "warning", "open")}
    rows.append((4, "d", "S", "x", "10:03:00", {"head_loss_m": "2.9D"}))
    assert states(spark, rows) == {
        ("a", "warning", "resolved"),
        ("b", "warning", "resolved"),
        ("d", "critical", "open"),
    }


def test_newest_candidate_of_a_batch_wins_ties_by_id(spark):
    rows = [
        (1, "b", "S", "x", "10:00:00", LOW),
        (1, "a", "S", "y", "10:00:00", VERY_LOW),
        (1, "c", "S", "z", "09:00:00", VERY_LOW),
    ]
    assert states(spark, rows) == {("a", "critical", "open")}


def test_rule_limits(spark):
    edges = {
        "final_residual_chlorine_mg_l": ("0.2D", "0.199D"),
        "final_turbidity_ntu": ("0.5D", "0.51D"),
        "final_ph": ("8.5D", "8.51D"),
        "head_loss_m": ("2.8D", "2.81D"),
        "filtered_turbidity_ntu": ("0.5D", "0.51D"),
        "raw_ammonia_mg_l": ("0.3D", "0.31D"),
        "sludge_blanket_level_m": ("2.5D", "2.51D"),
        "bacterial_regrowth_risk_score": ("59.99D", "60D"),
        "contamination_risk_score": ("59.99D", "60D"),
    }
    rows = []
    for i, (measure, (quiet, firing)) in enumerate(edges.items()):
        rows.append((1, f"q{i}", "S", "x", "10:00:00", {measure: quiet}))
        rows.append((1, measure, "S", "x", "10:00:00", {measure: firing}))
        rows.append((1, f"n{i}", "S", "x", "10:00:00", {measure: "cast(null as double)"}))
    found = A.alert_candidates(frame(spark, rows)).collect()
    assert sorted(r["reading_id"] for r in found) == sorted(edges)
    assert all(r["reading_id"] == r["parameter_code"] for r in found)
