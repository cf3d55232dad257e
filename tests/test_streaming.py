"""The streaming path against the batch path."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hydrolens.catalog import AS_OF
from hydrolens.operators import alerts as A
from hydrolens.operators import ingest
from hydrolens.plans import facts as facts_plan
from hydrolens.plans.marts import Clock
from hydrolens.plans.martset import MartSet
from hydrolens.sources.streams import json_file_stream
from hydrolens.sources.warehouse import RUN_BATCHES, Warehouse
from hydrolens.streaming import telemetry as stream

START = dt.datetime(2024, 1, 1, 12, 0, 0)
CLOCK = Clock(AS_OF, freshness_minutes=1440, lookback_hours=24)


def event(reading_id, minute, sensor="S1-A", **changes):
    measures = {
        "raw_turbidity_ntu": 20.0,
        "raw_ph": 7.2,
        "raw_conductivity_us_cm": 400.0,
        "raw_temperature_c": 25.0,
        "raw_ammonia_mg_l": 0.1,
        "raw_alkalinity_mg_l": 90.0,
        "settled_turbidity_ntu": 4.0,
        "sludge_blanket_level_m": 1.0,
        "estimated_settling_efficiency_pct": 80.0,
        "filtered_turbidity_ntu": 0.2,
        "head_loss_m": 1.5,
        "filtration_rate_m_h": 7.0,
        "final_residual_chlorine_mg_l": 0.5,
        "final_ph": 7.2,
        "final_turbidity_ntu": 0.2,
    }
    stamp = (START + dt.timedelta(minutes=minute)).isoformat() + "Z"
    head = {"reading_id": reading_id, "station_id": "S1", "sensor_id": sensor, "timestamp": stamp}
    return json.dumps(head | measures | {"data_source": "stream"} | changes)


def run(spark, folder, warehouse, **options):
    query = stream.start(
        json_file_stream(spark, str(folder / "in"), max_files_per_trigger=1),
        warehouse,
        str(folder / "checkpoint"),
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination()
    return query


def drop(folder, name, lines):
    (folder / "in").mkdir(exist_ok=True)
    (folder / "in" / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def warehouse(spark, tmp_path, telemetry):
    return Warehouse(spark, str(tmp_path / "warehouse"), telemetry.stations)


def ids(warehouse):
    return sorted(r[0] for r in warehouse.table("fact_sensor_reading").select("reading_id").collect())


@pytest.mark.parametrize("rocksdb", [False, True])
def test_bad_duplicate_and_late_events(spark, tmp_path, warehouse, rocksdb):
    setting = "spark.sql.streaming.stateStore.providerClass"
    default = spark.conf.get(setting)
    if rocksdb:
        stream.use_rocksdb_state(spark)
    try:
        bad_duplicate_and_late_events(spark, tmp_path, warehouse)
    finally:
        spark.conf.set(setting, default)


def bad_duplicate_and_late_events(spark, tmp_path, warehouse):
    drop(
        tmp_path,
        "1.json",
        [
            event("a", 0),
            event("b", 0),  # same sensor and time under another id
            event("c", 0, sensor="S1-B"),
            "{not json",
            event(None, 1),
            event("no-time", 1, timestamp="yesterday"),
            event("null-time", 1, timestamp=None),
            event("d", 60, final_residual_chlorine_mg_l=None),
        ],
    )
    run(spark, tmp_path, warehouse, refresh_every=None)
    first = ids(warehouse)
    assert len(first) == 3 and first[0] in "ab" and first[1:] == ["c", "d"]
    # The watermark is now at minute 50: minute 55 is kept, minute 35 is not.
    drop(tmp_path, "2.json", [event("e", 55), event("late", 35), event("again", 60)])
    query = run(spark, tmp_path, warehouse, refresh_every=None)
    assert ids(warehouse) == first + ["e"]
    dropped = [
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    ]
    assert sum(dropped) == 1


def test_running_a_batch_again_changes_nothing(telemetry, warehouse):
    scored = telemetry.scored
    warehouse.append_batch(scored, 7)
    before = warehouse.table("fact_sensor_reading").count(), warehouse.alerts().count()
    warehouse.append_batch(scored, 7)
    after = warehouse.table("fact_sensor_reading").count(), warehouse.alerts().count()
    assert before == after and before[0] == 1000
    assert warehouse.dates_since(0).count() == 30
    assert warehouse.dates_since(warehouse.stamp()).isEmpty()


def test_files_of_a_batch_do_not_grow_with_its_dates(spark, tmp_path, warehouse):
    """Spark plans a stream with state without adaptive execution, so rows are not gathered by a hint there."""
    days, sensors = 40, 8
    drop(tmp_path, "1.json", [event(f"{d}-{s}", d * 1440, sensor=f"S1-{s}") for d in range(days) for s in range(sensors)])
    run(spark, tmp_path, warehouse, refresh_every=None)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("fact_sensor_reading", "fact_water_quality_index", "sensor_day", "alert_log"):
        (batch,) = (tmp_path / "warehouse" / name).glob("batch=0")
        assert len([f for f in batch.rglob("*.parquet") if f.stat().st_size]) <= tasks + 1, name
    assert warehouse.table("fact_sensor_reading").count() == days * sensors
    assert len(warehouse.touched_since(0)) == days
    assert warehouse.readings_of(START.date()).count() == sensors


def test_a_new_checkpoint_keeps_stored_batches(spark, tmp_path, warehouse):
    for name, lines in [("1.json", [event("a", 0), event("b", 5)]), ("2.json", [event("c", 8)])]:
        drop(tmp_path, name, lines)
    options = {"refresh_every": 1, "clock": lambda: CLOCK}
    run(spark, tmp_path, warehouse, **options)
    other = tmp_path / "other"
    other.mkdir()
    drop(other, "3.json", [event("d", 9), event("e", 60 * 24)])
    run(spark, other, warehouse, **options)
    assert ids(warehouse) == list("abcde")
    batches = warehouse.table("fact_sensor_reading").select("batch").distinct().collect()
    assert {r[0] // RUN_BATCHES for r in batches} == {0, 1}
    total = warehouse.mart("mart_system_readiness_summary").agg(F.sum("total_readings")).first()[0]
    assert total == 5


@pytest.mark.parametrize("left", ["quality_flag = 'partial'", "false"])
def test_a_batch_run_again_with_other_rows_leaves_none_behind(telemetry, warehouse, left):
    write = stream.batch_writer(warehouse, clock=lambda: CLOCK)
    write(telemetry.scored.filter("event_date < '2024-01-10'"), 0)
    write(telemetry.scored.filter("event_date >= '2024-01-10'"), 1)
    again = telemetry.scored.filter("event_date between '2024-01-10' and '2024-01-12'").filter(left)
    write(again, 1)
    want = telemetry.scored.filter("event_date < '2024-01-10'").unionByName(again)
    for name in ("fact_sensor_reading", "fact_sensor_health"):
        assert warehouse.table(name).count() == want.count()
    assert warehouse.table("fact_water_quality_index").count() == facts_plan.business_rows(want).count()
    assert warehouse.table("alert_log").filter("batch = 1").isEmpty()
    totals = warehouse.mart("mart_system_readiness_summary").agg(F.sum("total_readings"), F.max("summary_date"))
    assert tuple(totals.first()) == (want.count(), want.agg(F.max("event_date")).first()[0])
    trend = warehouse.mart("mart_parameter_trend").agg(F.max("trend_date")).first()[0]
    assert trend == want.filter("quality_flag = 'valid'").agg(F.max("event_date")).first()[0]


def test_a_half_written_batch_is_not_seen(telemetry, warehouse, monkeypatch):
    warehouse.append_batch(telemetry.scored.filter("event_date < '2024-01-05'"), 0)
    before = warehouse.table("fact_sensor_reading").count()
    monkeypatch.setattr(warehouse, "_mark", lambda *args: None)
    warehouse.append_batch(telemetry.scored.filter("event_date >= '2024-01-05'"), 1)
    assert warehouse.table("fact_sensor_reading").count() == before


def test_a_due_refresh_is_not_cancelled_by_an_empty_batch(telemetry, warehouse):
    write = stream.batch_writer(warehouse, refresh_every=3, clock=lambda: CLOCK)
    write(telemetry.scored.filter("event_date < '2024-01-05'"), 0)
    write(telemetry.scored.filter("event_date >= '2024-01-05'"), 1)
    with pytest.raises(ValueError, match="not been refreshed"):
        warehouse.mart("mart_alert_monitor")
    write(telemetry.scored.filter("false"), 2)
    readiness = warehouse.mart("mart_system_readiness_summary")
    assert readiness.agg(F.sum("total_readings")).first()[0] == 1000


def test_old_versions_go_and_snapshots_are_made_once(telemetry, warehouse):
    write = stream.batch_writer(warehouse, clock=lambda: CLOCK)
    for batch in range(4):
        write(telemetry.scored.filter(f"pmod(day(event_date), 4) = {batch}"), batch)
    assert warehouse._versions("marts") == [3, 4]
    through = warehouse.batch_key("manual", 2)
    alerts = comparable(warehouse.alerts())
    warehouse.compact_alerts(through)
    warehouse.compact_alerts(through)
    warehouse.compact_alerts(through - 1)
    assert comparable(warehouse.alerts()) == alerts
    # A replay of a sealed batch is skipped, whatever it brings.
    assert not warehouse.append_batch(telemetry.scored, 2)
    assert comparable(warehouse.alerts()) == alerts


def test_an_empty_batch_is_skipped(telemetry, warehouse):
    write = stream.batch_writer(warehouse, clock=lambda: CLOCK)
    write(telemetry.scored.filter("false"), 0)
    with pytest.raises(ValueError, match="not been refreshed"):
        warehouse.mart("mart_data_quality_monitor")
    write(telemetry.scored, 1)
    assert warehouse.table("fact_sensor_reading").count() == 1000


def test_marts_without_alerts_or_index_rows(telemetry, warehouse):
    """A first batch of partial readings: no index, no alerts, no heartbeats yet."""
    write = stream.batch_writer(warehouse, clock=lambda: CLOCK)
    write(telemetry.scored.filter("quality_flag = 'partial'"), 0)
    assert warehouse.mart("mart_alert_monitor").isEmpty()
    assert warehouse.mart("mart_station_daily_snapshot").isEmpty()
    colors = warehouse.mart("mart_station_latest_status").select("overall_status_color")
    assert {r[0] for r in colors.collect()} == {"gray"}
    write(telemetry.scored.filter("quality_flag <> 'partial'"), 1)
    assert warehouse.mart("mart_alert_monitor").count() > 0
    write(telemetry.scored.filter("quality_flag <> 'partial'"), 1)  # again
    readiness = warehouse.mart("mart_system_readiness_summary")
    assert readiness.agg(F.sum("total_readings")).first()[0] == 1000


def comparable(df):
    names = sorted(df.columns)
    return sorted(map(repr, df.select(names).collect()))


def test_stored_marts_equal_batch_marts(spark, telemetry, warehouse):
    """Six batches of five days; rollups and marts are refreshed after three and six."""
    days = F.datediff("event_date", F.lit("2024-01-01"))
    scored = telemetry.scored.withColumn("batch", (F.floor(days / 5) + 1).cast("bigint"))
    write = stream.batch_writer(warehouse, refresh_every=3, clock=lambda: CLOCK)
    for batch in range(1, 7):
        write(scored.filter(F.col("batch") == batch).drop("batch"), batch)
        if batch in (2, 4):
            warehouse.compact_alerts(batch)
    business = facts_plan.business_rows(scored)
    facts = facts_plan.Facts(
        telemetry.stations,
        telemetry.readings,
        telemetry.wqi,
        telemetry.health,
        facts_plan.fact_alert(A.alert_log(business), A.last_clears(A.heartbeat_log(business))),
    )
    for name, mart in MartSet(facts, CLOCK).all().items():
        assert comparable(warehouse.mart(name).drop("updated_at")) == comparable(mart), name


def test_stream_equals_batch(spark, tmp_path, warehouse, telemetry):
    """The same scoring on both paths, through JSON and back."""
    from hydrolens.sources import derived

    derived.as_event_json(telemetry.raw).write.text(str(tmp_path / "in"))
    stream.start(
        json_file_stream(spark, str(tmp_path / "in")),
        warehouse,
        str(tmp_path / "checkpoint"),
        trigger={"availableNow": True},
        refresh_every=None,
    ).awaitTermination()
    for table, want in [
        ("fact_sensor_reading", telemetry.readings),
        ("fact_water_quality_index", telemetry.wqi),
        ("fact_sensor_health", telemetry.health),
    ]:
        got = warehouse.table(table).select(want.columns)
        assert comparable(got) == comparable(want), table


def test_batch_dedup_keeps_the_smallest_id(spark, telemetry):
    from hydrolens.sources import derived

    twice = derived.readings_with_duplicates(spark, telemetry.sf_dir)
    assert twice.count() > 1000
    once = ingest.dedup_readings(twice)
    assert comparable(once) == comparable(telemetry.raw)


def test_kafka_source_is_declared_lazily(spark):
    """The connector is not on this class path; the options are still checked by Spark."""
    from hydrolens.sources.streams import kafka_stream

    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "broker:9092", "readings")
