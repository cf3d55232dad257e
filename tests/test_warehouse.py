"""Sealed state, versions of dates, crashes and replays, records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hydrolens.catalog import AS_OF
from hydrolens.operators import alerts as A
from hydrolens.plans import facts as facts_plan
from hydrolens.plans import records
from hydrolens.plans import rollups as R
from hydrolens.plans.marts import Clock
from hydrolens.plans.martset import MartSet
from hydrolens.sources import dimensions, warehouse as W
from hydrolens.sources.files import names_in
from hydrolens.sources.parts import MERGED, Dimension, Folder, Parts, Staged, crowded
from hydrolens.sources.warehouse import RUN_BATCHES, STORED, Warehouse

CLOCK = Clock(AS_OF, freshness_minutes=1440, lookback_hours=24)


@pytest.fixture(scope="module")
def scored(telemetry, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scored") / "scored")
    telemetry.scored.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def warehouse(spark, tmp_path, telemetry):
    return Warehouse(spark, str(tmp_path / "warehouse"), telemetry.stations)


def day(n):
    return dt.date(2024, 1, n)


def days(scored, first, last):
    return scored.where(F.col("event_date").between(F.lit(day(first)), F.lit(day(last))))


def comparable(df):
    names = sorted(df.columns)
    return sorted(map(repr, df.select(names).collect()))


def batch_marts(telemetry, batches):
    """The marts of all batches at once, by the batch path."""
    readings = None
    for number, frame in enumerate(batches):
        frame = frame.withColumn("batch", F.lit(number).cast("bigint"))
        readings = frame if readings is None else readings.unionByName(frame)
    business = facts_plan.business_rows(readings)
    facts = facts_plan.Facts(
        telemetry.stations,
        facts_plan.fact_sensor_reading(readings),
        facts_plan.fact_water_quality_index(readings),
        facts_plan.fact_sensor_health(readings),
        facts_plan.fact_alert(A.alert_log(business), A.last_clears(A.heartbeat_log(business))),
    )
    return MartSet(facts, CLOCK).all()


def assert_marts(warehouse, telemetry, batches):
    for name, mart in batch_marts(telemetry, batches).items():
        assert comparable(warehouse.mart(name).drop("updated_at")) == comparable(mart), name


def test_untouched_dates_are_carried_over(telemetry, warehouse, scored):
    """30 days, the last two of them one by one: a refresh writes the dates of its batch only."""
    batches = [days(scored, 1, 28), days(scored, 29, 29), days(scored, 30, 30)]
    for number, frame in enumerate(batches):
        warehouse.append_batch(frame, number)
        warehouse.refresh(CLOCK)
    version = warehouse.refreshed.newest()
    assert version.number == 3
    for item, date in STORED.items():
        written = {f.part: f.version for f in version.of(item)}
        if date is None:
            assert written == {None: 3}
        elif item != "readiness_daily":  # also written where alerts have got another status
            assert {d: v for d, v in written.items() if d >= day(29)} == {day(29): 2, day(30): 3}
            assert {v for d, v in written.items() if d < day(29)} == {1}
            folders = names_in(warehouse.spark, f"{warehouse.refreshed.root}/{item}/version=3")
            assert [f for f in folders if "=" in f] == ["part=2024-01-30"]
    changed = {f.part for f in version.of("readiness_daily") if f.version == 3}
    assert day(30) in changed and len(changed) < 30
    # Records of the day before the newest are sealed, and no others were written by the last seal.
    sealed = warehouse.sealed.newest()
    assert {f.part for f in sealed.of("sensor_day") if f.version == sealed.number} == {day(29)}
    assert {f.version for f in sealed.of("closed_alerts") if f.part < day(28)} <= {1, 2}
    assert_marts(warehouse, telemetry, batches)
    counts = warehouse.row_counts()
    assert counts == {name: warehouse.mart(name).count() for name in counts}
    # What neither of the last two versions names is gone.
    assert warehouse.refreshed.versions() == [2, 3]
    assert names_in(warehouse.spark, f"{warehouse.refreshed.root}/mart_station_latest_status") == ["version=2", "version=3"]


@pytest.mark.parametrize("broken", ["sealed", "refreshed"])
def test_a_crash_before_a_version_is_complete(telemetry, warehouse, scored, monkeypatch, broken):
    batches = [days(scored, 1, 10), days(scored, 8, 20).where("reading_id like '%7'"), days(scored, 21, 30)]
    warehouse.append_batch(batches[0], 0)
    warehouse.refresh(CLOCK)
    before = comparable(warehouse.mart("mart_alert_monitor"))
    warehouse.append_batch(batches[1], 1)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(getattr(warehouse, broken), "commit", crash)
        with pytest.raises(RuntimeError, match="lost"):
            warehouse.refresh(CLOCK)
    again = Warehouse(warehouse.spark, warehouse.root, telemetry.stations)
    assert comparable(again.mart("mart_alert_monitor")) == before
    again.append_batch(batches[2], 2)
    again.refresh(CLOCK)
    assert_marts(again, telemetry, batches)


def test_replays_and_resumed_runs(telemetry, warehouse, scored):
    """Run a, then b, then a again: its sealed batches are skipped, one that it had not completed is stored
    behind b's, and so are new ones."""
    stored = [("a", 0, days(scored, 1, 5)), ("b", 0, days(scored, 6, 10)), ("a", 1, days(scored, 11, 20)), ("a", 2, days(scored, 21, 30))]
    assert warehouse.append_batch(stored[0][2], 0, "a")
    # A crash in batch 1 of run a: rows are there, the marker is not.
    warehouse._write_batch(W._reading_frame(days(scored, 12, 13), 1), "fact_sensor_reading", 1)
    assert warehouse.append_batch(stored[1][2], 0, "b")
    warehouse.refresh(CLOCK)
    warehouse.seal(warehouse.batch_key("b", 0))
    for run, number, frame in stored[:2]:  # replays
        assert not warehouse.append_batch(frame, number, run)
    for run, number, frame in stored[2:]:
        assert warehouse.append_batch(frame, number, run)
    assert warehouse._complete()[-2:] == [2 * RUN_BATCHES + 1, 2 * RUN_BATCHES + 2]
    warehouse.refresh(CLOCK)
    assert not warehouse.append_batch(stored[2][2], 1, "a")
    assert warehouse.table("fact_sensor_reading").count() == 1000
    assert_marts(warehouse, telemetry, [frame for _, _, frame in stored])


def test_facts_are_gathered_from_many_small_batches(telemetry, warehouse, scored, monkeypatch):
    for module in (W, __import__("hydrolens.sources.parts", fromlist=["x"])):
        monkeypatch.setattr(module, "MERGED", 3)
    frames = [scored.where(f"pmod(hash(reading_id), 8) = {n}").where("day(event_date) <= 2") for n in range(8)]
    for number, frame in enumerate(frames):
        warehouse.append_batch(frame, number)
        warehouse.seal()
        # Folders of batches that wait, one more seal for readers; dates in few folders.
        assert len(names_in(warehouse.spark, f"{warehouse.root}/fact_sensor_reading")) <= 8
    version = warehouse.sealed.newest()
    for name in W.FACTS:
        per_date = [len([f for f in version.of(name) if f.part == day(d)]) for d in (1, 2)]
        assert max(per_date) <= 3
    for name in W.LOGS:
        assert len(names_in(warehouse.spark, f"{warehouse.root}/{name}")) <= 3
    assert len(warehouse._markers()) <= 8
    want = facts_plan.fact_sensor_reading(days(scored, 1, 2))
    assert comparable(warehouse.table("fact_sensor_reading").select(want.columns)) == comparable(want)
    health = facts_plan.fact_sensor_health(days(scored, 1, 2))
    assert comparable(warehouse.table("fact_sensor_health").drop("batch")) == comparable(health)


def test_an_alert_raised_again_after_it_was_closed(spark, telemetry, warehouse, scored):
    """Its closed row gives way to the new one, open or closed again."""
    first = facts_plan.business_rows(days(scored, 1, 3)).where("final_residual_chlorine_mg_l < 0.2")
    calm = facts_plan.business_rows(scored).where("final_residual_chlorine_mg_l > 0.4 and final_turbidity_ntu < 0.2").where("day(event_date) >= 4")
    batches = [first, days(scored, 4, 4).where("false").unionByName(calm), first.withColumn("reading_id", F.concat("reading_id", F.lit("x"))), calm]
    for number, frame in enumerate(batches):
        warehouse.append_batch(frame, number)
        warehouse.seal()
        business = None
        for k, b in enumerate(batches[: number + 1]):
            rows = facts_plan.business_rows(b).withColumn("batch", F.lit(k).cast("bigint"))
            business = rows if business is None else business.unionByName(rows)
        want = facts_plan.fact_alert(A.alert_log(business), A.last_clears(A.heartbeat_log(business)))
        assert comparable(warehouse.alerts()) == comparable(want)
    assert not warehouse.alerts().where("status = 'resolved'").isEmpty()
    keys = warehouse.alerts().select("alert_id")
    assert keys.count() == keys.distinct().count()


def test_crowded_folders_by_size():
    folders = [Folder("t", day(1), v, 1) for v in range(MERGED)] + [Folder("t", day(1), 99, 10_000)]
    folders += [Folder("t", day(2), v, 1) for v in range(MERGED - 1)]
    assert {f.version for f in crowded(folders)} == set(range(MERGED))


def test_a_thousand_batches_of_one_day_stay_few_folders():
    """Each gathering adds a folder and merges alike ones: folders and rewritten rows grow with the logarithm."""
    folders, written, most = [], 0, 0
    for version in range(1000):
        merged = crowded(folders)
        new = Folder("t", day(1), version, 10 + sum(f.n for f in merged))
        folders = [f for f in folders if f not in merged] + [new]
        written, most = written + new.n, max(most, len(folders))
    assert sum(f.n for f in folders) == 10_000
    assert most <= 4 * MERGED and written <= 4 * 10_000


def test_a_failed_reload_leaves_the_old_rows(spark, tmp_path):
    rows = dimensions.dim_parameter(spark)
    stored = Dimension(spark, str(tmp_path / "parameters"), rows.schema)
    assert comparable(stored.reload(rows)) == comparable(rows) and stored.count() == rows.count()
    broken = rows.withColumn("parameter_code", F.expr("raise_error('lost')").cast("string"))
    reader = stored.read()
    with pytest.raises(Exception, match="lost"):
        stored.reload(broken)
    assert comparable(reader) == comparable(stored.read()) == comparable(rows)
    stored.reload(rows.limit(3))
    assert stored.count() == 3


# --- records ------------------------------------------------------------------------------
@pytest.mark.parametrize("name, kind", [("sensor_day", records.SENSOR_DAY), ("station_hour", records.STATION_HOUR)])
def test_records_of_parts_merge_to_the_whole(scored, name, kind):
    make = getattr(records, name)
    scored = facts_plan.fact_sensor_reading(scored)
    parts = [make(scored.where(f"pmod(hash(reading_id), 3) = {n}")) for n in range(3)]
    totals = [c for c in kind.columns if not c.endswith(("_whole", "_billionths"))]
    assert comparable(kind.merged(*parts).select(totals)) == comparable(make(scored).select(totals))

    def sums(df):  # whole units and billionths may be split otherwise; they stand for the same sums
        names = [c.removesuffix("_whole") for c in kind.columns if c.endswith("_whole")]
        return df.select(*kind.keys, *[F.expr(f"cast({c}_whole as decimal(38,0)) * 1000000000 + {c}_billionths").alias(c) for c in names])

    assert comparable(sums(kind.merged(*parts))) == comparable(sums(make(scored)))


def test_records_use_hash_aggregates(telemetry):
    for frame in (records.sensor_day(telemetry.readings), records.station_hour(telemetry.readings)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("as_of, hours", [(AS_OF, 24), ("2024-01-20 10:30:15", 7), (dt.datetime(2024, 1, 20, 0, 0, 0, 5), 48)])
def test_recent_hours_from_records(telemetry, scored, as_of, hours):
    readings, health = facts_plan.fact_sensor_reading(scored), facts_plan.fact_sensor_health(scored)
    want = R.recent_quality(readings, as_of, hours).join(R.recent_health(health, as_of, hours), "station_id")
    got = records.recent(records.station_hour(readings), readings, as_of, hours)
    assert comparable(got) == comparable(want)
    assert not got.isEmpty()


def fact_scans(df):
    """Scans of the facts' source in the plan of a mart."""
    return df._jdf.queryExecution().executedPlan().toString().count("events.parquet")


def test_marts_read_the_facts_at_most_once(telemetry):
    marts = telemetry.day
    marts.facts.alerts  # the alert fact and the records are stored first
    for name in W.MARTS:
        mart = marts.alert_monitor if name == "mart_alert_monitor" else getattr(marts, name.removeprefix("mart_"))
        assert fact_scans(mart) <= 1, name


def test_parts_of_no_version(spark, tmp_path):
    parts = Parts(spark, str(tmp_path / "none"))
    assert parts.newest().folders == [] and parts.versions() == []
    parts.clean()


def test_many_dates_are_written_by_several_tasks(spark, tmp_path):
    """One task would open the files of all dates one after the other, however small they are."""
    parts, staged = Parts(spark, str(tmp_path / "parts")), Staged(1)
    rows = spark.range(200 * 5).selectExpr("date_add(date '2024-01-01', cast(id % 200 as int)) as event_date", "id")
    parts.stage(staged, "rows", rows, [], "event_date", 200)
    assert len(staged.folders) == 200 and {f.n for f in staged.folders} == {5}
    files = [f.name for f in (tmp_path / "parts").rglob("*.parquet")]
    assert len({name[:10] for name in files}) >= 3  # part-00000, part-00001, ...
    assert len(files) <= 200 + 4  # only a date on a border between two tasks has two files
    version = parts.commit(staged)
    assert sorted(parts.read(version.of("rows"), rows.schema).collect()) == sorted(rows.collect())
