"""Stored facts, alert state and marts under one folder.

Batches come first, state is folded from them, marts are made from the state.

* A batch has a key: the number of its run and its id in that run. A run is one streaming checkpoint; it
  gets a new number when it goes on after another one has begun. So keys grow in the order in which
  batches are stored. Every table keeps a batch in a folder of its own, which is replaced as a whole when
  the batch runs again. A marker is written last and holds the dates that the batch touches, now or
  before it was run again; readers see marked batches only.
* A seal folds the batches before the newest into the sealed state: records per date, the newest rows per
  station, the open alerts, and the closed alerts by date. A batch that is sealed is not stored again: a
  replay of it is skipped. Open alerts are carried from seal to seal, closed ones are added to their dates and
  not read again, so a seal costs what its batches, their dates and the open alerts cost. Every
  `MERGED` batches, their facts are gathered into date folders.
* A refresh seals, then makes the marts from the sealed state and the batch that is still open. Marts by
  date are written for the dates that new batches touch (readiness also for those of alerts whose status has
  changed); other dates are carried over as they are. What is the same on every day (colours
  of stations, open alerts) is kept once and joined when a mart is read.

Sealed state and marts are `Parts`: versions that become visible as a whole. A crash before a version is
complete leaves the one before it; the next refresh makes up for it. Folders of batches go one seal after
they were gathered, for readers that are still at them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens import schema as S
from hydrolens.operators import alerts as A
from hydrolens.operators import ingest
from hydrolens.operators.latest import first_per_key
from hydrolens.plans import facts as facts_plan
from hydrolens.plans import marts as M
from hydrolens.plans import records
from hydrolens.plans import rollups as R
from hydrolens.plans.martset import MartSet
from hydrolens.plans.records import SENSOR_DAY, STATION_HOUR
from hydrolens.session import together
from hydrolens.sources.files import names_in, numbered, read_folders, read_json, remove, write_json
from hydrolens.sources.folders import RunFolder
from hydrolens.sources.parts import MERGED, Parts, Staged, Version, crowded

FACTS = ("fact_sensor_reading", "fact_water_quality_index", "fact_sensor_health")
LOGS = ("alert_log", "heartbeat_log", "sensor_day", "station_hour", "newest_wqi")
# Batches are sorted by those of these columns they have.
DATE_COLUMNS = ("event_date", "summary_date", "trend_date")
# Batches that one run can have before its keys reach the next run's.
RUN_BATCHES = 1 << 40
# What a refresh stores of the marts, with the date column.
STORED = {
    "mart_station_latest_status": None,
    "mart_data_quality_monitor": "summary_date",
    "mart_parameter_trend": "trend_date",
    "mart_station_daily_snapshot": "summary_date",
    "governorate_daily": "summary_date",
    "readiness_daily": "summary_date",
}
_MART_OF = {"governorate_daily": "mart_governorate_daily_summary", "readiness_daily": "mart_system_readiness_summary"}
MARTS = (*(_MART_OF.get(item, item) for item in STORED), "mart_alert_monitor")


def stored_mart(marts: MartSet, item: str) -> DataFrame:
    return getattr(marts, item.removeprefix("mart_"))


def through(sealed: Version) -> int:
    """The key of the last sealed batch."""
    return sealed.notes.get("through", -1)


def gathered_through(sealed: Version) -> int:
    """The key of the last batch whose facts lie in date folders."""
    return sealed.notes.get("gathered", -1)


def _reading_frame(scored: DataFrame, key: int) -> DataFrame:
    now = F.current_timestamp()
    batch = F.lit(key).cast("bigint")
    return facts_plan.fact_sensor_reading(scored).withColumns(
        {"ingestion_time": now, "processing_time": now, "batch": batch}
    )


def _derived_frames(readings: DataFrame, batch_id: int) -> dict[str, DataFrame]:
    """The other facts, the alert logs and the records of one batch of stored readings."""
    batch = F.lit(batch_id).cast("bigint")
    indexed = ingest.with_index(readings)
    business = facts_plan.business_rows(indexed)
    wqi = facts_plan.fact_water_quality_index(indexed)
    frames = {
        "fact_water_quality_index": wqi,
        "fact_sensor_health": facts_plan.fact_sensor_health(indexed),
        "alert_log": A.alert_log(business).withColumn("event_date", F.to_date("event_timestamp")),
        "heartbeat_log": A.heartbeat_log(business),
        "sensor_day": records.sensor_day(readings),
        "station_hour": records.station_hour(readings),
        "newest_wqi": R.latest_wqi(wqi),
    }
    return {name: frame.withColumn("batch", batch) for name, frame in frames.items()}


def _newest_wqi(frame: DataFrame) -> DataFrame:
    return first_per_key(frame, ["station_id"], [F.col("event_timestamp").desc(), F.col("reading_id").asc()])


def _dates(frame: DataFrame, column: str) -> set[dt.date]:
    return {r[0] for r in frame.select(column).where(F.col(column).isNotNull()).distinct().collect()}


@dataclass(frozen=True)
class Marker:
    """A stored batch: its number in the order of storing (None while it is run again) and its dates, those
    before it was run again included."""

    stamp: int | None
    dates: frozenset[dt.date]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, stations: DataFrame):
        self.spark, self.root, self.stations = spark, root.rstrip("/"), stations
        self.sealed = Parts(spark, f"{self.root}/sealed")
        self.refreshed = Parts(spark, f"{self.root}/marts")

    # --- batches --------------------------------------------------------------------
    @cached_property
    def schemas(self) -> dict[str, T.StructType]:
        """The schema of each fact, log and record, from its own plan over no rows."""
        ids = [T.StructField(name, T.StringType()) for name in ("reading_id", "station_id", "sensor_id")]
        measures = [T.StructField(name, T.DoubleType()) for name in S.MEASURES]
        time = T.StructField("event_timestamp", T.TimestampType())
        nothing = self.spark.createDataFrame([], T.StructType([*ids, time, *measures]))
        readings = _reading_frame(ingest.score_readings(nothing), 0)
        frames = {"fact_sensor_reading": readings, **_derived_frames(readings, 0)}
        log = frames["alert_log"].drop("event_date")
        state = A.alert_lifecycle(log, A.last_clears(frames["heartbeat_log"])).withColumn("event_date", F.lit(None).cast("date"))
        frames |= {
            "alert_state": state,
            "open_alerts": log,
            "newest_reading": records.newest_reading(frames["sensor_day"]),
        }
        return {name: frame.schema for name, frame in frames.items()}

    def _schema(self, name: str, *without: str) -> T.StructType:
        return T.StructType([f for f in self.schemas[name].fields if f.name not in without])

    def table(self, name: str) -> DataFrame:
        """A fact, or the rows of a log that are not sealed yet. Only complete batches are seen."""
        sealed = self.sealed.newest()
        if name not in FACTS:
            return self._rows(name, through(sealed))
        gathered = self.sealed.read(sealed.of(name), self.schemas[name])
        return gathered.unionByName(self._rows(name, gathered_through(sealed)))

    def _rows(self, name: str, after: int, last: int | None = None) -> DataFrame:
        """Rows of complete batches after a key, read from the batches' folders."""
        keys = [k for k, m in self._markers().items() if m.stamp and k > after and (last is None or k <= last)]
        base = f"{self.root}/{name}"
        rows = read_folders(self.spark, [f"{base}/batch={k}" for k in keys], self.schemas[name], base)
        return rows.select(self.schemas[name].names)

    def _batch(self, name: str, key: int) -> DataFrame:
        """One batch of a table, read from its own folder."""
        stored = self.spark.read.schema(self._schema(name, "batch")).parquet(f"{self.root}/{name}/batch={key}")
        return stored.withColumn("batch", F.lit(key).cast("bigint"))

    def _write_batch(self, df: DataFrame, name: str, key: int) -> None:
        """Replaces all that the batch has in this table, also if it now has no rows. A task writes one file, its
        rows in the order of their dates, so the number of files does not grow with the dates of a batch."""
        by = [column for column in DATE_COLUMNS if column in df.columns]
        rows = df.drop("batch")
        rows = rows.sortWithinPartitions(*by) if by else rows
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={key}")

    def _runs(self) -> list[dict]:
        """run and first batch id of each run number, in the order in which they began."""
        return [read_json(self.spark, f"{self.root}/runs/{n}.json") for n in numbered(self.spark, f"{self.root}/runs")]

    def batch_key(self, run: str, batch_id: int) -> int:
        """The key of a batch. It grows from batch to batch: a run that goes on after a later one has begun
        gets a new number for what it has not stored yet."""
        runs = self._runs()
        own = [number for number, r in enumerate(runs) if r["run"] == run and r["first"] <= batch_id]
        if own:
            key = own[-1] * RUN_BATCHES + batch_id
            sealed = self.sealed.newest().notes.get("applied", {}).get(str(own[-1]), -1)
            marker = self._markers().get(key)
            if own[-1] == len(runs) - 1 or sealed >= batch_id or (marker and marker.stamp):
                return key
        write_json(self.spark, f"{self.root}/runs/{len(runs)}.json", {"run": run, "first": batch_id})
        return len(runs) * RUN_BATCHES + batch_id

    def _markers(self) -> dict[int, Marker]:
        """Batches with their own folders, by key."""
        folder = f"{self.root}/batches"
        found = {}
        for key in numbered(self.spark, folder):
            if (stored := read_json(self.spark, f"{folder}/{key}.json")) is not None:
                found[key] = Marker(stored["stamp"], frozenset(map(dt.date.fromisoformat, stored["dates"])))
        return found

    def _complete(self) -> list[int]:
        return [key for key, marker in self._markers().items() if marker.stamp]

    def _mark(self, key: int, stamp: int | None, dates: set[dt.date]) -> None:
        marker = {"stamp": stamp, "dates": sorted(map(str, dates))}
        write_json(self.spark, f"{self.root}/batches/{key}.json", marker)

    def stamp(self) -> int:
        """The number of the batch stored last, 0 before the first. Not less than the newest marts': the
        batch they were built from may be open again."""
        return max([self.refreshed.newest().number, *(m.stamp for m in self._markers().values() if m.stamp)])

    def append_batch(self, scored: DataFrame, batch_id: int, run: str = "manual") -> bool:
        """Stores the facts, alert logs and records of one batch; false if it is empty or sealed already.

        The readings are written first and everything else is derived from what was stored.
        So the stream's plan runs once, nothing has to be held in executors, and all tables
        agree on which copy of a repeated reading survived. While a batch is run again readers do
        not see it.
        """
        key = self.batch_key(run, batch_id)
        if key <= through(self.sealed.newest()):
            return False
        before = self._markers().get(key)
        if before:
            self._mark(key, None, before.dates)
        self._write_batch(_reading_frame(scored, key), "fact_sensor_reading", key)
        stored = self._batch("fact_sensor_reading", key)
        frames = _derived_frames(stored, key)
        together(self.spark, *[lambda n=n, f=f: self._write_batch(f, n, key) for n, f in frames.items()])
        dates = _dates(stored, "event_date")
        self._mark(key, self.stamp() + 1, dates | (before.dates if before else set()))
        return bool(dates)

    # --- alerts ---------------------------------------------------------------------
    def _alert_state(self, last: int | None = None) -> DataFrame:
        """Alerts that were open at the last seal and those of the batches since (up to a key), with status.
        What was cleared before the seal is closed already, so later batches' heartbeats are enough."""
        sealed = self.sealed.newest()
        opened = self.sealed.read(sealed.of("open_alerts"), self.schemas["open_alerts"])
        log = self._rows("alert_log", through(sealed), last).drop("event_date")
        heartbeats = self._rows("heartbeat_log", through(sealed), last)
        state = A.alert_lifecycle(opened.unionByName(log), A.last_clears(heartbeats))
        return state.withColumn("event_date", F.to_date("event_timestamp")).select(self.schemas["alert_state"].names)

    def _closed(self, sealed: Version, dates: set | None = None) -> DataFrame:
        return self.sealed.read(sealed.of("closed_alerts", dates), self.schemas["alert_state"])

    def alerts(self) -> DataFrame:
        """The alert fact over all complete batches."""
        return facts_plan.alert_rows(records.all_alerts(self._closed(self.sealed.newest()), self._alert_state()))

    def readings_of(self, day: dt.date) -> DataFrame:
        """The reading fact of one date."""
        name, sealed = "fact_sensor_reading", self.sealed.newest()
        gathered = self.sealed.read(sealed.of(name, {day}), self.schemas[name])
        return gathered.unionByName(self._rows(name, gathered_through(sealed)).where(F.col("event_date") == F.lit(day)))

    def facts(self) -> facts_plan.Facts:
        reading, wqi, health = [self.table(name) for name in FACTS]
        return facts_plan.Facts(self.stations, reading, wqi, health, self.alerts())

    # --- seal -----------------------------------------------------------------------
    def compact_alerts(self, last: int) -> None:
        """Seals the batches up to a key by hand."""
        self.seal(last)

    def seal(self, last: int | None = None) -> None:
        """Folds complete batches up to a key (default: all but the newest) into the sealed state. Sealed
        batches are left alone."""
        old = self.sealed.newest()
        complete = self._complete()
        keys = [k for k in complete if k > through(old)]
        keys = keys[:-1] if last is None else [k for k in keys if k <= last]
        if not keys:
            return
        done, last, gathered = through(old), keys[-1], gathered_through(old)
        staged = Staged(old.number + 1)
        gather = sum(gathered < k <= last for k in complete) >= MERGED
        with RunFolder(self.spark) as run:
            state = run.keep(self._alert_state(last), "alert_state")
            jobs = [
                lambda: self._seal_record(staged, old, last, "sensor_day", SENSOR_DAY),
                lambda: self._seal_record(staged, old, last, "station_hour", STATION_HOUR),
                lambda: self._seal_newest(staged, old, last),
                lambda: self._seal_open(staged, old, state),
                lambda: self._seal_closed(staged, old, state),
            ]
            if gather:
                jobs += [lambda name=name: self._gather(staged, old, last, name) for name in FACTS]
            together(self.spark, *jobs)
        applied = dict(old.notes.get("applied", {}))
        for number, batch_id in (divmod(key, RUN_BATCHES) for key in keys):
            applied[str(number)] = max(batch_id, applied.get(str(number), -1))
        self.sealed.commit(staged, through=last, gathered=last if gather else gathered, applied=applied)
        self._clean(done, gathered)

    def _seal_record(self, staged: Staged, old: Version, last: int, name: str, kind: records.Record) -> None:
        new = self._rows(name, through(old), last).drop("batch")
        dates = _dates(new, kind.date)
        folders = old.of(name, dates)
        schema = self._schema(name, "batch")
        merged = kind.merged(self.sealed.read(folders, schema), new)
        self.sealed.stage(staged, name, merged.select(schema.names), folders, kind.date, len(dates))

    def _seal_newest(self, staged: Staged, old: Version, last: int) -> None:
        """The newest index row and the latest times of each station."""
        self.sealed.stage(staged, "newest_wqi", self._newest_wqi(old, last), old.of("newest_wqi"))
        self.sealed.stage(staged, "newest_reading", self._newest_reading(old, last), old.of("newest_reading"))

    def _newest_wqi(self, sealed: Version, last: int | None = None) -> DataFrame:
        known = self.sealed.read(sealed.of("newest_wqi"), self._schema("newest_wqi", "batch"))
        return _newest_wqi(known.unionByName(self._rows("newest_wqi", through(sealed), last).drop("batch")))

    def _newest_reading(self, sealed: Version, last: int | None = None) -> DataFrame:
        known = self.sealed.read(sealed.of("newest_reading"), self.schemas["newest_reading"])
        new = records.newest_reading(self._rows("sensor_day", through(sealed), last))
        return records.newest_reading(known.unionByName(new))

    def _seal_open(self, staged: Staged, old: Version, state: DataFrame) -> None:
        rows = state.where("status = 'open'").select(self.schemas["open_alerts"].names)
        self.sealed.stage(staged, "open_alerts", rows, old.of("open_alerts"))

    def _seal_closed(self, staged: Staged, old: Version, state: DataFrame) -> None:
        """Closed alerts are added to their dates. A date is written again only if an alert of it was raised
        again after it was closed, or if it has many small folders."""
        new = state.where("status = 'resolved'")
        dates = _dates(new, "event_date")
        there = old.of("closed_alerts", dates)
        second = F.date_trunc("second", "event_timestamp").alias("second")
        known = self.sealed.read(there, self.schemas["alert_state"]).select(*A.ALERT_KEY, second, "event_date")
        again = known.join(new.select(*A.ALERT_KEY, second), [*A.ALERT_KEY, "second"], "left_semi")
        changed = _dates(again, "event_date")
        merged = [f for f in there if f.part in changed]
        merged += [f for f in crowded(there) if f.part not in changed]
        kept = self.sealed.read(merged, self.schemas["alert_state"])
        self.sealed.stage(staged, "closed_alerts", records.all_alerts(kept, new), merged, "event_date", len(dates))

    def _gather(self, staged: Staged, old: Version, last: int, name: str) -> None:
        """Facts of sealed batches are added to their dates."""
        new = self._rows(name, gathered_through(old), last)
        dates = _dates(new, "event_date")
        merged = crowded(old.of(name, dates))
        rows = new.unionByName(self.sealed.read(merged, self.schemas[name]))
        self.sealed.stage(staged, name, rows, merged, "event_date", len(dates))

    def _clean(self, sealed: int, gathered: int) -> None:
        """Removes what the sealed version before the newest has in its own folders: logs of batches up to the
        key `sealed`, facts and markers of those up to `gathered` that the marts have seen."""
        marts = self.refreshed.versions()
        bases = [self.refreshed.version(v).notes["base"] for v in marts]
        self.sealed.clean(min(bases, default=None))
        for name in (*LOGS, *FACTS):
            for folder in names_in(self.spark, f"{self.root}/{name}"):
                if int(folder.partition("=")[2]) <= (sealed if name in LOGS else gathered):
                    remove(self.spark, f"{self.root}/{name}/{folder}")
        for key, marker in self._markers().items():
            if key <= gathered and (marker.stamp or 0) <= (marts[-1] if marts else -1):
                remove(self.spark, f"{self.root}/batches/{key}.json")

    # --- refresh --------------------------------------------------------------------
    def batches_waiting(self) -> int:
        """Complete batches, empty ones too, that no refresh has seen; 0 if all of them are empty."""
        newest = self.refreshed.newest().number
        waiting = [m for m in self._markers().values() if m.stamp and m.stamp > newest]
        return len(waiting) if any(m.dates for m in waiting) else 0

    def touched_since(self, stamp: int) -> set[dt.date]:
        """The dates that batches stored after `stamp` touch."""
        return {d for m in self._markers().values() if m.stamp and m.stamp > stamp for d in m.dates}

    def dates_since(self, stamp: int) -> DataFrame:
        """event_date: these dates as a table."""
        return self.spark.createDataFrame([(d,) for d in sorted(self.touched_since(stamp))], "event_date date")

    def refresh(self, clock: M.Clock) -> None:
        """Seals all batches but the newest and makes the marts of all batches.

        A refresh that was skipped or failed is made up for by the next one. If no batch has been
        stored since, nothing is done.
        """
        before, stamp = self.refreshed.newest(), self.stamp()
        if before.number < stamp or not self.refreshed.versions():
            self.seal()
            self.refresh_marts(clock, before, stamp)

    def refresh_marts(self, clock: M.Clock, before: Version, stamp: int) -> None:
        """Makes version `stamp` of the marts."""
        touched, sealed, staged = self.touched_since(before.number), self.sealed.newest(), Staged(stamp)
        schema = self.schemas["alert_state"]
        self.refreshed.stage(staged, "alerts_now", self._alert_state(), before.of("alerts_now"))
        now = self.refreshed.read(staged.folders, schema)
        second = F.date_trunc("second", "event_timestamp").alias("second")
        opened = self.refreshed.read(before.of("alerts_now"), schema).where("status = 'open'")
        still = now.where("status = 'open'").select(*A.ALERT_KEY, second)
        ended = opened.select(*A.ALERT_KEY, second, "event_date").join(still, [*A.ALERT_KEY, "second"], "left_anti")
        changed = touched | _dates(ended, "event_date")
        alerts = records.all_alerts(self._closed(sealed, changed), now)
        with RunFolder(self.spark) as run:
            marts = StoredMartSet(self, run, clock, touched, changed, facts_plan.alert_rows(alerts), facts_plan.alert_rows(now))
            marts.sensor_days  # stored once, used by several marts

            def make(item: str, date: str | None) -> None:
                frame, dates = stored_mart(marts, item), changed if item == "readiness_daily" else touched
                if date:
                    frame = frame.where(F.col(date).isin(*dates)) if dates else frame.limit(0)
                self.refreshed.stage(staged, item, frame, before.of(item, dates if date else None), date, len(dates))

            together(self.spark, *[lambda item=item, date=date: make(item, date) for item, date in STORED.items()])
        self.refreshed.commit(staged, as_of=str(clock.as_of), base=sealed.number)
        self.refreshed.clean()

    # --- reading the marts ------------------------------------------------------------
    @cached_property
    def _mart_schemas(self) -> dict[str, T.StructType]:
        """From the marts' own plans over no rows."""
        empty = [self.spark.createDataFrame([], self.schemas[name]) for name in FACTS]
        alerts = facts_plan.alert_rows(self.spark.createDataFrame([], self.schemas["alert_state"]))
        marts = MartSet(facts_plan.Facts(self.stations, *empty, alerts), M.Clock("2000-01-01 00:00:00"))
        return {item: stored_mart(marts, item).schema for item in STORED}

    def mart(self, name: str) -> DataFrame:
        """A mart of the newest complete version."""
        if name not in MARTS:
            raise ValueError(f"no mart {name}")
        version = self.refreshed.newest()
        if not version.number:
            raise ValueError("the marts have not been refreshed yet")

        def stored(item: str) -> DataFrame:
            return self.refreshed.read(version.of(item), self._mart_schemas[item])

        now = self.refreshed.read(version.of("alerts_now"), self.schemas["alert_state"])
        if name == "mart_governorate_daily_summary":
            mix = R.governorate_status_mix(stored("mart_station_latest_status"))
            mart = M.governorate_daily_summary(stored("governorate_daily"), mix)
        elif name == "mart_alert_monitor":
            closed = self._closed(self.sealed.version(version.notes["base"]) if version.notes["base"] else Version(0, [], {}))
            mart = M.alert_monitor(facts_plan.alert_rows(records.all_alerts(closed, now)), self.stations)
        elif name == "mart_system_readiness_summary":
            status = R.current_station_status(stored("mart_station_latest_status"))
            mart = M.system_readiness_summary(stored("readiness_daily"), status, R.open_alert_count(now))
        else:
            mart = stored(name)
        return mart.withColumn("updated_at", F.expr(M.moment(version.notes["as_of"])))

    def row_counts(self) -> dict[str, int]:
        """Rows of the marts that are stored by station or date, from the list of folders: no data is read."""
        version = self.refreshed.newest()
        return {_MART_OF.get(item, item): version.rows(item) for item in STORED}

    def _versions(self, name: str) -> list[int]:
        return {"marts": self.refreshed, "sealed": self.sealed}[name].versions()


class StoredMartSet(MartSet):
    """Marts of some dates over the sealed state and the batches after it. Of the facts only the hour that
    the look-back cuts is read.

    touched: dates whose marts are made. changed: these and dates of alerts with another status than before.
    """

    def __init__(
        self, warehouse: Warehouse, run: RunFolder, clock: M.Clock, touched: set, changed: set, alerts: DataFrame, now: DataFrame
    ):
        super().__init__(facts_plan.Facts(warehouse.stations, None, None, None, alerts), clock)
        self.warehouse, self.run, self.touched, self.changed, self.alerts_now = warehouse, run, touched, changed, now
        self.sealed = warehouse.sealed.newest()

    def _merged(self, name: str, kind: records.Record, dates: set) -> DataFrame:
        old = self.warehouse.sealed.read(self.sealed.of(name, dates), self.warehouse._schema(name, "batch"))
        new = self.warehouse._rows(name, through(self.sealed)).drop("batch")
        return kind.merged(old, new.where(F.col(kind.date).isin(*dates)) if dates else new.limit(0))

    @cached_property
    def sensor_days(self) -> DataFrame:
        return self.run.keep(self._merged("sensor_day", SENSOR_DAY, self.changed), "sensor_days")

    @cached_property
    def station_hours(self) -> DataFrame:
        return self._merged("station_hour", STATION_HOUR, self.touched)

    @cached_property
    def station_readings(self) -> DataFrame:
        return self.warehouse._newest_reading(self.sealed)

    @cached_property
    def newest_wqi(self) -> DataFrame:
        return self.warehouse._newest_wqi(self.sealed)

    @cached_property
    def recent(self) -> DataFrame:
        clock = self.clock
        start = (dt.datetime.fromisoformat(str(clock.as_of)) - dt.timedelta(hours=clock.lookback_hours)).date()
        days = {f.part for f in self.sealed.of("station_hour")}
        days |= {d for m in self.warehouse._markers().values() for d in m.dates}
        hours = self._merged("station_hour", STATION_HOUR, {d for d in days if d >= start})
        return records.recent(hours, self.warehouse.readings_of(start), clock.as_of, clock.lookback_hours)
