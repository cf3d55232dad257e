import datetime as dt

import pytest

from hydrolens import schema as S
from hydrolens.sources import dimensions, folders


def test_calendar(spark):
    calendar = dimensions.dim_date(spark)
    assert calendar.count() == 1095
    rows = {r["full_date"]: r for r in calendar.collect()}
    day = rows[dt.date(2025, 1, 5)]  # the Sunday after Wednesday 1 January
    assert (day["date_key"], day["week_of_year"], day["day_name"], day["is_weekend"]) == (
        20250105,
        2,
        "Sunday",
        0,
    )
    friday = rows[dt.date(2026, 5, 8)]
    assert (friday["month_name"], friday["quarter_number"], friday["is_weekend"]) == ("May", 2, 1)
    assert len({r["date_key"] for r in rows.values()}) == 1095


def test_clock(spark):
    clock = dimensions.dim_time(spark)
    assert clock.count() == 86400 and clock.select("time_key").distinct().count() == 86400
    row = clock.filter("time_key = 74559").first()
    assert row["full_time"] == "07:45:59"
    assert (row["quarter_hour_bucket"], row["hour_bucket"]) == ("45", "07:00")
    buckets = clock.select("quarter_hour_bucket").distinct().collect()
    assert sorted(r[0] for r in buckets) == ["00", "15", "30", "45"]


def test_reference_tables(spark):
    parameters = dimensions.dim_parameter(spark)
    rules = dimensions.dim_threshold_rule(spark)
    assert parameters.count() == rules.count() == 19
    assert rules.join(parameters, ["parameter_code", "stage_name"]).count() == 19
    assert rules.schema == dimensions.RULE_SCHEMA
    assert dimensions.kpi_dictionary(spark).count() == 8


def test_csv_scan_skips_the_byte_order_mark(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text(
        ",".join(S.STATION_SCHEMA.names)
        + "\nA-1,Plant A,North,Town,30.5,31.25,Nile,Drinking,5000,Active,2020-01-02,seed\n",
        encoding="utf-8-sig",
    )
    row = dimensions.scan_stations(spark, str(path)).first()
    assert row.asDict() == {
        "station_id": "A-1",
        "station_name": "Plant A",
        "governorate": "North",
        "city": "Town",
        "latitude": 30.5,
        "longitude": 31.25,
        "water_source_type": "Nile",
        "station_category": "Drinking",
        "plant_capacity_m3_day": 5000,
        "operational_status": "Active",
    }


@pytest.mark.parametrize("name", ["dim_parameter", "dim_threshold_rule"])
def test_csv_export_and_scan(spark, tmp_path, name):
    table = getattr(dimensions, name)(spark)
    path = str(tmp_path / name)
    dimensions.export_csv(table, path)
    first = next(p for p in (tmp_path / name).glob("*.csv"))
    assert first.read_bytes().startswith(b"\xef\xbb\xbf")
    scan = {"dim_parameter": dimensions.scan_parameters, "dim_threshold_rule": dimensions.scan_threshold_rules}
    assert sorted(map(repr, scan[name](spark, path).collect())) == sorted(map(repr, table.collect()))


def test_reload_replaces(spark, tmp_path):
    path = str(tmp_path / "dim")
    dimensions.reload_dimension(dimensions.dim_parameter(spark), path)
    again = dimensions.reload_dimension(dimensions.dim_parameter(spark).limit(3), path)
    assert again.count() == 3


def test_shared_folder_is_the_one_the_session_names(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir")
    assert folders.shared_folder(spark) == named
    assert folders.RunFolder(spark).path.startswith(named)
    assert folders.RunFolder(spark).path != folders.RunFolder(spark).path
