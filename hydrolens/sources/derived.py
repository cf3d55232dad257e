"""Telemetry derived from the given `events`, `nation` and `region` tables.

The given tables hold no water telemetry; each event becomes one reading whose measures are
fixed functions of the event, so that every quality class, alert type and ladder branch
occurs. All of it is row-wise, except for `sensors`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolens import schema as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(ts as timestamp) as event_timestamp",
        "user_id",
        "event_type",
        "value",
        "cast(regexp_extract(props, '[0-9]+', 0) as int) as k",
        "concat('ST-', lpad(cast(user_id % 25 as string), 4, '0')) as station_id",
    )
    raw = base.selectExpr(
        "concat('R', cast(event_id as string)) as reading_id",
        "station_id",
        "concat(station_id, '-U', cast(user_id as string)) as sensor_id",
        "event_timestamp",
        "case when k = 0 then 210.0D + (event_id % 50) "
        "else 5.0D + ((event_id * 7919) % 45000) / 1000.0D end as raw_turbidity_ntu",
        "case when k = 1 then null else 7.0D + ((event_id * 31) % 900) / 1000.0D end as raw_ph",
        "300.0D + (event_id % 700) as raw_conductivity_us_cm",
        "case when event_type = 'error' and k >= 90 then 20.0D + ((event_id * 13) % 30000) / 1000.0D "
        "else 20.0D + ((event_id * 13) % 9000) / 1000.0D end as raw_temperature_c",
        "case when k between 2 and 3 then null "
        "when event_type = 'purchase' and k >= 90 then 0.25D + (value / 100.0D) "
        "else ((event_id * 17) % 280) / 1000.0D end as raw_ammonia_mg_l",
        "80.0D + (event_id % 60) as raw_alkalinity_mg_l",
        "0.05D + ((event_id * 104729) % 100) / 1000.0D as settled_share",
        "0.01D + ((event_id * 1299709) % 60) / 1000.0D as filtered_share",
        "event_id",
        "event_type",
        "k",
    )
    # Every event generates one reading. Predicates on its measures stay above the generator,
    # as they would on stored readings. Below it, each mention of a measure would be replaced
    # by its definition, and filters would outgrow the code generator.
    measures = [
        "reading_id",
        "station_id",
        "sensor_id",
        "event_timestamp",
        "raw_turbidity_ntu",
        "raw_ph",
        "raw_conductivity_us_cm",
        "raw_temperature_c",
        "raw_ammonia_mg_l",
        "raw_alkalinity_mg_l",
        "case when k = 4 then raw_turbidity_ntu * 1.5D when k = 19 then raw_turbidity_ntu * 0.5D "
        "else raw_turbidity_ntu * settled_share end as settled_turbidity_ntu",
        "case when k between 5 and 6 then null "
        "when event_type = 'error' and k >= 80 then 2.6D + ((event_id * 11) % 900) / 1000.0D "
        "else 0.4D + ((event_id * 11) % 900) / 1000.0D end as sludge_blanket_level_m",
        "100.0D * (1.0D - settled_share) as estimated_settling_efficiency_pct",
        "case when k = 19 then 2.2D "
        "when k between 7 and 9 then raw_turbidity_ntu * settled_share * 0.4D "
        "else raw_turbidity_ntu * settled_share * filtered_share end as filtered_turbidity_ntu",
        "case when k = 10 then 0.15D "
        "when event_type = 'click' and k >= 85 then 2.7D + ((event_id * 19) % 600) / 1000.0D "
        "else 0.5D + ((event_id * 19) % 1200) / 1000.0D end as head_loss_m",
        "5.0D + ((event_id * 23) % 5000) / 1000.0D as filtration_rate_m_h",
        "case when k = 19 then 0.05D when k = 11 then null when k = 12 then 5.5D "
        "when event_type = 'view' and k >= 80 then ((event_id * 29) % 250) / 1000.0D "
        "else 0.35D + ((event_id * 29) % 600) / 1000.0D end as final_residual_chlorine_mg_l",
        "case when k = 13 then 14.5D "
        "when k between 14 and 15 then 8.4D + ((event_id * 37) % 400) / 1000.0D "
        "else 7.0D + ((event_id * 37) % 700) / 1000.0D end as final_ph",
        "case when k = 19 then 2.1D "
        "when k = 16 then raw_turbidity_ntu * settled_share * 1.5D "
        "when k between 7 and 9 then raw_turbidity_ntu * settled_share * 0.4D * 0.95D "
        "when k between 17 and 18 then null "
        "else raw_turbidity_ntu * settled_share * filtered_share * 0.9D end as final_turbidity_ntu",
    ]
    return raw.select(F.inline_outer(F.array(F.struct(*[F.expr(m) for m in measures]))))


def readings_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 250th event is sent twice, the second time under another reading_id."""
    once = readings(spark, sf_dir)
    event_number = F.expr("cast(substring(reading_id, 2) as bigint)")
    repeat = F.concat("reading_id", F.lit("-D"))
    ids = F.when(event_number % 250 == 0, F.array("reading_id", repeat)).otherwise(
        F.array("reading_id")
    )
    return once.withColumn("reading_id", F.explode(ids))


# The event log of the streamed queries: deliveries of five days each.
FIRST_DAY, DAYS_PER_DELIVERY, DELIVERIES = "2024-01-01", 5, 6


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the number of the delivery they come in, in the order of their days.

    Some come late: of every 97 events one is delivered with the next five days. Some come twice: every 250th
    in the same delivery under another reading_id, every 400th once more with the next one.
    """
    cut = f"least(datediff(event_timestamp, date '{FIRST_DAY}') div {DAYS_PER_DELIVERY}, {DELIVERIES - 1})"
    last = DELIVERIES - 1
    numbered = readings(spark, sf_dir).selectExpr(
        "*", "cast(substring(reading_id, 2) as bigint) as event_number", f"cast({cut} as int) as cut"
    )
    own = f"if(event_number % 97 = 5 and cut < {last}, cut + 1, cut)"
    sent = (
        f"filter(array(named_struct('id', reading_id, 'delivery', {own}), "
        f"if(event_number % 250 = 0, named_struct('id', concat(reading_id, '-D'), 'delivery', {own}), null), "
        f"if(event_number % 400 = 7 and event_number % 97 <> 5 and cut < {last}, "
        "named_struct('id', concat(reading_id, '-L'), 'delivery', cut + 1), null)), x -> x is not null)"
    )
    columns = [f"sent.id as {c}" if c == "reading_id" else c for c in numbered.columns if c not in ("event_number", "cut")]
    return numbered.withColumn("sent", F.explode(F.expr(sent))).selectExpr(*columns, "sent.delivery as delivery")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per nation and one that never reports."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    known = nations.selectExpr("n_nationkey as key", "n_name as name", "r_name as governorate")
    silent = spark.sql("select 25 as key, 'NATION_25' as name, 'AFRICA' as governorate")
    return known.unionByName(silent).selectExpr(
        "concat('ST-', lpad(cast(key as string), 4, '0')) as station_id",
        "name as station_name",
        "governorate",
        "name as city",
        "22.0D + key * 0.4D as latitude",
        "25.0D + key * 0.4D as longitude",
        "element_at(array('Nile', 'Canal', 'Groundwater', 'Desalinated Blend'), key % 4 + 1) "
        "as water_source_type",
        "'Drinking' as station_category",
        "50000 + 10000 * key as plant_capacity_m3_day",
        "case key % 12 when 7 then 'Inactive' when 3 then 'Under Maintenance' else 'Active' end "
        "as operational_status",
        "cast(null as date) as commission_date",
        "'derived' as data_source",
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = readings(spark, sf_dir).select("sensor_id", "station_id").distinct()
    return seen.selectExpr(
        "sensor_id",
        "station_id",
        "cast(null as string) as sensor_name",
        "'final_outlet' as sensor_stage",
        "'final-quality-monitor' as sensor_type",
        "cast(null as string) as manufacturer",
        "cast(null as string) as model",
        "cast(null as string) as unit_group",
        "cast(null as date) as installation_date",
        "cast(null as date) as calibration_date",
        "'Active' as sensor_status",
    )


def as_event_json(derived: DataFrame) -> DataFrame:
    """Readings as the JSON documents a producer would send, in a `value` column."""
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields = ["reading_id", "station_id", "sensor_id", stamp.alias("timestamp"), *S.MEASURES]
    return derived.select(
        F.to_json(F.struct(*fields, F.lit("stream").alias("data_source"))).alias("value")
    )
