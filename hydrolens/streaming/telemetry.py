"""Structured Streaming from raw events to stored facts and marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hydrolens import schema as S
from hydrolens.operators import ingest
from hydrolens.plans.marts import Clock
from hydrolens.session import configure
from hydrolens.sources.warehouse import Warehouse

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """De-duplication state outside the heap; set it before the first start of a query."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def clean_stream(raw: DataFrame, watermark_delay: str = S.WATERMARK_DELAY) -> DataFrame:
    """Decoded events, one per station, sensor and event time; later ones than the watermark
    allows are dropped.

    The event time is part of the key, so the state holds no more than the watermark delay's
    worth of keys. Rows without an event time are dropped before, they would never leave the
    state. The state is kept per key and therefore spread over all partitions, also when one
    station sends a third of the events.
    """
    events = ingest.parse_event_time(ingest.require_ids(ingest.decode_events(raw)))
    return (
        ingest.warehouse_rows(events)
        .withWatermark("event_timestamp", watermark_delay)
        .dropDuplicates(ingest.READING_KEY)
    )


def scored_stream(raw: DataFrame, watermark_delay: str = S.WATERMARK_DELAY) -> DataFrame:
    return ingest.score_readings(clean_stream(raw, watermark_delay))


def enriched_stream(
    raw: DataFrame, stations: DataFrame, sensors: DataFrame, watermark_delay: str = S.WATERMARK_DELAY
) -> DataFrame:
    """Scored events with the columns of their station and sensor. The dimensions are static frames, which
    Spark reads again for every batch."""
    return ingest.enrich(scored_stream(raw, watermark_delay), stations, sensors)


def batch_writer(
    warehouse: Warehouse,
    refresh_every: int | None = 1,
    clock: Callable[[], Clock] = lambda: Clock(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)),
) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` function: store the batch, then refresh rollups and marts.

    The refresh runs when `refresh_every` batches wait for it, whether or not the present one is empty; if
    None it is left to the caller. Running a batch again replaces what it wrote.
    """

    def write(scored: DataFrame, batch_id: int) -> None:
        # Spark keeps the query's id with the checkpoint.
        run = warehouse.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "manual"
        warehouse.append_batch(scored, batch_id, run)
        if refresh_every is not None and warehouse.batches_waiting() >= refresh_every:
            warehouse.refresh(clock())

    return write


def start(
    raw: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    trigger: dict | None = None,
    watermark_delay: str = S.WATERMARK_DELAY,
    **writer_options,
) -> StreamingQuery:
    """Starts the query; by default a micro-batch every ten seconds."""
    configure(warehouse.spark)
    return (
        scored_stream(raw, watermark_delay)
        .writeStream.foreachBatch(batch_writer(warehouse, **writer_options))
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def late_events(query: StreamingQuery) -> tuple[int, int]:
    """Events that a query has read since its start, and those of them that came after the watermark had
    passed them, from its recent progress (spark.sql.streaming.numRecentProgressUpdates batches)."""
    read = dropped = 0
    for progress in query.recentProgress:
        read += progress["numInputRows"]
        dropped += sum(operator["numRowsDroppedByWatermark"] for operator in progress["stateOperators"])
    return read, dropped


def held_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys in the de-duplication state of a checkpoint, as its last batch left them. After a batch, these are
    the keys above its watermark, however many came before."""
    return spark.read.format("statestore").load(checkpoint).select("key.*").select(ingest.READING_KEY)
