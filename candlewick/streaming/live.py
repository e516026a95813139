"""Live ticks: decoding, candles, upserts and indicators as streaming queries.

Give each query its own checkpoint location. ``available_now`` runs take what is there
and stop; otherwise a query runs until it is stopped or awaited with a time limit.
"""

from __future__ import annotations

from collections.abc import Callable
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.ticks import accepted, decode_ticks
from candlewick.operators import merge
from candlewick.operators.indicators import latest_candles, latest_indicators
from candlewick.operators.joins import resolve_symbols
from candlewick.operators.resample import (
    SECONDS,
    arrival_step,
    candle_columns,
    candles,
    closed_candles,
    open_candles,
)
from candlewick.schemas import CANDLES, TICK_ENVELOPE
from candlewick.sources import folders
from candlewick.sources.store import Store


def tick_envelopes(
    spark: SparkSession, folder: str, form: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """A stream of raw ticks from files landing in ``folder``."""
    reader = spark.readStream.schema(TICK_ENVELOPE).format(form)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ticks(envelopes: DataFrame, instruments: DataFrame) -> DataFrame:
    """Usable ticks of known instruments; works on static frames just the same."""
    return resolve_symbols(accepted(decode_ticks(envelopes)), instruments)


def candle_stream(stream: DataFrame, timeframe: str = "15sec", lateness: str = "1 minute") -> DataFrame:
    """Event-time candles, each emitted once its interval is past the watermark.

    Ticks later than ``lateness`` are dropped; where none may be lost, use
    :func:`store_tick_candles`, which keeps no watermark.
    """
    return (
        # Watermarks are only defined on zoned timestamps.
        stream.withColumn("time", F.col("time").cast("timestamp"))
        .withWatermark("time", lateness)
        .groupBy("instrument_id", F.window("time", f"{SECONDS[timeframe]} seconds").alias("_window"))
        .agg(*[column.alias(name) for name, column in candle_columns(F.col("seq")).items()])
        .withColumn("time", F.col("_window.start").cast("timestamp_ntz"))
        .select(*CANDLES.names)
    )


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = "15 seconds",
) -> StreamingQuery:
    """Run ``handle`` on every micro-batch."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_until(
    query: StreamingQuery, seconds: float | None = None, items: int | None = None
) -> int:
    """Let ``query`` run until that many seconds or input rows have passed, then stop it.

    Rows are counted between micro-batches, so the last one is always finished. Returns
    the number of rows taken in.
    """
    deadline = None if seconds is None else monotonic() + seconds
    taken, counted = 0, -1
    while not query.awaitTermination(0.2):
        for progress in query.recentProgress:
            if progress.batchId > counted:
                taken, counted = taken + progress.numInputRows, progress.batchId
        if (items is not None and taken >= items) or (deadline is not None and monotonic() >= deadline):
            query.stop()
            break
    for progress in query.recentProgress:
        if progress.batchId > counted:
            taken, counted = taken + progress.numInputRows, progress.batchId
    return taken


def store_candles(store: Store, timeframe: str) -> Callable[[DataFrame, int], None]:
    """Upsert finished candles of :func:`candle_stream`."""

    def handle(batch: DataFrame, _: int) -> None:
        store.upsert_candles(batch, timeframe, order=("time",))

    return handle


def store_tick_candles(store: Store, state: str, timeframe: str = "15sec") -> Callable[[DataFrame, int], None]:
    """Merge the ticks of each batch into the stored candles of their intervals, however late they are.

    What a batch finds standing is written under ``state`` first, so a repeated batch starts
    from the same candles and gives the same result.
    """
    spark = store.spark

    def handle(batch: DataFrame, batch_id: int) -> None:
        found = f"{state}/{batch_id}"
        with store.durable(candles(batch, SECONDS[timeframe])) as fresh:
            if not folders.exists(spark, f"{found}/_SUCCESS"):
                keys = fresh.select("time", "instrument_id")
                store.standing_candles(keys, timeframe).write.mode("overwrite").parquet(found)
            standing = spark.read.schema(CANDLES).parquet(found)
            old = standing.select(
                "time", "instrument_id", F.lit(True).alias("_old"), *[F.col(c).alias(f"_{c}") for c in CANDLES.names[2:]]
            )
            merged = fresh.join(old, ["time", "instrument_id"], "left").select(
                "time",
                "instrument_id",
                F.when(F.col("_old"), F.col("_open")).otherwise(F.col("open")).alias("open"),
                F.greatest("high", "_high").alias("high"),
                F.least("low", "_low").alias("low"),
                "close",
                F.coalesce(F.col("volume") + F.col("_volume"), "volume", "_volume").alias("volume"),
                "open_interest",
            )
            store.upsert_candles(merged, timeframe, order=("time",))
        folders.delete(spark, f"{state}/{batch_id - 2}")

    return handle


def store_ticks(store: Store, timeframe: str = "1min") -> Callable[[DataFrame, int], None]:
    """Upsert each tick as it is at its own time, the last arrival winning."""

    def handle(batch: DataFrame, _: int) -> None:
        store.upsert_candles(batch, timeframe, order=("seq",))

    return handle


def resolving(
    store: Store, handle: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """``handle`` for batches of raw envelopes: each batch meets the instruments known by then,
    so those added while the stream runs count from their next tick on."""

    def resolve(batch: DataFrame, batch_id: int) -> None:
        handle(ticks(batch, store.instruments()), batch_id)

    return resolve


def refresh_indicators(
    store: Store, timeframe: str = "1min"
) -> Callable[[DataFrame, int], None]:
    """Recompute the newest indicators of the instruments in each batch.

    Each comes from the instrument's newest 100 candles, with those of the batch. They are
    read from the candle table, so imported and corrected candles count; of the table only
    the newest days are read, as far back as these instruments need.
    """

    def handle(batch: DataFrame, _: int) -> None:
        touched = batch.select("instrument_id").distinct()
        known = store.newest_candles(touched, timeframe)
        newest = latest_candles(merge.upserted(known, batch, merge.CANDLE_KEY, ("seq",)))
        store.upsert_indicators(latest_indicators(newest.drop("recency"), timeframe))

    return handle


def store_and_refresh(store: Store, timeframe: str = "1min") -> Callable[[DataFrame, int], None]:
    """Upsert the ticks of each batch, then refresh their instruments' indicators."""
    steps = store_ticks(store, timeframe), refresh_indicators(store, timeframe)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with store.one_refresh(), store.durable(batch) as held:
            for step in steps:
                step(held, batch_id)

    return handle


def store_arrival_candles(
    store: Store, state: str, timeframe: str = "15sec"
) -> Callable[[DataFrame, int], None]:
    """Upsert candles closed by arrival order.

    The open candles after batch n are written under ``state`` as ``n``; a repeated
    batch starts again from n - 1 and so repeats its result. Earlier ones are removed.
    """
    spark = store.spark

    def handle(batch: DataFrame, batch_id: int) -> None:
        earlier = f"{state}/{batch_id - 1}"
        standing = spark.read.parquet(earlier) if folders.exists(spark, earlier) else None
        with (
            store.durable(batch) as held,
            store.durable(arrival_step(held, standing, SECONDS[timeframe], by="instrument_id")) as groups,
        ):
            store.upsert_candles(closed_candles(groups, "instrument_id"), timeframe, order=("time",))
            open_candles(groups, "instrument_id").write.mode("overwrite").parquet(f"{state}/{batch_id}")
        folders.delete(spark, f"{state}/{batch_id - 2}")

    return handle
