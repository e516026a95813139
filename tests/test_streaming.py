from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick.operators.indicators import latest_indicators
from candlewick.operators.resample import arrival_candles, candles
from candlewick.schemas import CANDLES, INSTRUMENTS, TICK_ENVELOPE
from candlewick.sources.store import Store
from candlewick.streaming import live
from helpers import assert_same_rows

T0 = datetime(2024, 3, 1, 9, 15)


def envelope_rows(n=240, late=0):
    draw = random.Random(11)
    when, rows = T0, []
    for seq in range(n):
        when += timedelta(seconds=draw.choice([1, 3, 9]))
        time = when - timedelta(seconds=draw.choice([0, 0, late]))
        symbol = draw.choice(["A", "A", "B", "GHOST"])
        price = draw.randint(10, 99)
        if draw.random() < 0.5:
            data = json.dumps({"time": time.isoformat(), "open": price, "high": price, "low": price, "close": price, "volume": 3, "oi": seq})
        else:
            clock = f"{time:%H%M}"
            data = f"x,y,{time:%Y%m%d},{clock},{price},{price},{price},{price},2,"
        if seq % 50 == 7:
            data = "junk"
        rows.append({"seq": seq, "channel": f"{symbol}.JSON", "data": data, "timestamp": when.isoformat()})
    return rows


def write_files(folder, rows, files=4):
    folder.mkdir(exist_ok=True)
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size : (i + 1) * size]
        file = folder / f"{i:03d}.json"
        file.write_text("\n".join(map(json.dumps, part)))
        # Files are taken in the order of their times.
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture
def feed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.replace(
        "instruments",
        spark.createDataFrame([(1, "A", None, None, None, None, None), (2, "B", None, None, None, None, None)], INSTRUMENTS),
    )
    rows = envelope_rows(late=31)
    write_files(tmp_path / "in", rows)
    static = spark.read.schema(TICK_ENVELOPE).json(str(tmp_path / "in"))
    return store, tmp_path, static


def run(stream, handle, checkpoint):
    query = live.start(stream, handle, str(checkpoint), available_now=True)
    assert query.awaitTermination(120)


def stream_of(spark, path, store):
    return live.ticks(live.tick_envelopes(spark, str(path / "in"), files_per_batch=1), store.instruments())


def test_event_time_stream_equals_batch(spark, feed):
    store, path, static = feed
    handle = live.store_candles(store, "15sec")
    run(live.candle_stream(stream_of(spark, path, store), "15sec", "10 minutes"), handle, path / "cp")
    batch = candles(live.ticks(static, store.instruments()), 15)
    # A watermark ten minutes behind leaves the newest intervals open.
    end = live.ticks(static, store.instruments()).agg(F.max("time")).first()[0]
    finished = batch.where(F.col("time") <= F.lit(end - timedelta(minutes=10, seconds=15)))
    assert finished.count() > 20
    assert_same_rows(
        store.candles("15sec").where(F.col("time") <= F.lit(end - timedelta(minutes=10, seconds=15))),
        finished.select(*store.candles("15sec").columns),
        ["time", "instrument_id"],
    )
    # A later file closes them, and a restart from the checkpoint repeats nothing.
    closing = [{"seq": 999, "channel": "A.JSON", "data": json.dumps({"time": "2024-03-02T00:00:00"}), "timestamp": T0.isoformat()}]
    write_files(path / "in2", closing, 1)
    (path / "in2" / "000.json").replace(path / "in" / "900.json")
    run(live.candle_stream(stream_of(spark, path, store), "15sec", "10 minutes"), handle, path / "cp")
    assert_same_rows(
        store.candles("15sec"),
        batch.select(*store.candles("15sec").columns),
        ["time", "instrument_id"],
    )


def test_late_rows_are_dropped_past_the_watermark(spark, feed):
    store, path, _ = feed
    early = [{"seq": 0, "channel": "A.JSON", "data": json.dumps({"time": "2024-03-01T10:00:00", "close": 5}), "timestamp": T0.isoformat()}]
    later = [
        {"seq": 1, "channel": "A.JSON", "data": json.dumps({"time": "2024-03-01T10:30:00", "close": 6}), "timestamp": T0.isoformat()},
    ]
    late = [{"seq": 2, "channel": "A.JSON", "data": json.dumps({"time": "2024-03-01T10:00:02", "close": 9}), "timestamp": T0.isoformat()}]
    folder = path / "late"
    for i, rows in enumerate([early, later, late]):
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        stream = live.ticks(live.tick_envelopes(spark, str(folder)), store.instruments())
        run(live.candle_stream(stream, "15sec", "1 minute"), live.store_candles(store, "15sec"), path / "cpl")
    rows = store.candles("15sec").collect()
    assert [(r.time, r.close) for r in rows] == [(datetime(2024, 3, 1, 10, 0), 5.0)]


def test_late_ticks_are_merged_without_a_watermark(spark, feed):
    store, path, static = feed
    handle = live.store_tick_candles(store, str(path / "state"))
    run(stream_of(spark, path, store), handle, path / "cp")
    want = candles(live.ticks(static, store.instruments()), 15)
    assert_same_rows(store.candles("15sec"), want.select(*store.candles("15sec").columns), ["time", "instrument_id"])
    last = live.ticks(static, store.instruments()).where("seq >= 180")
    handle(last, 3)  # the last batch once more
    assert_same_rows(store.candles("15sec"), want.select(*store.candles("15sec").columns), ["time", "instrument_id"])


def test_arrival_stream_equals_batch(spark, feed):
    store, path, static = feed
    known = live.ticks(static, store.instruments())
    want = arrival_candles(known, by="instrument_id")
    handle = live.store_arrival_candles(store, str(path / "state"))
    run(stream_of(spark, path, store), handle, path / "cp")
    got = store.candles("15sec")
    assert want.count() > 20
    assert_same_rows(got, want.select(*got.columns), ["time", "instrument_id"])


def test_a_repeated_batch_leaves_the_same_candles(spark, feed):
    store, path, static = feed
    known = live.ticks(static, store.instruments())
    handle = live.store_arrival_candles(store, str(path / "state"))
    handle(known.where("seq < 120"), 0)
    handle(known.where("seq >= 120"), 1)
    first = sorted(store.candles("15sec").collect())
    handle(known.where("seq >= 120"), 1)
    assert sorted(store.candles("15sec").collect()) == first


def test_ticks_are_upserted_and_indicators_refreshed(spark, feed):
    store, path, static = feed
    run(stream_of(spark, path, store), live.store_and_refresh(store), path / "cp")
    known = live.ticks(static, store.instruments())
    want = known.groupBy("time", "instrument_id").agg(F.max_by("close", "seq").alias("close"))
    assert_same_rows(store.candles().select("time", "instrument_id", "close"), want, ["time", "instrument_id"])
    newest = store.indicators().groupBy("instrument_id").agg(F.max("time").alias("time"))
    last = store.indicators().join(newest, ["instrument_id", "time"]).select(*store.indicators().columns)
    assert_same_rows(last, latest_indicators(store.candles()), ["instrument_id"])


def test_backfilled_candles_and_new_instruments_count(spark, feed):
    store, path, static = feed
    handle = live.resolving(store, live.store_and_refresh(store))
    handle(static.where("seq < 120"), 0)
    ids = [r.instrument_id for r in store.instruments().collect()]
    back = [(T0.replace(tzinfo=None) - timedelta(days=40, minutes=i), ids[0], 50.0, 50.0, 50.0, 50.0 + i % 3, 10, None) for i in range(30)]
    store.upsert_candles(spark.createDataFrame(back, CANDLES), "1min", order=("time",))
    new = spark.createDataFrame([(99, "NEW", "stock", None, None, None, None)], INSTRUMENTS)
    store.append("instruments", new)
    fresh = spark.createDataFrame(
        [(500, "NEW.JSON", json.dumps({"time": "2024-03-01T12:00:00", "close": 3}), T0)], TICK_ENVELOPE
    )
    handle(static.where("seq >= 120").unionByName(fresh), 1)
    newest = store.indicators().groupBy("instrument_id").agg(F.max("time").alias("time"))
    last = store.indicators().join(newest, ["instrument_id", "time"]).select(*store.indicators().columns)
    assert 99 in {r.instrument_id for r in last.collect()}
    assert_same_rows(last, latest_indicators(store.candles()), ["instrument_id"])
    assert not (path / "store" / "_scratch").exists() or not any((path / "store" / "_scratch").iterdir())


def test_runs_stop_after_rows_or_seconds(spark, feed):
    store, path, _ = feed
    seen = []
    query = live.start(
        live.tick_envelopes(spark, str(path / "in"), files_per_batch=1),
        lambda batch, number: seen.append(batch.count()),
        str(path / "cp"),
        interval="0 seconds",
    )
    taken = live.run_until(query, seconds=60, items=100)
    assert not query.isActive
    assert 100 <= taken <= sum(seen) <= 240
    again = live.start(
        live.tick_envelopes(spark, str(path / "in")), lambda batch, number: None, str(path / "cp2")
    )
    live.run_until(again, seconds=1)
    assert not again.isActive
