"""Rings of the newest candles against the whole history, over any cut into batches."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators.indicators import latest_candles, latest_indicators
from candlewick.operators.merge import CANDLE_KEY, upserted
from candlewick.schemas import INSTRUMENTS, TICK_ENVELOPE
from candlewick.sources.store import Store
from candlewick.streaming import live, newest
from helpers import assert_same_rows
from test_streaming import envelope_rows, run, write_files

BIG = 2**53 + 1


@pytest.mark.parametrize("files", [1, 3, 6])
def test_stream_equals_the_whole_history(spark, tmp_path, files):
    store = Store(spark, str(tmp_path / "store"))
    known = [(1, "A", None, None, None, None, None), (2, "B", None, None, None, None, None)]
    store.replace("instruments", spark.createDataFrame(known, INSTRUMENTS))
    write_files(tmp_path / "in", envelope_rows(300, late=200), files)
    static = live.ticks(spark.read.schema(TICK_ENVELOPE).json(str(tmp_path / "in")), store.instruments())
    ticks = live.ticks(live.tick_envelopes(spark, str(tmp_path / "in"), files_per_batch=1), store.instruments())
    run(newest.newest_candle_stream(ticks), newest.store_newest_indicators(store), tmp_path / "cp")
    candles = upserted(store.candles(), static, CANDLE_KEY, ("seq",))
    assert candles.groupBy("instrument_id").count().agg(F.max("count")).first()[0] > 60
    at = store.indicators().groupBy("instrument_id").agg(F.max("time").alias("time"))
    got = store.indicators().join(at, ["instrument_id", "time"]).select(*store.indicators().columns)
    assert_same_rows(got, latest_indicators(candles), ["instrument_id"])


def test_ring_is_the_newest_rows_and_keeps_values(spark, tmp_path):
    draw = random.Random(2)
    rows, t0 = [], datetime(2024, 3, 1, 9, 15, 0, 123456)
    for seq in range(90):
        time = t0 + timedelta(minutes=draw.randint(0, 30))
        rows.append((time, 5 + seq % 2, seq, 0.1 * seq, float("nan"), None, 1e300, BIG + seq, None if seq % 3 else BIG))
    schema = (
        "time timestamp_ntz, instrument_id bigint, seq bigint, open double, high double, low double, close double, "
        "volume bigint, open_interest bigint"
    )
    whole = spark.createDataFrame(rows, schema)
    for k in range(3):
        whole.where((F.col("seq") >= 30 * k) & (F.col("seq") < 30 * k + 30)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []
    run(newest.newest_candle_stream(stream, rows=7), lambda batch, n: seen.append(batch.collect()), tmp_path / "cp")
    last = {}
    for batch in seen:
        assert len(batch) <= 2 * 7
        for i in {r["instrument_id"] for r in batch}:
            last[i] = [r for r in batch if r["instrument_id"] == i]
    got = spark.createDataFrame([r for rows in last.values() for r in rows], whole.drop("seq").schema)
    latest = whole.groupBy("instrument_id", "time").agg(F.max_by(F.struct(*whole.columns[3:]), "seq").alias("v"))
    want = latest_candles(latest.select("time", "instrument_id", "v.*"), 7).drop("recency")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


class State:
    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):  # noqa: N802
        self.timeout = ms


def test_old_and_repeated_ticks_change_nothing_and_idle_state_goes():
    def frame(*rows):
        return pd.DataFrame(rows, columns=["instrument_id", "at", "seq", "candle"])

    step, state = newest._step(3, 5000), State()
    first = frame((1, 10, 1, "a"), (1, 20, 2, "b"), (1, 30, 3, "c"), (1, 30, 4, "d"))
    (out,) = step((1,), [first.iloc[:2], first.iloc[2:]], state)
    assert out.to_numpy().tolist() == [[1, 10, "a"], [1, 20, "b"], [1, 30, "d"]] and state.timeout == 5000
    assert list(step((1,), [first, frame((1, 5, 9, "old")), frame()], state)) == []
    (out,) = step((1,), [frame((1, 15, 10, "e"), (1, 20, 11, "f"))], state)
    assert out["candle"].tolist() == ["e", "f", "d"] and len(json.loads(state.get[0])) == 3
    state.hasTimedOut = True
    assert list(step((1,), [], state)) == [] and not state.exists


def test_rows_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        newest.newest_candle_stream(None, rows=0)
