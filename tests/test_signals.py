from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from candlewick.operators.filters import candle_range, clock, first_two_hours, recent, retained
from candlewick.operators.indicators import indicators
from candlewick.operators.joins import enriched_candles, latest, resolve_symbols, unknown_symbols
from candlewick.operators.signals import of_type, scalping_signals, signal_counts, signal_rows
from candlewick.operators.summary import exportable, market_summary
from candlewick.schemas import INDICATORS, SIGNALS
from helpers import START, candle_frame, flat_candles, random_candles

NAMES = "instrument_id bigint, symbol string, instrument_type string, option_type string, strike_price decimal(18,4)"


@pytest.fixture
def names(spark):
    return spark.createDataFrame([(1, "A", "option", "CE", None), (2, "B", "index", None, None)], NAMES)


def readings(spark, rsi, obv, timeframe="1min"):
    return spark.createDataFrame(
        [
            (START + timedelta(minutes=i), 1, timeframe, None, float(o), None if r is None else float(r), None, None)
            for i, (r, o) in enumerate(zip(rsi, obv))
        ],
        INDICATORS,
    )


def last_signal(spark, names, closes, volumes, rsi, obv):
    candles = flat_candles(spark, closes, volumes)
    rows = scalping_signals(candles, readings(spark, rsi, obv), names).collect()
    return max(rows, key=lambda r: r.time).signal_type


@pytest.mark.parametrize(
    "closes, volumes, rsi, obv, want",
    [
        ([5, 5, 9], [10, 10, 90], [40, 40, 20], [0, 0, 5], "buy"),
        ([5, 5, 9], [10, 10, 12], [40, 15, 20], [0, 0, 5], "trend_up"),
        ([5, 5, 9], [10, 10, 90], [40, 15, 20], [0, 5, 5], "trend_up"),
        ([9, 9, 5], [10, 10, 90], [40, 90, 80], [0, 5, 0], "sell"),
        ([9, 9, 5], [10, 10, 12], [40, 90, 80], [0, 5, 0], "trend_down"),
        ([5, 5, 9], [10, 10, 90], [40, 50, 50], [0, 0, 5], "hold"),
        ([5, 5, 5], [10, 10, 90], [40, 50, 60], [0, 0, 5], "hold"),
        ([5, 5, 9], [10, 10, 90], [40, 40, None], [0, 0, 5], "hold"),
        ([5, 5, 9], [10, 10, 90], [40, 40], [0, 0], "hold"),
    ],
)
def test_rules(spark, names, closes, volumes, rsi, obv, want):
    assert last_signal(spark, names, closes, volumes, rsi, obv) == want


def test_other_timeframes_do_not_join(spark, names):
    candles = flat_candles(spark, [5, 5, 9], [10, 10, 90])
    rows = scalping_signals(candles, readings(spark, [40, 40, 20], [0, 0, 5], "15sec"), names).collect()
    assert {r.signal_type for r in rows} == {"hold"}
    assert all(r.rsi is None for r in rows)


def test_limit_cuts_after_the_windows_and_symbols_stay_apart(spark, names):
    frame = candle_frame(spark, random_candles(8, {1: 60, 2: 60}, gappy=False))
    ind = indicators(frame)
    every = {(r.symbol, r.time): r for r in scalping_signals(frame, ind, names, limit=None).collect()}
    assert len(every) == 120
    top = scalping_signals(frame, ind, names, limit=7).collect()
    assert len(top) == 7 and all(every[r.symbol, r.time] == r for r in top)
    mine = scalping_signals(frame, ind, names, symbol="B", limit=200).collect()
    assert len(mine) == 60 and all(every["B", r.time] == r for r in mine)


def test_counts_split_and_rows(spark, names):
    frame = candle_frame(spark, random_candles(8, {1: 80, 2: 80}, gappy=False))
    signals = scalping_signals(frame, indicators(frame), names, limit=None).cache()
    counts = {r.signal_type: r.signals for r in signal_counts(signals).collect()}
    assert sum(counts.values()) == 160
    assert of_type(signals, "trend_up").count() == counts["trend_up"]
    rows = signal_rows(signals, names, clock("2024-01-01"))
    assert [f.name for f in rows.schema] == SIGNALS.names
    extra = json.loads(rows.where("signal_type = 'trend_up'").first().extra)
    assert set(extra) <= {"rsi", "obv", "tvi", "volume", "ma5", "ma20", "avg_vol20"} and "rsi" in extra


def test_summary_compares_with_the_later_candle(spark, names):
    candles = flat_candles(spark, [10, 8, 0, 5], interest=[1, None, 3, 4])
    ind = readings(spark, [71, 29, 50, 99], [1, 2, 3, 4])
    rows = market_summary(candles, ind, names, all_data=True).orderBy("latest_time").collect()
    assert [(r.latest_price, r.price_change_pct, r.rsi_signal) for r in rows] == [
        (10.0, 25.0, "Overbought"), (8.0, None, "Oversold"), (0.0, -100.0, "Neutral")
    ]
    back = market_summary(candles, ind, names, all_data=True, direction="previous").orderBy("latest_time").collect()
    assert [(r.latest_price, r.price_change_pct) for r in back] == [(8.0, -20.0), (0.0, -100.0), (5.0, None)]


def test_summary_of_the_last_half_hour(spark, names):
    candles = flat_candles(spark, list(range(1, 61)))
    as_of = START + timedelta(minutes=59)
    rows = market_summary(candles, readings(spark, [50] * 60, [1] * 60), names, as_of=as_of).collect()
    assert len(rows) == 30 and min(r.latest_time for r in rows) == START + timedelta(minutes=29)


def test_export_keeps_complete_finite_rows(spark):
    inf = float("inf")
    rows = spark.createDataFrame([("a", 1.0), ("b", inf), ("c", float("nan")), ("d", None), (None, 1.0), ("e", -inf)], "s string, v double")
    assert [r.s for r in exportable(rows).collect()] == ["a"]


def test_enriched_and_latest(spark, names):
    frame = candle_frame(spark, random_candles(8, {1: 20, 2: 20, 3: 5}, gappy=False))
    view = enriched_candles(frame, names, indicators(frame))
    assert view.count() == 40 and len(view.columns) == 16
    assert len(enriched_candles(frame, names).columns) == 11
    rows = {(r.symbol, r.time): r for r in view.collect()}
    top = latest(frame, names, indicators(frame), limit=3).collect()
    assert [r.symbol for r in top] == ["A", "B", "A"]
    assert [r.time for r in top] == sorted((t for _, t in rows), reverse=True)[:3]
    assert all(rows[r.symbol, r.time] == r for r in top)
    assert {r.symbol for r in latest(frame, names, indicators(frame), limit=5, symbol="B").collect()} == {"B"}
    few = indicators(frame).where("instrument_id = 2")
    assert [r.obv is None for r in latest(frame, names, few, limit=3).collect()] == [True, False, True]


def test_unknown_symbols(spark, names):
    ticks = spark.createDataFrame([("A", 1), ("Z", 2)], "symbol string, seq int")
    assert [r.seq for r in resolve_symbols(ticks, names).collect()] == [1]
    assert [r.seq for r in unknown_symbols(ticks, names).collect()] == [2]


def test_time_filters(spark):
    hours = flat_candles(spark, range(24), step=3600)
    assert sorted(r.time.hour for r in first_two_hours(hours).collect()) == [9, 10]
    as_of = START + timedelta(hours=23)
    assert recent(hours, as_of, minutes=120).count() == 3
    assert retained(hours, as_of, days=0).count() == 1
    assert candle_range(hours, 1, START, START + timedelta(hours=2)).count() == 3
    assert candle_range(hours, 1, "2024-03-01", "2024-03-02").count() == 15
    assert recent(hours).count() == 0
    assert hours.where(F.col("time").isNull()).isEmpty()
