from __future__ import annotations

import pytest

from candlewick.operators.indicators import indicators
from candlewick.operators.joins import latest
from candlewick.operators.signals import scalping_signals
from candlewick.schemas import INSTRUMENTS
from candlewick.sources.sql import register_functions
from candlewick.sources.store import Store
from helpers import candle_frame, random_candles


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("sql")))
    made.replace(
        "instruments",
        spark.createDataFrame([(i, f"S{i}", "stock", None, None, None, None) for i in (1, 2)], INSTRUMENTS),
    )
    for timeframe, seed in (("1min", 3), ("15sec", 4)):
        frame = candle_frame(spark, random_candles(seed, {1: 50, 2: 50}, gappy=False))
        made.append(f"candle_data_{timeframe}", frame)
        made.upsert_indicators(indicators(frame, timeframe))
    register_functions(made)
    return made


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest(spark, store):
    want = latest(store.candles(), store.instruments(), store.indicators(), limit=7)
    assert rows(spark.sql("SELECT * FROM get_latest_scalping_data(7)")) == rows(want)
    assert spark.sql("SELECT * FROM get_latest_scalping_data()").count() == 100


def test_latest_of_a_symbol(spark, store):
    want = latest(store.candles(), store.instruments(), store.indicators(), limit=5, symbol="S2")
    got = spark.sql("SELECT * FROM get_instrument_scalping_data('S2', 5)")
    assert rows(got) == rows(want)
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("timeframe", ["1min", "15sec"])
@pytest.mark.parametrize("symbol", [None, "S1"])
def test_signals(spark, store, timeframe, symbol):
    want = scalping_signals(
        store.candles(timeframe), store.indicators(), store.instruments(), timeframe, symbol, 30
    )
    named = "NULL" if symbol is None else f"'{symbol}'"
    got = spark.sql(f"SELECT * FROM generate_scalping_signals_flexible('{timeframe}', {named}, 30)")
    assert rows(got) == rows(want)


def test_views_see_later_writes(spark, tmp_path):
    made = Store(spark, str(tmp_path))
    register_functions(made)
    assert spark.sql("SELECT * FROM scalping_data").count() == 0
    made.append("instruments", spark.createDataFrame([(1, "S1", "stock", None, None, None, None)], INSTRUMENTS))
    frame = candle_frame(spark, random_candles(5, {1: 40, 2: 40}, gappy=False))
    made.upsert_candles(frame, "1min", order=("time",))
    assert spark.sql("SELECT * FROM scalping_data").count() == 40
    made.upsert_candles(frame, "1min", order=("time",))
    made.append("instruments", spark.createDataFrame([(2, "S2", "stock", None, None, None, None)], INSTRUMENTS))
    assert spark.sql("SELECT * FROM get_latest_scalping_data(70)").count() == 70
    assert spark.sql("SELECT * FROM scalping_signals").count() == 80


@pytest.mark.parametrize("timeframe", ["1min", "15sec"])
@pytest.mark.parametrize("window", [1, 7, 500])
def test_moving_average(spark, store, timeframe, window):
    register_functions(store)  # others may have put their own in their place
    got = spark.sql(f"SELECT * FROM calculate_moving_average(2, '{timeframe}', {window})").collect()
    closes = [r.close for r in store.candles(timeframe).where("instrument_id = 2").orderBy("time").collect()]
    found = [r.ma for r in sorted(got)]
    assert len(found) == len(closes)
    for i, ma in enumerate(found):
        own = closes[max(0, i + 1 - window) : i + 1]
        assert ma == pytest.approx(sum(own) / len(own), rel=1e-9)


def test_views_start_no_jobs(spark, tmp_path):
    """Making the views anew after a write lists files; it computes nothing."""
    made = Store(spark, str(tmp_path))
    made.append("instruments", spark.createDataFrame([(1, "S1", "stock", None, None, None, None)], INSTRUMENTS))
    made.upsert_candles(candle_frame(spark, random_candles(5, {1: 40}, gappy=False)), "1min", order=("time",))
    register_functions(made)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "views")
    try:
        made.refresh_views()
        assert list(tracker.getJobIdsForGroup("views")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.sql("SELECT * FROM market_summary").count() == 39
