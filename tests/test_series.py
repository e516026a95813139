"""Slicing a dominant instrument must not change any result."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from candlewick.operators.features import training_set
from candlewick.operators.indicators import indicators, moving_average
from candlewick.operators.resample import arrival_candles
from candlewick.operators.series import open_series
from candlewick.operators.signals import scalping_signals
from candlewick.operators.summary import market_summary
from helpers import assert_same_rows, candle_frame, random_candles

SIZES = {1: 900, 2: 40, 3: 13, 4: 1, 5: 260}


@pytest.fixture(scope="module", params=[True, False], ids=["bursts", "even"])
def candles(spark, request):
    return candle_frame(spark, random_candles(7, SIZES, gappy=request.param)).cache()


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(i, f"S{i}") for i in SIZES], "instrument_id bigint, symbol string").withColumns(
        {
            "instrument_type": F.lit("stock"),
            "option_type": F.lit("-"),
            "strike_price": F.lit(1).cast("decimal(18,4)"),
        }
    )


def test_slices_partition_the_rows(candles):
    series = open_series(candles, before=14, after=4, rows_per_slice=50)
    assert series.sliced
    own = series.frame.where("_own")
    assert own.count() == candles.count()
    sizes = {
        (r.instrument_id, r._slice): r.n
        for r in own.groupBy("instrument_id", "_slice").agg(F.count("*").alias("n")).collect()
    }
    assert {i for i, s in sizes if s == 0} == {2, 3, 4}
    assert len([s for i, s in sizes if i == 1]) > 5
    # No slice may be shorter than the reach of a frame.
    assert all(n >= 18 for (i, s), n in sizes.items() if s > 0)


def test_copies_cover_the_reach(candles):
    before, after = 14, 4
    series = open_series(candles, before=before, after=after, rows_per_slice=50)
    rows = sorted(series.frame.where("instrument_id = 1").collect(), key=lambda r: r.time)
    times = sorted({r.time for r in rows})
    place = {t: i for i, t in enumerate(times)}
    for number in {r._slice for r in rows}:
        own = [place[r.time] for r in rows if r._slice == number and r._own]
        held = {place[r.time] for r in rows if r._slice == number}
        assert own == list(range(own[0], own[-1] + 1))
        assert set(range(max(0, own[0] - before), own[0])) <= held
        assert set(range(own[-1] + 1, min(len(times), own[-1] + 1 + after))) <= held


def test_small_instruments_keep_the_plain_window(candles):
    assert not open_series(candles, before=14).sliced


@pytest.mark.parametrize("size", [30, 77, 200])
def test_indicators(candles, size):
    assert_same_rows(
        indicators(candles, rows_per_slice=size), indicators(candles), ["instrument_id", "time"]
    )


def test_moving_average(candles):
    assert_same_rows(
        moving_average(candles, 20, rows_per_slice=50),
        moving_average(candles, 20),
        ["instrument_id", "time"],
    )


def test_signals(candles, names):
    ind = indicators(candles)
    assert_same_rows(
        scalping_signals(candles, ind, names, limit=None, rows_per_slice=60),
        scalping_signals(candles, ind, names, limit=None),
        ["symbol", "time"],
    )


def test_training_set(candles):
    ind = indicators(candles)
    assert_same_rows(
        training_set(candles, ind, rows_per_slice=60),
        training_set(candles, ind),
        ["instrument_id", "time"],
    )


@pytest.mark.parametrize("direction", ["next", "previous"])
def test_summary(candles, names, direction):
    ind = indicators(candles)
    options = dict(all_data=True, direction=direction)
    assert_same_rows(
        market_summary(candles, ind, names, rows_per_slice=40, **options),
        market_summary(candles, ind, names, **options),
        ["symbol", "latest_time"],
    )


def test_arrival_candles(spark, candles):
    ticks = candles.select(
        F.col("instrument_id").alias("symbol"),
        "time",
        "open",
        "close",
        "volume",
        "open_interest",
        (F.unix_micros(F.col("time").cast("timestamp")) + F.pmod(F.hash("time"), F.lit(40_000_000))).alias("seq"),
    )
    assert ticks.groupBy("symbol").agg((F.count("*") - F.countDistinct("seq")).alias("d")).where("d > 0").isEmpty()
    assert_same_rows(
        arrival_candles(ticks, rows_per_slice=50), arrival_candles(ticks), ["symbol", "time"]
    )


def test_slices_stay_small(spark):
    rows = spark.range(20_000).select(
        F.lit(1).cast("bigint").alias("instrument_id"), F.col("id").alias("time")
    )
    series = open_series(rows, rows_per_slice=2)
    assert series.sliced
    assert series.frame.groupBy("_slice").count().agg({"count": "max"}).first()[0] <= 20


def test_plan_has_one_exchange_when_nothing_is_hot(candles):
    plan = indicators(candles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


def test_a_stray_time_does_not_unbalance_the_slices(spark):
    """One row a thousand years ahead leaves the even grid with a single crowded cell."""
    rows = spark.range(2000).select(
        F.lit(1).cast("bigint").alias("instrument_id"),
        (F.col("id") + F.when(F.col("id") == 1999, 10**7).otherwise(0)).alias("time"),
    )
    series = open_series(rows, before=1, rows_per_slice=100)
    sizes = [r["count"] for r in series.frame.groupBy("_slice").count().collect()]
    assert max(sizes) < 250 and len(sizes) > 10
    lagged = series.close(series.frame.withColumn("p", F.lag("time").over(series.window)))
    got = [r.p for r in lagged.orderBy("time").collect()]
    want = [None] + [r.time for r in rows.orderBy("time").collect()][:-1]
    assert got == want
