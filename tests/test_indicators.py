from __future__ import annotations

from datetime import timedelta

import pytest

from candlewick.operators.indicators import (
    indicators,
    latest_candles,
    latest_indicators,
    moving_average,
)
from helpers import (
    START,
    candle_frame,
    close_enough,
    flat_candles,
    prefix_indicators,
    random_candles,
)


def at_end(df):
    return df.orderBy("time").collect()[-1]


def test_matches_a_loop_over_every_prefix(spark):
    rows = random_candles(3, {1: 130, 2: 12, 3: 14}, gappy=False)
    got = {(r.instrument_id, r.time): r for r in indicators(candle_frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for instrument in (1, 2, 3):
        mine = [r for r in rows if r[1] == instrument]
        for i, row in enumerate(mine):
            want = prefix_indicators([r[5] for r in mine[: i + 1]], [r[6] for r in mine[: i + 1]])
            for name, value in want.items():
                assert close_enough(got[instrument, row[0]][name], value), (instrument, i, name)


def test_latest_matches_a_loop_over_the_newest_hundred(spark):
    rows = random_candles(4, {1: 230, 2: 100, 3: 7}, gappy=False)
    got = {r.instrument_id: r for r in latest_indicators(candle_frame(spark, rows), "15sec").collect()}
    assert len(got) == 3
    for instrument in (1, 2, 3):
        mine = [r for r in rows if r[1] == instrument][-100:]
        want = prefix_indicators([r[5] for r in mine], [r[6] for r in mine])
        assert got[instrument].time == mine[-1][0] and got[instrument].timeframe == "15sec"
        for name, value in want.items():
            assert close_enough(got[instrument][name], value), (instrument, name)


def test_one_candle(spark):
    row = at_end(indicators(flat_candles(spark, [5])))
    assert (row.obv, row.pvi, row.rsi, row.tvi, row.pvt) == (0.0, 100.0, None, None, None)


@pytest.mark.parametrize("size, defined", [(13, False), (14, True)])
def test_rsi_needs_fourteen_candles(spark, size, defined):
    row = at_end(indicators(flat_candles(spark, [100 + (i % 3) for i in range(size)])))
    assert (row.rsi is not None) is defined


@pytest.mark.parametrize("size, defined", [(9, False), (10, True)])
def test_tvi_needs_ten_candles(spark, size, defined):
    row = at_end(indicators(flat_candles(spark, [100 + i for i in range(size)])))
    assert (row.tvi is not None) is defined


def test_flat_prices(spark):
    row = at_end(indicators(flat_candles(spark, [7] * 14)))
    assert row.rsi is None and row.obv == 0 and row.pvi == 100


def test_only_gains(spark):
    assert at_end(indicators(flat_candles(spark, range(1, 15)))).rsi == 100.0


def test_zero_volume_frame_is_skipped_in_the_running_tvi(spark):
    volumes = [10] * 12 + [0] * 10 + [10] * 3
    rows = indicators(flat_candles(spark, [100 + i * i for i in range(25)], volumes)).orderBy("time").collect()
    assert rows[21].tvi is None and rows[20].tvi is not None
    assert rows[22].tvi is not None and rows[22].tvi > rows[20].tvi


def test_zero_close_gives_no_term_and_no_error(spark):
    rows = indicators(flat_candles(spark, [5, 0, 4, 6], [1, 2, 3, 4])).orderBy("time").collect()
    assert rows[2].pvt is None
    assert rows[3].pvt == pytest.approx(-2.0 + 0.5 * 4)
    assert rows[3].pvi == 0.0


def test_latest_candles_by_instrument(spark):
    rows = random_candles(5, {1: 120, 2: 30}, gappy=False)
    got = latest_candles(candle_frame(spark, rows)).collect()
    assert sorted((r.instrument_id, r.recency) for r in got) == [(1, i) for i in range(1, 101)] + [
        (2, i) for i in range(1, 31)
    ]
    newest = next(r for r in got if r.instrument_id == 1 and r.recency == 1)
    assert newest.time == max(r[0] for r in rows if r[1] == 1)


def test_latest_candles_reduce_before_the_shuffle(spark):
    frame = candle_frame(spark, random_candles(5, {1: 120}, gappy=False))
    plan = latest_candles(frame)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_moving_average_counts_partial_frames(spark):
    got = moving_average(flat_candles(spark, [1, 2, 3, 10]), 3, instrument_id=1).orderBy("time").collect()
    assert [r.ma for r in got] == [1.0, 1.5, 2.0, 5.0]
    assert got[1].time == START + timedelta(minutes=1)
    with pytest.raises(ValueError):
        moving_average(flat_candles(spark, [1]), 0)


def test_many_rows_per_instrument_are_cut_before_the_shuffle(spark):
    frame = latest_candles(candle_frame(spark, random_candles(8, {1: 30})), 5000)
    assert "WindowGroupLimit" in frame._jdf.queryExecution().executedPlan().toString()
