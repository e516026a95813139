from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from candlewick.operators.resample import (
    arrival_candles,
    arrival_step,
    candles,
    closed_candles,
    open_candles,
)
from helpers import assert_same_rows

TICKS = (
    "seq bigint, symbol string, time timestamp_ntz, open double, close double, volume bigint, "
    "open_interest bigint"
)
T0 = datetime(2024, 3, 1, 9, 15)


def floor(time: datetime) -> datetime:
    return time.replace(second=time.second // 15 * 15, microsecond=0)


def disordered_ticks(seed: int, n: int = 400) -> list[tuple]:
    draw = random.Random(seed)
    clock = {"A": T0, "B": T0, "C": T0}
    rows = []
    for seq in range(n):
        symbol = draw.choice("AAAAAB")
        clock[symbol] += timedelta(seconds=draw.choice([0.4, 2, 5, 20]))
        when = clock[symbol] - timedelta(seconds=draw.choice([0, 0, 0, 12, 31]))
        price = draw.randint(1, 99) / 2
        rows.append((seq, symbol, when, price, price + draw.choice([0, 1]), draw.randint(0, 9), draw.choice([None, 5, 6])))
    rows.append((n, "C", T0, 1.0, 1.0, 1, None))
    return rows


def tick_loop(rows: list[tuple]) -> dict:
    """Candle by candle as the ticks arrive: the boundary tick goes to the old candle."""
    buffers, last, out = {}, {}, {}
    for seq, symbol, time, open_, close, volume, interest in sorted(rows):
        bucket = floor(time)
        buffers.setdefault(symbol, []).append((open_, close, volume, interest))
        if symbol not in last:
            last[symbol] = bucket
        elif bucket > last[symbol]:
            held = buffers[symbol]
            closes = [t[1] for t in held]
            out[symbol, bucket] = (
                held[0][0], max(closes), min(closes), closes[-1], sum(t[2] for t in held), held[-1][3]
            )
            buffers[symbol], last[symbol] = [], bucket
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_arrival_candles_match_a_tick_loop(spark, seed):
    rows = disordered_ticks(seed)
    want = tick_loop(rows)
    got = arrival_candles(spark.createDataFrame(rows, TICKS)).collect()
    assert len(want) > 50
    assert {
        (r.symbol, r.time): (r.open, r.high, r.low, r.close, r.volume, r.open_interest) for r in got
    } == want


def test_arrival_steps_add_up_to_one_pass(spark):
    rows = disordered_ticks(9, 240)
    whole = arrival_candles(spark.createDataFrame(rows, TICKS))
    standing, parts = None, []
    for low in range(0, 241, 61):
        batch = [r for r in rows if low <= r[0] < low + 61]
        groups = arrival_step(spark.createDataFrame(batch, TICKS), standing).checkpoint()
        parts.append(closed_candles(groups))
        standing = open_candles(groups).checkpoint()
        if low:
            # Symbols without ticks in a batch keep their open candle.
            assert standing.where("symbol = 'A'").count() == 1
    stepped = parts[0]
    for part in parts[1:]:
        stepped = stepped.unionByName(part)
    assert_same_rows(stepped, whole, ["symbol", "time"])


def test_event_time_candles(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [
        (3, "A", at(3), 7.0, 2.0, 1, 7),
        (1, "A", at(0), 5.0, 4.0, 1, 9),
        (2, "A", at(3), 6.0, 9.0, 4, 8),
        (4, "A", at(15), 1.0, 1.0, 1, 7),
        (5, "A", at(14), 8.0, 3.0, 2, None),
    ]
    got = candles(spark.createDataFrame(rows, TICKS), 15, by=("symbol",)).orderBy("time").collect()
    assert [tuple(r) for r in got] == [
        ("A", at(0), 5.0, 9.0, 2.0, 3.0, 8, None),
        ("A", at(15), 1.0, 1.0, 1.0, 1.0, 1, 7),
    ]


def test_a_boundary_tick_closes_the_old_candle(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [(1, "A", at(1), 1.0, 1.0, 1, 1), (2, "A", at(16), 2.0, 2.0, 1, 2), (3, "A", at(17), 3.0, 3.0, 1, 3)]
    got = arrival_candles(spark.createDataFrame(rows, TICKS)).collect()
    assert [tuple(r) for r in got] == [("A", at(15), 1.0, 2.0, 1.0, 2.0, 2, 2)]


def test_crowded_intervals_are_reduced_before_the_shuffle(spark):
    frame = spark.createDataFrame(disordered_ticks(1), TICKS)
    plan = candles(frame, 15, by=("symbol",))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "HashAggregate" in plan and "SortAggregate" not in plan
