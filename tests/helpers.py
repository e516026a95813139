"""Small frames and plain-loop forms of the operators, written for the tests."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from candlewick.schemas import CANDLES

START = datetime(2024, 3, 1, 9, 15)


def candle_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CANDLES)


def flat_candles(spark, closes, volumes=None, interest=None, instrument_id=1, step=60):
    volumes = volumes or [100] * len(closes)
    interest = interest or [10] * len(closes)
    return candle_frame(
        spark,
        [
            (START + timedelta(seconds=step * i), instrument_id, c, c, c, float(c), v, o)
            for i, (c, v, o) in enumerate(zip(map(float, closes), volumes, interest))
        ],
    )


def random_candles(seed: int, sizes: dict[int, int], gappy: bool = True) -> list[tuple]:
    """Random walks; with ``gappy`` the time steps are very uneven, with bursts and long pauses."""
    draw = random.Random(seed)
    rows = []
    for instrument, size in sizes.items():
        close, when = 100.0, START
        for _ in range(size):
            if gappy:
                when += timedelta(seconds=draw.choice([1, 1, 1, 2, 60, 86400]))
            else:
                when += timedelta(seconds=60)
            close = max(1.0, close + draw.choice([-2, -1, -0.5, 0, 0.5, 1, 2]))
            rows.append(
                (
                    when,
                    instrument,
                    close,
                    close + 1,
                    close - 1,
                    close,
                    draw.randint(0, 50),
                    draw.choice([None, 0, draw.randint(1, 9)]),
                )
            )
    return rows


def prefix_indicators(closes: list[float], volumes: list[float]) -> dict[str, float | None]:
    """The five indicators at the last of the given candles, by plain loops."""
    n = len(closes)
    steps = [0.0] + [closes[i] - closes[i - 1] for i in range(1, n)]
    obv = sum(
        (volumes[i] if steps[i] > 0 else -volumes[i] if steps[i] < 0 else 0) for i in range(1, n)
    )
    rsi = None
    if n >= 14:
        gain = sum(max(s, 0) for s in steps[-14:]) / 14
        loss = sum(max(-s, 0) for s in steps[-14:]) / 14
        if loss > 0:
            rsi = 100 - 100 / (1 + gain / loss)
        elif gain > 0:
            rsi = 100.0
    tvi, total = None, 0.0
    for i in range(9, n):
        mean = sum(closes[i - 9 : i + 1]) / 10
        volume = sum(volumes[i - 9 : i + 1]) / 10
        tvi = None
        if volume:
            total += (closes[i] - mean) * volumes[i] / volume
            tvi = total
    pvi = 100.0
    for i in range(1, n):
        if volumes[i] > volumes[i - 1] and closes[i - 1]:
            pvi *= closes[i] / closes[i - 1]
    pvt, total = None, 0.0
    for i in range(1, n):
        pvt = None
        if closes[i - 1]:
            total += steps[i] / closes[i - 1] * volumes[i]
            pvt = total
    return {"obv": float(obv), "rsi": rsi, "tvi": tvi, "pvi": pvi, "pvt": pvt}


def close_enough(a, b) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def assert_same_rows(left: DataFrame, right: DataFrame, key: list[str]) -> None:
    """Equal columns and rows, doubles up to rounding."""
    assert left.columns == right.columns
    a = {tuple(r[k] for k in key): r for r in left.collect()}
    b = {tuple(r[k] for k in key): r for r in right.collect()}
    assert left.count() == len(a), "key is not unique"
    assert a.keys() == b.keys()
    for k, row in a.items():
        for name in left.columns:
            assert close_enough(row[name], b[k][name]), (k, name, row[name], b[k][name])
