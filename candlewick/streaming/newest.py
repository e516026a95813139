"""The newest candles of each instrument held as stream state, and their indicators.

:func:`~candlewick.streaming.live.refresh_indicators` reads an instrument's newest days back from the
candle table in every batch. Here the stream itself holds them: per instrument a ring of the newest
candles, whatever the cut into batches, so a batch costs what its own ticks cost. The ring is all that
is kept of an instrument. A tick replaces the candle of its time when it arrived later than that one did;
one older than a full ring changes nothing, as newer ones never make room for it.

Only candles of the stream count: where imported or corrected candles of the table must count too, use
``refresh_indicators``. With ``idle`` an instrument without ticks for so long is forgotten and starts anew.
The ticks that an instrument has in one batch are looked at by one task, an Arrow batch at a time;
bound the batches where one instrument dominates.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from candlewick.functions.numbers import micros
from candlewick.operators.indicators import LATEST_ROWS, latest_indicators
from candlewick.schemas import CANDLES
from candlewick.sources.store import Store

# State functions travel by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VALUES = ("open", "high", "low", "close", "volume", "open_interest")
# Values stay one text in Python, which has no whole numbers with nulls beside them.
_OUTPUT = "instrument_id bigint, at bigint, candle string"
_STATE = "ring string"


def _renewed(ring: list[list], ticks: pd.DataFrame, rows: int) -> list[list]:
    """The newest ``rows`` of [at, seq, candle] in the order of time, the latest arrival of each time."""
    held = pd.DataFrame(ring, columns=["at", "seq", "candle"])
    both = pd.concat([held, ticks[["at", "seq", "candle"]]]) if ring else ticks[["at", "seq", "candle"]]
    newest = both.sort_values(["at", "seq"], kind="stable").drop_duplicates("at", keep="last").tail(rows)
    return [[int(at), int(seq), candle] for at, seq, candle in newest.itertuples(index=False)]


def _step(rows: int, idle: int | None) -> Callable:
    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = json.loads(state.get[0]) if state.exists else []
        ring = before
        for ticks in parts:
            if len(ticks):
                ring = _renewed(ring, ticks, rows)
        if idle is not None:
            state.setTimeoutDuration(idle)
        state.update((json.dumps(ring),))
        if ring != before:
            out = pd.DataFrame(ring, columns=["at", "seq", "candle"])
            yield out.assign(instrument_id=key[0])[["instrument_id", "at", "candle"]]

    return step


def newest_candle_stream(ticks: DataFrame, rows: int = LATEST_ROWS, idle: int | None = None) -> DataFrame:
    """For each instrument whose newest ``rows`` candles a batch changes, all of these.

    ``ticks`` are candles with their arrival order ``seq``, which is unique. ``idle`` is in milliseconds.
    """
    if rows < 1:
        raise ValueError("rows must be positive")
    timeout = GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.ProcessingTimeTimeout
    packed = ticks.select(
        "instrument_id", micros(F.col("time")).alias("at"), "seq", F.to_json(F.struct(*_VALUES)).alias("candle")
    )
    rings = packed.groupBy("instrument_id").applyInPandasWithState(
        _step(rows, idle), _OUTPUT, _STATE, "append", timeout
    )
    types = {f.name: f.dataType.simpleString() for f in CANDLES}
    values = F.from_json("candle", ", ".join(f"{name} {types[name]}" for name in _VALUES))
    return rings.select(
        F.timestamp_micros("at").cast("timestamp_ntz").alias("time"), "instrument_id", values.alias("_v")
    ).select("time", "instrument_id", *[f"_v.{name}" for name in _VALUES])


def store_newest_indicators(store: Store, timeframe: str = "1min") -> Callable[[DataFrame, int], None]:
    """Upsert the indicators at the newest candle of each instrument that a batch of
    :func:`newest_candle_stream` brings; a repeated batch writes the same rows."""

    def handle(batch: DataFrame, _: int) -> None:
        store.upsert_indicators(latest_indicators(batch, timeframe))

    return handle
