"""Joins of candles with their instruments and indicators.

No join is hinted: Spark broadcasts the instruments when their size allows it and
otherwise shuffles, where adaptive execution splits the partitions of a hot instrument.
Candles and indicators meet on (time, instrument_id), which is unique and spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.schemas import INDICATOR_COLUMNS


PRICES = ("open", "high", "low", "close", "volume", "open_interest")


def of_timeframe(indicators: DataFrame, timeframe: str) -> DataFrame:
    return indicators.where(F.col("timeframe") == timeframe).select(
        "time", "instrument_id", *INDICATOR_COLUMNS
    )


def with_instruments(facts: DataFrame, instruments: DataFrame, *columns: str) -> DataFrame:
    """Inner join adding the named instrument columns."""
    return facts.join(instruments.select("instrument_id", *columns), "instrument_id")


def with_indicators(
    candles: DataFrame, indicators: DataFrame | None, timeframe: str, how: str = "left"
) -> DataFrame:
    """Candles with their indicators; without a table of them the candles carry their own."""
    if indicators is None:
        return candles
    return candles.join(of_timeframe(indicators, timeframe), ["time", "instrument_id"], how)


def with_readings_of(picked: DataFrame, indicators: DataFrame, timeframe: str) -> DataFrame:
    """Left join of indicators to a few ``picked`` candles, as left by a row limit.

    Only the indicators of the picked keys take part. Spark broadcasts the keys when their
    measured size allows it.
    """
    keys = picked.select("time", "instrument_id")
    readings = of_timeframe(indicators, timeframe).join(keys, ["time", "instrument_id"], "left_semi")
    return picked.join(readings, ["time", "instrument_id"], "left")


def enriched_candles(
    candles: DataFrame,
    instruments: DataFrame,
    indicators: DataFrame | None = None,
    timeframe: str = "1min",
) -> DataFrame:
    """Candles with instrument attributes and the indicators of ``timeframe``, when a table of them is
    given or the candles carry their own."""
    shown = ("symbol", "instrument_type", "option_type", "strike_price")
    frame = with_instruments(candles, instruments, *shown)
    columns = ["time", *shown, *PRICES]
    if indicators is not None:
        frame = with_indicators(frame, indicators, timeframe)
    if set(INDICATOR_COLUMNS) <= set(frame.columns):
        columns += INDICATOR_COLUMNS
    return frame.select(*columns)


def latest(
    candles: DataFrame,
    instruments: DataFrame,
    indicators: DataFrame,
    timeframe: str = "1min",
    limit: int = 100,
    symbol: str | None = None,
) -> DataFrame:
    """The newest rows of :func:`enriched_candles`, of one symbol when it is given.

    Equal times go by symbol. The rows are picked before the indicators join, which
    keeps their number, so that only their own indicators are ever looked up.
    """
    if symbol is not None:
        instruments = instruments.where(F.col("symbol") == symbol)
        indicators = indicators.join(instruments.select("instrument_id"), "instrument_id", "left_semi")
    shown = ("symbol", "instrument_type", "option_type", "strike_price")
    picked = (
        with_instruments(candles, instruments, *shown).orderBy(F.desc("time"), "symbol").limit(limit)
    )
    return (
        with_readings_of(picked, indicators, timeframe)
        .select("time", *shown, *PRICES, *INDICATOR_COLUMNS)
        .orderBy(F.desc("time"), "symbol")
    )


def resolve_symbols(ticks: DataFrame, instruments: DataFrame) -> DataFrame:
    """Ticks with their instrument_id; ticks of unknown symbols are left out."""
    return ticks.join(instruments.select("symbol", "instrument_id"), "symbol")


def unknown_symbols(ticks: DataFrame, instruments: DataFrame) -> DataFrame:
    """The ticks that :func:`resolve_symbols` leaves out."""
    return ticks.join(instruments.select("symbol"), "symbol", "left_anti")
