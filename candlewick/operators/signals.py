"""Scalping signals from candles, indicators and short moving averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.indicators import latest_candles, partial_average
from candlewick.operators.joins import with_indicators
from candlewick.operators.series import Series, open_series

# RSI bands, the volume surge factor and the frame lengths.
OVERSOLD, OVERBOUGHT = 30, 70
VOLUME_SURGE = 1.5
FAST, SLOW = 5, 20

OUTPUT = (
    "time",
    "symbol",
    "signal_type",
    "close",
    "rsi",
    "obv",
    "tvi",
    "volume",
    "ma5",
    "ma20",
    "avg_vol20",
)


def rsi_band(rsi: Column) -> Column:
    return (
        F.when(rsi > OVERBOUGHT, "Overbought").when(rsi < OVERSOLD, "Oversold").otherwise("Neutral")
    )


def signal_type() -> Column:
    """The first rule that holds; a comparison with an undefined value never does."""
    close, rsi, obv = F.col("close"), F.col("rsi"), F.col("obv")
    surging = F.col("volume") > VOLUME_SURGE * F.col("avg_vol20")
    return (
        F.when(
            (rsi < OVERSOLD) & (obv > F.col("_obv0")) & (close > F.col("ma5")) & surging, "buy"
        )
        .when((rsi > OVERBOUGHT) & (obv < F.col("_obv0")) & (close < F.col("ma5")) & surging, "sell")
        .when((close > F.col("ma20")) & (rsi > F.col("_rsi0")), "trend_up")
        .when((close < F.col("ma20")) & (rsi < F.col("_rsi0")), "trend_down")
        .otherwise("hold")
    )


def scalping_signals(
    candles: DataFrame,
    indicators: DataFrame | None,
    instruments: DataFrame,
    timeframe: str = "1min",
    symbol: str | None = None,
    limit: int | None = 100,
    counted: DataFrame | None = None,
    rows_per_slice: int | None = None,
    lazy: bool = False,
) -> DataFrame:
    """Every candle with its signal, newest first and cut to ``limit`` unless that is None.

    ``candles`` are those of ``timeframe``. Windows always stay within one instrument and
    see all the rows they reach, whatever the limit. Candles that carry their indicators need no
    second table. ``lazy`` is that of :func:`open_series`.
    """
    chosen = instruments.select("instrument_id", "symbol")
    if symbol is not None:
        chosen = chosen.where(F.col("symbol") == symbol)
        # Filter both sides before the windows, so that only this instrument is ever shuffled.
        candles = candles.join(chosen.select("instrument_id"), "instrument_id", "left_semi")
        if indicators is not None:
            indicators = indicators.join(chosen.select("instrument_id"), "instrument_id", "left_semi")
    carried = () if indicators is not None else ("rsi", "obv", "tvi")
    candles = candles.select("time", "instrument_id", "close", "volume", *carried)
    if limit is not None:
        # No instrument has more than ``limit`` rows among the newest, and their frames
        # reach back by less than SLOW rows; the rest need not be joined or shuffled.
        candles = latest_candles(candles, limit + SLOW - 1).drop("recency")
    joined = with_indicators(candles, indicators, timeframe).select(
        "time", "instrument_id", "close", "volume", "rsi", "obv", "tvi"
    )
    if limit is not None:
        series = Series(joined, "instrument_id", "time", sliced=False)
    else:
        series = open_series(
            joined,
            before=SLOW - 1,
            counted=candles if counted is None else counted,
            rows_per_slice=rows_per_slice,
            lazy=lazy,
        )
    framed = series.close(
        series.frame.select(
            "*",
            F.lag("obv").over(series.window).alias("_obv0"),
            F.lag("rsi").over(series.window).alias("_rsi0"),
            partial_average(F.col("close"), series, FAST).alias("ma5"),
            partial_average(F.col("close"), series, SLOW).alias("ma20"),
            partial_average(F.col("volume"), series, SLOW).alias("avg_vol20"),
        )
    )
    signals = (
        framed.withColumn("signal_type", signal_type()).join(chosen, "instrument_id").select(*OUTPUT)
    )
    if limit is None:
        return signals
    return signals.orderBy(F.desc("time"), "symbol").limit(limit)


def of_type(signals: DataFrame, kind: str) -> DataFrame:
    return signals.where(F.col("signal_type") == kind)


def signal_counts(signals: DataFrame) -> DataFrame:
    return signals.groupBy("signal_type").agg(F.count(F.lit(1)).alias("signals"))


def signal_rows(signals: DataFrame, instruments: DataFrame, created_at: Column) -> DataFrame:
    """Signals in the layout of the trading_signals table; the figures go to ``extra`` as JSON."""
    return signals.join(instruments.select("symbol", "instrument_id"), "symbol").select(
        "time",
        "instrument_id",
        "signal_type",
        F.col("close").alias("signal_value"),
        F.to_json(F.struct("rsi", "obv", "tvi", "volume", "ma5", "ma20", "avg_vol20")).alias("extra"),
        created_at.cast("timestamp_ntz").alias("created_at"),
    )
