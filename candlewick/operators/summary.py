"""The market summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numbers import finite
from candlewick.operators.filters import recent
from candlewick.operators.joins import of_timeframe, with_instruments
from candlewick.operators.series import open_series
from candlewick.operators.signals import rsi_band

# Prices that fit are compared as decimals, so that halves are rounded exactly.
PRICE = "decimal(18,6)"


def change_percent(price: Column, other: Column) -> Column:
    """Change from ``other`` to ``price`` in per cent, two decimals; null from a price of zero."""
    exact, base = price.try_cast(PRICE), other.try_cast(PRICE)
    fits = (exact.cast("double") == price) & (base.cast("double") == other)
    decimal = F.round(F.try_divide(exact - base, base) * 100, 2).cast("double")
    return F.when(fits, decimal).otherwise(F.round(F.try_divide(price - other, other) * 100, 2))


def market_summary(
    candles: DataFrame,
    indicators: DataFrame | None,
    instruments: DataFrame,
    as_of: str | datetime | None = None,
    all_data: bool = False,
    direction: str = "next",
    counted: DataFrame | None = None,
    rows_per_slice: int | None = None,
    lazy: bool = False,
) -> DataFrame:
    """Every candle of the last 30 minutes (or of all time) with its change and RSI band.

    The price is compared with the following candle, so each instrument's newest
    candle has nothing to compare with and is left out; ``direction='previous'``
    compares with the preceding one instead. Candles that carry their indicators need no second
    table. ``lazy`` is that of :func:`open_series`.
    """
    if direction not in ("next", "previous"):
        raise ValueError("direction must be 'next' or 'previous'")
    shown_readings = ("rsi", "tvi", "obv")
    carried = shown_readings if indicators is None else ()
    prices = candles.select("time", "instrument_id", "close", "volume", "open_interest", *carried)
    if not all_data:
        prices = recent(prices, as_of)
    ahead = direction == "next"
    series = open_series(
        prices,
        before=int(not ahead),
        after=int(ahead),
        counted=counted,
        rows_per_slice=rows_per_slice,
        lazy=lazy,
    )
    step = F.lead if ahead else F.lag
    compared = series.close(
        series.frame.withColumn("_other", step("close").over(series.window))
    ).where(F.col("_other").isNotNull())
    if indicators is not None:
        readings = of_timeframe(indicators, "1min").select("time", "instrument_id", *shown_readings)
        readings = readings if all_data else recent(readings, as_of)
        compared = compared.join(readings, ["time", "instrument_id"], "left")
    shown = ("symbol", "instrument_type", "option_type", "strike_price")
    # Symbols are unique, so joining on the id equals joining on the symbol.
    return with_instruments(
        compared, instruments, *shown
    ).select(
        *shown,
        F.col("close").alias("latest_price"),
        F.col("time").alias("latest_time"),
        change_percent(F.col("close"), F.col("_other")).alias("price_change_pct"),
        "volume",
        "open_interest",
        "rsi",
        "tvi",
        "obv",
        rsi_band(F.col("rsi")).alias("rsi_signal"),
    )


def exportable(summary: DataFrame) -> DataFrame:
    """Summary rows with every value present and finite."""
    doubles = [name for name, kind in summary.dtypes if kind == "double"]
    return summary.withColumns({name: finite(F.col(name)) for name in doubles}).dropna()
