"""Technical indicators as window plans over all instruments at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.series import Running, Series, open_series
from candlewick.schemas import INDICATOR_COLUMNS, INDICATORS

# Frame lengths and the PVI starting level.
RSI_PERIOD = 14
TVI_PERIOD = 10
PVI_START = 100.0
LATEST_ROWS = 100


def full_average(value: Column, series: Series, rows: int) -> Column:
    """Mean of the last ``rows`` rows, null until there are that many values."""
    frame = series.rows(1 - rows, 0)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def partial_average(value: Column, series: Series, rows: int) -> Column:
    """Mean of the last ``rows`` rows, over fewer at the start of the series."""
    return F.avg(value).over(series.rows(1 - rows, 0))


def _with_indicators(series: Series) -> DataFrame:
    close, volume = F.col("close"), F.col("volume").cast("double")
    stepped = series.frame.select(
        "*",
        (close - F.lag("close").over(series.window)).alias("_step"),
        F.lag("close").over(series.window).alias("_close0"),
        F.lag("volume").over(series.window).alias("_volume0"),
        full_average(close, series, TVI_PERIOD).alias("_close_avg"),
        full_average(volume, series, TVI_PERIOD).alias("_volume_avg"),
    )
    step = F.coalesce("_step", F.lit(0.0))
    framed = stepped.select(
        "*",
        full_average(F.greatest(step, F.lit(0.0)), series, RSI_PERIOD).alias("_gain"),
        full_average(F.greatest(-step, F.lit(0.0)), series, RSI_PERIOD).alias("_loss"),
        (F.signum("_step") * volume).alias("_obv_term"),
        F.try_divide((close - F.col("_close_avg")) * volume, F.col("_volume_avg")).alias("_tvi_term"),
        (F.try_divide("_step", "_close0") * volume).alias("_pvt_term"),
        F.when(
            F.col("volume") > F.col("_volume0"),
            F.coalesce(F.try_divide(close, F.col("_close0")), F.lit(1.0)),
        )
        .otherwise(1.0)
        .alias("_pvi_factor"),
    )
    totalled = series.running(
        framed,
        _obv=Running("sum", F.coalesce("_obv_term", F.lit(0.0))),
        _tvi=Running("sum", F.col("_tvi_term")),
        _pvt=Running("sum", F.col("_pvt_term")),
        _pvi=Running("product", F.col("_pvi_factor")),
    )
    strength = F.when(
        F.col("_loss") > 0, 100.0 - 100.0 / (1.0 + F.try_divide("_gain", "_loss"))
    ).when(F.col("_gain") > 0, 100.0)
    return series.close(
        totalled.withColumns(
            {
                "obv": F.col("_obv"),
                "rsi": strength,
                "tvi": F.when(F.col("_tvi_term").isNotNull(), F.col("_tvi")),
                "pvi": PVI_START * F.col("_pvi"),
                "pvt": F.when(F.col("_pvt_term").isNotNull(), F.col("_pvt")),
            }
        )
    )


def indicators(
    candles: DataFrame,
    timeframe: str = "1min",
    counted: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """OBV, RSI, TVI, PVI and PVT at every candle, each over the candle's whole past.

    * obv: running volume signed by the direction of the close, 0 at the first candle
    * rsi: 14-candle simple means of gains and losses; the first step counts as none;
      100 with gains only, null without any movement
    * tvi: running (close - mean10) * volume / mean10(volume); null where undefined
    * pvi: starts at 100 and follows the close only where volume rises
    * pvt: running relative close change times volume; null where undefined

    ``counted`` and ``rows_per_slice`` are those of :func:`open_series`.
    """
    needed = candles.select("instrument_id", "time", "close", "volume")
    return _labelled(candles_with_indicators(needed, counted, rows_per_slice), timeframe)


def candles_with_indicators(
    candles: DataFrame, counted: DataFrame | None = None, rows_per_slice: int | None = None
) -> DataFrame:
    """Candles, all their columns, with the indicators of :func:`indicators` beside them.

    One window plan gives both, where a join with the indicators of the same candles makes these twice.
    """
    series = open_series(candles, before=RSI_PERIOD, counted=counted, rows_per_slice=rows_per_slice)
    return _with_indicators(series).select(*candles.columns, *INDICATOR_COLUMNS)


def latest_candles(candles: DataFrame, rows: int = LATEST_ROWS) -> DataFrame:
    """The newest ``rows`` candles of every instrument."""
    newest = Window.partitionBy("instrument_id").orderBy(F.desc("time"))
    return candles.withColumn("recency", F.row_number().over(newest)).where(
        F.col("recency") <= rows
    )


def latest_indicators(
    candles: DataFrame, timeframe: str = "1min", rows: int = LATEST_ROWS
) -> DataFrame:
    """The indicators at each instrument's newest candle, from its newest ``rows`` candles only."""
    newest = latest_candles(
        candles.select("instrument_id", "time", "close", "volume"), rows
    )
    # At most ``rows`` rows per instrument are left, so no instrument can be too large.
    series = Series(newest, "instrument_id", "time", sliced=False)
    return _labelled(_with_indicators(series).where(F.col("recency") == 1), timeframe)


def moving_average(
    candles: DataFrame,
    window: int,
    instrument_id: int | None = None,
    counted: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """(instrument_id, time, ma) over the last ``window`` closes, fewer at the start."""
    if window < 1:
        raise ValueError("window must be at least 1")
    needed = candles.select("instrument_id", "time", "close")
    if instrument_id is not None:
        needed = needed.where(F.col("instrument_id") == instrument_id)
    series = open_series(
        needed, before=window - 1, counted=counted, rows_per_slice=rows_per_slice
    )
    return series.close(
        series.frame.withColumn("ma", partial_average(F.col("close"), series, window))
    ).select("instrument_id", "time", "ma")


def price_totals(candles: DataFrame) -> DataFrame:
    """(instrument_id, time, place, known, total): the number of each candle of its instrument, and the
    closes up to it, counted and summed.

    Days are summed apart and carried forward, so no task sees a whole history. Sums are decimals of
    ten places and so the same in any order; a close that does not fit counts as unknown.
    """
    price = F.col("close").try_cast("decimal(28,10)")
    rows = candles.select("instrument_id", "time", F.to_date("time").alias("date"), price.alias("_price"))
    today = Window.partitionBy("instrument_id", "date").orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("instrument_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"place": F.count(F.lit(1)), "known": F.count("_price"), "total": F.coalesce(F.sum("_price"), F.lit(0).cast("decimal(38,10)"))}
    days = rows.groupBy("instrument_id", "date").agg(*[column.alias(name) for name, column in sums.items()])
    carried = days.select(
        "instrument_id", "date", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}") for name in sums]
    )
    own = {"place": F.count(F.lit(1)).over(today), "known": F.count("_price").over(today), "total": F.sum("_price").over(today)}
    local = rows.select("instrument_id", "time", "date", *[column.alias(name) for name, column in own.items()])
    return local.join(carried, ["instrument_id", "date"]).select(
        "instrument_id", "time",
        *[(F.coalesce(name, F.lit(0)) + F.col(f"_{name}")).cast("bigint" if name != "total" else "decimal(38,10)").alias(name) for name in sums],
    )


def moving_average_by_place(totals: DataFrame, window: int) -> DataFrame:
    """(instrument_id, time, ma) from :func:`price_totals`: row n less row n - window.

    Unlike a frame, the window may be any expression, as in a SQL function with a parameter.
    """
    before = totals.select(
        "instrument_id", (F.col("place") + F.lit(window)).alias("place"), F.col("known").alias("_known"), F.col("total").alias("_total")
    )
    joined = totals.join(before, ["instrument_id", "place"], "left")
    total = (F.col("total") - F.coalesce("_total", F.lit(0))).cast("double")
    return joined.select(
        "instrument_id", "time", F.try_divide(total, F.col("known") - F.coalesce("_known", F.lit(0))).alias("ma")
    )


def _labelled(frame: DataFrame, timeframe: str) -> DataFrame:
    return frame.withColumn("timeframe", F.lit(timeframe)).select(*INDICATORS.names)
