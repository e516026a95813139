"""Canonical table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMEFRAMES = ("1min", "15sec")

STRIKE = T.DecimalType(18, 4)

INSTRUMENTS = T.StructType(
    [
        T.StructField("instrument_id", T.LongType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("instrument_type", T.StringType()),
        T.StructField("option_type", T.StringType()),
        T.StructField("strike_price", STRIKE),
        T.StructField("expiry_date", T.DateType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

CANDLES = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType(), False),
        T.StructField("instrument_id", T.LongType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("open_interest", T.LongType()),
    ]
)

INDICATOR_COLUMNS = ("tvi", "obv", "rsi", "pvi", "pvt")

INDICATORS = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType(), False),
        T.StructField("instrument_id", T.LongType(), False),
        T.StructField("timeframe", T.StringType(), False),
        *[T.StructField(name, T.DoubleType()) for name in INDICATOR_COLUMNS],
    ]
)

SIGNALS = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType(), False),
        T.StructField("instrument_id", T.LongType(), False),
        T.StructField("signal_type", T.StringType(), False),
        T.StructField("signal_value", T.DoubleType()),
        T.StructField("extra", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# Raw ticks as they arrive: ``seq`` is the arrival order (an offset or a sequence number).
TICK_ENVELOPE = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("channel", T.StringType(), False),
        T.StructField("data", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType(), False),
    ]
)

TABLES = {
    "instruments": INSTRUMENTS,
    "candle_data_1min": CANDLES,
    "candle_data_15sec": CANDLES,
    "technical_indicators": INDICATORS,
    "trading_signals": SIGNALS,
}


def candle_table(timeframe: str) -> str:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"timeframe must be one of {TIMEFRAMES}, got {timeframe!r}")
    return f"candle_data_{timeframe}"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name; columns it lacks become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
