"""Time filters on candles and indicators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The first and the last hour of the opening session.
SESSION_HOURS = (9, 10)


def clock(as_of: str | datetime | None = None) -> Column:
    """``as_of`` as a zone-less timestamp, the current time when it is not given."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of))
    return now.cast("timestamp_ntz")


def in_session(time: Column) -> Column:
    return F.hour(time).between(*SESSION_HOURS)


def first_two_hours(candles: DataFrame) -> DataFrame:
    return candles.where(in_session(F.col("time")))


def recent(df: DataFrame, as_of: str | datetime | None = None, minutes: int = 30) -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of``."""
    return df.where(F.col("time") >= clock(as_of) - F.make_dt_interval(mins=F.lit(minutes)))


def retained(df: DataFrame, as_of: str | datetime | None = None, days: int = 7) -> DataFrame:
    """Rows that a retention of ``days`` keeps."""
    return df.where(F.col("time") >= clock(as_of) - F.make_dt_interval(F.lit(days)))


def candle_range(
    candles: DataFrame,
    instrument_id: int,
    start: str | date | datetime,
    end: str | date | datetime,
) -> DataFrame:
    """One instrument's candles between two times, both included, in time order.

    A bare date means its midnight, also as the end.
    """
    low, high = (F.lit(str(bound)).cast("timestamp_ntz") for bound in (start, end))
    return candles.where(
        (F.col("instrument_id") == instrument_id) & F.col("time").between(low, high)
    ).orderBy("time")
