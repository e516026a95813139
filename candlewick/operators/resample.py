"""Ticks to fixed-interval candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numbers import floor_time
from candlewick.operators.series import Running, open_series

# Interval lengths of the two candle tables.
SECONDS = {"15sec": 15, "1min": 60}

CANDLE_VALUES = ("open", "high", "low", "close", "volume", "open_interest")


def candle_columns(order: Column) -> dict[str, Column]:
    """Candle aggregates over ticks; high and low range over the closes.

    Every one of them merges from partial results, so a crowded interval is reduced
    before it is shuffled.
    """
    return {
        "open": F.min_by("open", order),
        "high": F.max("close"),
        "low": F.min("close"),
        "close": F.max_by("close", order),
        "volume": F.sum("volume"),
        "open_interest": F.max_by("open_interest", order),
    }


def candles(
    ticks: DataFrame, seconds: int, by: Sequence[str] = ("instrument_id",), seq: str = "seq"
) -> DataFrame:
    """Candles by event time: a tick belongs to the interval that contains it.

    The first and the last tick of an interval are told by ``seq``, the arrival order.
    A whole number keeps the aggregation in hash maps; a struct would make Spark sort.
    """
    return (
        ticks.groupBy(*by, floor_time(F.col("time"), seconds).alias("_start"))
        .agg(*[column.alias(name) for name, column in candle_columns(F.col(seq)).items()])
        .withColumnRenamed("_start", "time")
    )


def _partial_groups(
    ticks: DataFrame,
    seconds: int,
    by: str,
    seq: str,
    standing: DataFrame | None,
    rows_per_slice: int | None,
) -> DataFrame:
    """One row per run of ticks that end up in the same candle.

    All ticks between two closings share the highest interval seen before them, ``_open``.
    """
    bucketed = ticks.withColumn("_bucket", floor_time(F.col("time"), seconds))
    series = open_series(bucketed, by, seq, counted=ticks, rows_per_slice=rows_per_slice)
    frame = series.close(
        series.running(series.frame, _seen=Running("max", F.col("_bucket"), before_row=True))
    )
    seen = [F.col("_seen"), F.col("_bucket")]
    if standing is not None:
        frame = frame.join(standing.select(by, F.col("_open").alias("_stood")), by, "left")
        seen = [F.greatest("_seen", "_stood"), F.col("_bucket")]
    return (
        frame.withColumn("_open", F.coalesce(*seen))
        .groupBy(by, "_open")
        .agg(
            F.max("_bucket").alias("_top"),
            F.min(seq).alias("_first"),
            F.max(seq).alias("_last"),
            *[column.alias(name) for name, column in candle_columns(F.col(seq)).items()],
        )
    )


def _closed(groups: DataFrame, by: str) -> DataFrame:
    return groups.where(F.col("_top") > F.col("_open")).select(
        by, F.col("_top").alias("time"), *CANDLE_VALUES
    )


def arrival_candles(
    ticks: DataFrame,
    seconds: int = 15,
    by: str = "symbol",
    seq: str = "seq",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Candles by arrival order, closed by the first tick of a later interval.

    The closing tick still counts into the candle it closes, which is labelled with the
    interval of that tick; late ticks count into whatever is open, and an interval that
    nothing closes yields no candle.
    """
    return _closed(_partial_groups(ticks, seconds, by, seq, None, rows_per_slice), by)


def arrival_step(
    ticks: DataFrame,
    standing: DataFrame | None,
    seconds: int = 15,
    by: str = "symbol",
    seq: str = "seq",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Candle groups after ``ticks`` arrive on top of ``standing``, the open candles so far.

    Feed the result to :func:`closed_candles` and :func:`open_candles`; both read it, so
    materialise it first.
    """
    groups = _partial_groups(ticks, seconds, by, seq, standing, rows_per_slice)
    if standing is None:
        return groups
    return (
        groups.unionByName(standing)
        .groupBy(by, "_open")
        .agg(
            F.max("_top").alias("_top"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
            F.min_by("open", "_first").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_last").alias("close"),
            F.sum("volume").alias("volume"),
            F.max_by("open_interest", "_last").alias("open_interest"),
        )
    )


def closed_candles(groups: DataFrame, by: str = "symbol") -> DataFrame:
    return _closed(groups, by)


def open_candles(groups: DataFrame, by: str = "symbol") -> DataFrame:
    """One row per symbol: its open candle, or an empty one right after a closing."""
    values = [name for name in groups.columns if name not in (by, "_open")]
    newest = groups.groupBy(by).agg(
        F.max_by(F.struct("_open", *values), "_open").alias("_row")
    ).select(by, "_row.*")
    shut = F.col("_top") > F.col("_open")
    kinds = dict(groups.dtypes)
    return newest.select(
        by,
        F.when(shut, F.col("_top")).otherwise(F.col("_open")).alias("_open"),
        "_top",
        *[
            F.when(~shut, F.col(name)).cast(kinds[name]).alias(name)
            for name in values
            if name != "_top"
        ],
    )
