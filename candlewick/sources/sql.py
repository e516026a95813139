"""The query functions for SQL users, over the views of a store.

Spark inlines these functions, so a symbol filters the scans and a row limit becomes a
top-n. SQL takes no parameter as a frame bound, so the moving average joins row n of running totals
with row n - p_window. Views hold no result of a job: making them anew after a write lists files only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.indicators import price_totals
from candlewick.operators.signals import OUTPUT, scalping_signals
from candlewick.schemas import TIMEFRAMES
from candlewick.sources.store import Store

SCALPING = (
    "time TIMESTAMP_NTZ, symbol STRING, instrument_type STRING, option_type STRING, "
    "strike_price DECIMAL(18,4), open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT, "
    "open_interest BIGINT, tvi DOUBLE, obv DOUBLE, rsi DOUBLE, pvi DOUBLE, pvt DOUBLE"
)
SIGNAL = (
    "time TIMESTAMP_NTZ, symbol STRING, signal_type STRING, close DOUBLE, rsi DOUBLE, obv DOUBLE, "
    "tvi DOUBLE, volume BIGINT, ma5 DOUBLE, ma20 DOUBLE, avg_vol20 DOUBLE"
)


def _newest(columns: str, view: str, where: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (ORDER BY time DESC, symbol) AS place "
        f"FROM {view} WHERE {where}) WHERE place <= p_limit"
    )


def register_functions(store: Store) -> None:
    """Register the views of ``store`` and four table functions over them.

    * ``get_latest_scalping_data(p_limit)``
    * ``get_instrument_scalping_data(p_symbol, p_limit)``
    * ``generate_scalping_signals_flexible(p_timeframe, p_symbol, p_limit)``
    * ``calculate_moving_average(p_instrument_id, p_timeframe, p_window)``
    """
    spark = store.spark
    store.register_views()

    def signals_view() -> None:
        signals = [
            scalping_signals(
                store.candles(timeframe), store.indicators(), store.instruments(), timeframe, limit=None, lazy=True
            ).withColumn("timeframe", F.lit(timeframe))
            for timeframe in TIMEFRAMES
        ]
        reduce(DataFrame.unionByName, signals).createOrReplaceTempView("scalping_signals")
        totals = [price_totals(store.candles(t)).withColumn("timeframe", F.lit(t)) for t in TIMEFRAMES]
        reduce(DataFrame.unionByName, totals).createOrReplaceTempView("price_totals")

    store.keep_views(signals_view)
    columns = ", ".join(part.split()[0] for part in SCALPING.replace("(18,4)", "").split(", "))
    functions = {
        f"get_latest_scalping_data(p_limit INT DEFAULT 100) RETURNS TABLE ({SCALPING})": _newest(
            columns, "scalping_data", "true"
        ),
        "get_instrument_scalping_data(p_symbol STRING, p_limit INT DEFAULT 100) "
        f"RETURNS TABLE ({SCALPING})": _newest(columns, "scalping_data", "symbol = p_symbol"),
        "generate_scalping_signals_flexible(p_timeframe STRING DEFAULT '1min', "
        "p_symbol STRING DEFAULT NULL, p_limit INT DEFAULT 100) "
        f"RETURNS TABLE ({SIGNAL})": _newest(
            ", ".join(OUTPUT),
            "scalping_signals",
            "timeframe = lower(p_timeframe) AND (p_symbol IS NULL OR symbol = p_symbol)",
        ),
    }
    functions[
        "calculate_moving_average(p_instrument_id BIGINT, p_timeframe STRING DEFAULT '1min', p_window INT DEFAULT 20) "
        "RETURNS TABLE (time TIMESTAMP_NTZ, ma DOUBLE)"
    ] = (
        "SELECT a.time, try_divide(CAST(a.total - coalesce(b.total, 0) AS DOUBLE), a.known - coalesce(b.known, 0)) AS ma "
        "FROM price_totals a LEFT JOIN price_totals b ON a.instrument_id = b.instrument_id "
        "AND a.timeframe = b.timeframe AND a.place = b.place + p_window "
        "WHERE a.instrument_id = p_instrument_id AND a.timeframe = lower(p_timeframe)"
    )
    for head, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
