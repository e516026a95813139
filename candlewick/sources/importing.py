"""Historical files into the instrument and candle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators import merge
from candlewick.operators.joins import resolve_symbols
from candlewick.schemas import candle_table
from candlewick.sources.files import ROW_ORDER, parse_candles, read_candle_csv, whole_files
from candlewick.sources.store import Store


def import_candles(
    store: Store,
    path: str | list[str],
    timeframe: str = "1min",
    as_of: str | None = None,
    only_whole_files: bool = False,
) -> DataFrame:
    """Load candle files, creating unseen instruments and leaving stored candles alone.

    Unusable rows are left out, or with ``only_whole_files`` every file that has one.
    Returns the parsed rows, from which counts by file and the quarantine can be read.
    """
    parsed = parse_candles(read_candle_csv(store.spark, path))
    taken = whole_files(parsed) if only_whole_files else parsed
    usable = taken.where(F.col("reject_reason").isNull())
    store.create_instruments(usable, as_of)
    candles = resolve_symbols(usable, store.instruments())
    store.insert_ignore(candle_table(timeframe), candles, merge.CANDLE_KEY, ROW_ORDER)
    return parsed
