"""Row versions by key: what an upsert or an insert-ignore leaves in a table.

The winner of a key is picked by an aggregate that merges partial results, so a key
with very many copies is reduced before the shuffle instead of meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CANDLE_KEY = ("time", "instrument_id")
INDICATOR_KEY = ("time", "instrument_id", "timeframe")
SIGNAL_KEY = ("instrument_id", "time", "signal_type")


def _pick(df: DataFrame, key: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [name for name in df.columns if name not in key]
    if len(order) == 1 and order[0] in rest:
        # Column by column the buffers stay plain values, which Spark keeps in hash maps.
        chosen = df.groupBy(*key).agg(*[pick(name, order[0]).alias(name) for name in rest])
        return chosen.select(*df.columns)
    chosen = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*[c if c in key else f"_row.{c}" for c in df.columns])


def last_version(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each key the row that is greatest by ``order`` (unique within the key, not null)."""
    return _pick(df, key, order, F.max_by)


def first_version(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each key the row that is least by ``order`` (unique within the key, not null)."""
    return _pick(df, key, order, F.min_by)


def upserted(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``target`` after the batch is written over it, the last row of a key winning."""
    incoming = last_version(batch, key, order).select(*target.columns)
    return target.join(incoming.select(*key), list(key), "left_anti").unionByName(incoming)


def inserted(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows an insert-ignore adds to ``target``: the first of each key not there yet."""
    incoming = first_version(batch, key, order).select(*target.columns)
    return incoming.join(target.select(*key), list(key), "left_anti")
