"""The instrument dimension: look-ups, preference order, ids and upserts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.symbols import (
    contract_fields,
    in_segment,
    index_rank,
    ticker_fields,
    underlying,
)
from candlewick.operators.filters import clock
from candlewick.operators.joins import of_timeframe
from candlewick.schemas import INSTRUMENTS, conform

# Fixed value: tickers collected when the feed states no limit of its own.
DEFAULT_SYMBOLS = 50

ATTRIBUTES = ("instrument_type", "option_type", "strike_price", "expiry_date")


def first_instrument(instruments: DataFrame) -> DataFrame:
    return instruments.select("instrument_id", "symbol").orderBy("instrument_id").limit(1)


def preferred_instrument(instruments: DataFrame) -> DataFrame:
    """The best index name (NIFTY, BANKNIFTY, other NIFTY names), else any instrument."""
    return (
        instruments.select("instrument_id", "symbol")
        .orderBy(index_rank(F.col("symbol")), "instrument_id")
        .limit(1)
    )


def with_data(
    instruments: DataFrame, candles: DataFrame, indicators: DataFrame, timeframe: str = "1min"
) -> DataFrame:
    """Instruments that have both candles and indicators.

    The ids are made distinct first, which Spark does ahead of the shuffle, so a crowded
    instrument reaches the join as a handful of rows.
    """
    priced = candles.select("instrument_id").distinct()
    measured = of_timeframe(indicators, timeframe).select("instrument_id").distinct()
    return instruments.join(priced, "instrument_id", "left_semi").join(
        measured, "instrument_id", "left_semi"
    )


def best_instrument(
    instruments: DataFrame, candles: DataFrame, indicators: DataFrame, timeframe: str = "1min"
) -> DataFrame:
    return preferred_instrument(with_data(instruments, candles, indicators, timeframe))


def underlyings(instruments: DataFrame) -> DataFrame:
    """Distinct underlyings with NIFTY and BANKNIFTY first, then by name."""
    name = F.col("underlying")
    return (
        instruments.select(underlying(F.col("symbol")).alias("underlying"))
        .where(name.isNotNull())
        .distinct()
        .orderBy(F.when(name == "NIFTY", 0).when(name == "BANKNIFTY", 1).otherwise(2), name)
    )


def expiries(instruments: DataFrame, prefix: str) -> DataFrame:
    return (
        instruments.where(F.col("symbol").startswith(prefix))
        .select("expiry_date")
        .dropna()
        .distinct()
        .orderBy("expiry_date")
    )


def strikes(instruments: DataFrame, prefix: str, expiry: date) -> DataFrame:
    return (
        instruments.where(F.col("symbol").startswith(prefix) & (F.col("expiry_date") == F.lit(expiry)))
        .select("strike_price")
        .dropna()
        .distinct()
        .orderBy("strike_price")
    )


def contract_catalog(instruments: DataFrame) -> DataFrame:
    """Distinct (underlying, expiry_date, strike_price, option_type) over all contracts."""
    return (
        instruments.select(underlying(F.col("symbol")).alias("underlying"), *ATTRIBUTES[1:])
        .where(F.col("underlying").isNotNull() & F.col("expiry_date").isNotNull())
        .distinct()
    )


def contract_slice(
    instruments: DataFrame, prefix: str, expiry: date, strike: float, option_type: str
) -> DataFrame:
    return instruments.where(
        F.col("symbol").startswith(prefix)
        & (F.col("expiry_date") == F.lit(expiry))
        & (F.col("strike_price") == strike)
        & (F.col("option_type") == option_type)
    )


def relevant_tickers(
    tickers: DataFrame, order: list[str], limit: int = DEFAULT_SYMBOLS
) -> DataFrame:
    """The first ``limit`` tickers of the collected segments, by ``order``."""
    return tickers.where(in_segment(F.col("ticker"))).orderBy(*order).limit(limit)


def option_chain(requests: DataFrame, step: int = 50) -> DataFrame:
    """Requests (symbol, expiry, low, high) expanded to one row per strike and option type."""
    strike = F.col("strike")
    return (
        requests.where(F.col("low") <= F.col("high"))
        .withColumn("strike", F.explode(F.sequence("low", "high", F.lit(step).cast("bigint"))))
        .withColumn("option_type", F.explode(F.array(F.lit("CE"), F.lit("PE"))))
        .select(
            "symbol",
            "expiry",
            "strike",
            "option_type",
            F.concat("symbol", "expiry", strike.cast("string"), "option_type").alias("contract"),
        )
    )


def number_rows(df: DataFrame, digest: Column) -> DataFrame:
    """Add ``position``: 1, 2, ... in the order of ``digest``, a unique hex digest.

    Digests spread evenly over their leading digits, so the rows are ranked within 4096
    groups and shifted by the sizes of the groups before; no task sees them all.
    """
    digested = df.withColumn("_digest", digest).withColumn("_group", F.substring("_digest", 1, 3))
    sizes = digested.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    # 4096 rows at most, whatever the data.
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_group", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift")
    )
    ranked = digested.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_group").orderBy("_digest"))
    )
    return (
        ranked.join(F.broadcast(shifts), "_group")
        .withColumn("position", (F.col("_rank") + F.col("_shift")).cast("bigint"))
        .drop("_digest", "_group", "_rank", "_shift")
    )


def _numbered(new: DataFrame, instruments: DataFrame) -> DataFrame:
    """New symbols with ids above the highest one in use, in the order of their digests."""
    top = instruments.agg(F.coalesce(F.max("instrument_id"), F.lit(0)).alias("top")).first()["top"]
    return number_rows(new, F.md5("symbol")).withColumn(
        "instrument_id", F.col("position") + F.lit(top)
    )


def missing_symbols(symbols: DataFrame, instruments: DataFrame) -> DataFrame:
    return symbols.select("symbol").distinct().join(instruments.select("symbol"), "symbol", "left_anti")


def created_instruments(symbols: DataFrame, instruments: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row for each contract symbol that the instruments lack."""
    new = missing_symbols(symbols, instruments).withColumns(contract_fields(F.col("symbol")))
    return conform(_numbered(new, instruments).withColumn("updated_at", clock(as_of)), INSTRUMENTS)


def get_or_create(symbols: DataFrame, instruments: DataFrame, as_of: str | None = None) -> DataFrame:
    """The instruments plus one row for each unseen contract symbol; existing rows stay."""
    return conform(instruments, INSTRUMENTS).unionByName(created_instruments(symbols, instruments, as_of))


def named_instruments(tickers: DataFrame, instruments: DataFrame, as_of: str | None = None) -> DataFrame:
    """The instruments that vendor tickers name, with the attributes parsed from them and the given
    clock; unseen ones also get an id."""
    parsed = (
        tickers.select(F.col("ticker").alias("symbol"))
        .distinct()
        .withColumns(ticker_fields(F.col("symbol")))
    )
    known = parsed.join(instruments.select("symbol", "instrument_id"), "symbol")
    created = _numbered(parsed.join(instruments.select("symbol"), "symbol", "left_anti"), instruments)
    named = conform(known, INSTRUMENTS).unionByName(conform(created, INSTRUMENTS))
    return named.withColumn("updated_at", clock(as_of)).select(*INSTRUMENTS.names)


def upsert_instruments(
    tickers: DataFrame, instruments: DataFrame, as_of: str | None = None
) -> DataFrame:
    """The instruments after an upsert by symbol of vendor tickers.

    Named instruments take the attributes parsed from their ticker and the given clock;
    unseen ones also get an id.
    """
    named = named_instruments(tickers, instruments, as_of)
    others = instruments.join(named.select("symbol"), "symbol", "left_anti")
    return conform(others, INSTRUMENTS).unionByName(conform(named, INSTRUMENTS))
