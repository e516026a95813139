"""The driver's tables read as market data.

* line items are ticks of the supplier they name; a day of them makes a candle
* suppliers are the instruments, with contract symbols built from their keys
* events are ticks whose symbol is the event type
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.functions.symbols import contract_fields
from candlewick.operators.indicators import candles_with_indicators, indicators
from candlewick.operators.resample import candles
from candlewick.schemas import CANDLES, INSTRUMENTS, conform

DAY = 24 * 60 * 60
PART_SPAN = 2**21

# The clock of every query that asks for "now".
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def supplier_ticks(spark: SparkSession, folder: str) -> DataFrame:
    # Sixteenths, so that sums and means of prices are exact in any order.
    price = 1000 + F.floor(F.col("l_extendedprice") / 62.5) / 16
    # Order, line and part as one number; orders and lines alone do not tell ticks apart.
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * PART_SPAN + F.col("l_partkey") % PART_SPAN
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("instrument_id"),
        F.col("l_shipdate").alias("time"),
        price.alias("open"),
        price.alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.nullif(F.col("l_partkey") % 100, F.lit(7)).alias("open_interest"),
        line.alias("seq"),
    )


def daily_candles(spark: SparkSession, folder: str) -> DataFrame:
    return candles(supplier_ticks(spark, folder), DAY).select(*CANDLES.names)


def tick_count_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks bound the candles of an instrument and are counted without making any."""
    return supplier_ticks(spark, folder).select("instrument_id", "time")


def daily_indicators(spark: SparkSession, folder: str) -> DataFrame:
    return indicators(
        daily_candles(spark, folder), "1min", counted=tick_count_frame(spark, folder)
    )


def carried_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """The daily candles with their indicators beside them, from one pass over the line items."""
    return candles_with_indicators(daily_candles(spark, folder), counted=tick_count_frame(spark, folder))


def supplier_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """(instrument_id, symbol): option contracts on index names, or the supplier's own name."""
    key = F.col("s_suppkey")
    name = F.element_at(
        F.array(*[F.lit(n) for n in ("NIFTY", "BANKNIFTY", "FINNIFTY", "ACME")]),
        (key % 4 + 1).cast("int"),
    )
    right = F.when(key % 3 == 0, "CE").otherwise("PE")
    contract = F.concat(name, F.lit("_"), (key * 50 + 20000).cast("string"), right, F.lit("-28MAR2024"))
    return table(spark, folder, "supplier").select(
        key.alias("instrument_id"),
        F.when(key % 5 == 0, F.col("s_name")).otherwise(contract).alias("symbol"),
    )


def supplier_instruments(spark: SparkSession, folder: str) -> DataFrame:
    return conform(
        supplier_symbols(spark, folder).withColumns(contract_fields(F.col("symbol"))), INSTRUMENTS
    )


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks in arrival order, which runs up to four events out of step with their times."""
    return table(spark, folder, "events").select(
        (F.col("event_id") + F.pmod(F.col("event_id") * 7, F.lit(5))).alias("_shifted"),
        "event_id",
        "user_id",
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("time"),
        F.col("value").alias("open"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    ).select(
        "*",
        F.nullif("volume", F.lit(13)).alias("open_interest"),
        # Unique, because the shift is under eight.
        (F.col("_shifted") * 8 + F.col("_shifted") - F.col("event_id")).alias("seq"),
    ).drop("_shifted")


def trending_candles(spark: SparkSession, folder: str) -> DataFrame:
    """The daily candles with a close that runs down and up in turns, by one a day.

    Each turn begins with a jump and twenty times the volume, so that all signals occur.
    """
    along = Window.partitionBy("instrument_id").orderBy("time")
    place = F.col("_place") % 40
    step = F.when(place < 16, -1).when(place == 16, 4).when(place < 32, 1).when(place == 32, -4).otherwise(0)
    return (
        daily_candles(spark, folder)
        .withColumn("_place", F.row_number().over(along))
        .withColumn("close", 2000.0 + F.sum(step.cast("double")).over(along))
        .withColumn("volume", F.when(place.isin(16, 32), F.col("volume") * 20).otherwise(F.col("volume")))
        .select(*CANDLES.names)
    )


#: Header of each made candle file: in order, with columns changed about, backwards, and without one.
FILE_HEADERS = (
    "Ticker,Date,Time,Open,High,Low,Close,Volume,OI",
    "Ticker,Date,Time,Close,High,Low,Open,OI,Volume",
    "OI,Volume,Close,Low,High,Open,Time,Date,Ticker",
    "Ticker,Date,Time,High,Low,Close,Volume,OI",
)


def candle_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as lines of four candle files, some with an unreadable volume."""
    part = F.col("l_partkey")
    cells = {
        "Ticker": F.concat(F.lit("S"), F.col("l_suppkey")),
        "Date": F.date_format("l_shipdate", "yyyyMMdd"),
        "Time": (915 + part % 45).cast("string"),
        "Open": (part % 1000).cast("string"),
        "High": (part % 1000 + 2).cast("string"),
        "Low": (part % 1000 - 1).cast("string"),
        "Close": (part % 1000 + 1).cast("string"),
        "Volume": F.when(part % 50 == 0, F.lit("oops")).otherwise(F.col("l_quantity").cast("bigint").cast("string")),
        "OI": F.when(part % 7 == 0, F.lit("")).otherwise((part % 100).cast("string")),
    }
    file = F.col("l_suppkey") % len(FILE_HEADERS)
    line = F.concat_ws(",", *[cells[name] for name in FILE_HEADERS[0].split(",")])
    for k, header in enumerate(FILE_HEADERS[1:], 1):
        line = F.when(file == k, F.concat_ws(",", *[cells[name] for name in header.split(",")])).otherwise(line)
    rows = table(spark, folder, "lineitem").select(
        file.alias("_file"),
        line.alias("value"),
        (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * PART_SPAN + part % PART_SPAN) + 1).alias("source_row"),
    )
    heads = spark.createDataFrame(
        [(k, header, 0) for k, header in enumerate(FILE_HEADERS)], "_file long, value string, source_row long"
    )
    name = F.concat(F.lit("file_"), F.col("_file"), F.lit(".csv"))
    return heads.unionByName(rows).select(
        "value", name.alias("source_path"), name.alias("source_file"),
        F.lit(0).cast("long").alias("source_block"), "source_row",
    )
