"""Readers for candle files, ticker lists, request lists and exported data sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.numbers import day_and_clock, number, whole
from candlewick.functions.symbols import normalized_day

# The columns of the two input layouts, and the name of combined files.
CANDLE_FILE = ("Ticker", "Date", "Time", "Open", "High", "Low", "Close", "Volume", "OI")
REQUEST_FILE = ("Symbol", "StartDate", "EndDate", "Expiry", "Low", "High")
COMBINED_PREFIX = "combined_master"
COMBINED_NAME = "combined_master.csv"

# Where a row stands in its input: these three columns order rows as the files do.
ROW_ORDER = ("source_file", "source_block", "source_row")

# Column names that a combined frame may have at most; more means files without a header.
MAX_COLUMNS = 10_000

_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_lines(spark: SparkSession, path: str | list[str], suffix: str | None = ".csv") -> DataFrame:
    """The lines of text files with their position; in folders only files with ``suffix``."""
    reader = spark.read
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def _fields(line: Column) -> Column:
    """The fields of a CSV line; quotes around a field are taken off. A line without any is only split."""
    bare = F.transform(F.split(line, _COMMA), lambda f: F.regexp_replace(f, r'^\s*"(.*)"\s*$', "$1"))
    unquoted = F.transform(bare, lambda f: F.replace(f, F.lit('""'), F.lit('"')))
    return F.when(F.contains(line, F.lit('"')), unquoted).otherwise(F.split(line, ","))


def with_headers(lines: DataFrame) -> DataFrame:
    """Data lines as ``fields`` beside the ``header`` of their file, an array of names.

    The header is the first line of a file. Blank lines are no rows. Headers are split once a file and
    sent to the lines, which stay where they were read: files are few enough for the driver to list them,
    while all lines of a file would meet in one task.
    """
    first = F.broadcast(
        lines.where(F.col("source_block") == 0).groupBy("source_path").agg(F.min("source_row").alias("_header_row"))
    )
    heads = (
        lines.where(F.col("source_block") == 0)
        .join(first, "source_path")
        .where(F.col("source_row") == F.col("_header_row"))
        .groupBy("source_path", "_header_row")
        .agg(F.min("value").alias("_header"))
    )
    clean = F.transform(_fields(F.ltrim(F.col("_header"), F.lit("\ufeff"))), F.trim)
    # One test of both sides, which is not pushed below the join, where it would make every line twice.
    row = F.when(F.col("source_row") != F.col("_header_row"), F.col("value"))
    return (
        lines.join(F.broadcast(heads.select("source_path", "_header_row", clean.alias("header"))), "source_path")
        .where(F.trim(row) != "")
        .select("source_path", *ROW_ORDER, "header", _fields(F.col("value")).alias("fields"))
    )


def named_fields(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The fields called ``names``, wherever the file has them, and ``missing``: those it lacks.

    An empty field is null.
    """
    wanted = F.array(*map(F.lit, names))
    field = {
        name: F.nullif(F.get("fields", F.array_position("header", name).cast("int") - 1), F.lit(""))
        for name in names
    }
    return rows.select(
        *[value.alias(name) for name, value in field.items()],
        F.array_except(wanted, "header").alias("missing"),
        *ROW_ORDER,
    )


def read_candle_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Candle files as text columns with their position; combined files are passed over."""
    lines = read_lines(spark, path).where(~F.col("source_file").startswith(COMBINED_PREFIX))
    return named_fields(with_headers(lines), CANDLE_FILE)


def parse_candles(raw: DataFrame) -> DataFrame:
    """Typed candles by symbol, each with a ``reject_reason`` that is null when usable.

    Times are taken as UTC without shifting; an empty volume is 0, an empty interest null.
    """
    prices = {name.lower(): number(F.col(name)) for name in CANDLE_FILE[3:7]}
    time = day_and_clock(F.col("Date"), F.col("Time"))

    def empty(name):
        return F.coalesce(F.col(name), F.lit("")) == ""

    # Columns first and the reason from these: each reading is made once for both.
    typed = raw.select(
        F.col("Ticker").alias("symbol"),
        time.alias("time"),
        *[price.alias(name) for name, price in prices.items()],
        F.when(empty("Volume"), F.lit(0)).otherwise(whole(F.col("Volume"))).alias("volume"),
        F.when(~empty("OI"), whole(F.col("OI"))).alias("open_interest"),
        (~empty("OI")).alias("_has_interest"),
        "missing",
        *ROW_ORDER,
    )
    reason = (
        F.when(F.size("missing") > 0, F.concat(F.lit("no column "), F.array_join("missing", ", ")))
        .when(F.coalesce("symbol", F.lit("")) == "", "no symbol")
        .when(F.col("time").isNull(), "unreadable time")
        .when(
            F.greatest(*[F.col(name).isNull() for name in prices])
            | F.col("volume").isNull()
            | (F.col("_has_interest") & F.col("open_interest").isNull()),
            "unreadable number",
        )
    )
    return typed.select(
        "symbol", "time", *prices, "volume", "open_interest", reason.alias("reject_reason"), *ROW_ORDER
    )


def whole_files(parsed: DataFrame) -> DataFrame:
    """``parsed`` without any file that holds an unusable row."""
    # Counted, not filtered: a filter on the reason would repeat the reading of a line for every field it names.
    bad = file_counts(parsed).where(F.col("rejected") > 0).select("source_file")
    return parsed.join(bad, "source_file", "left_anti")


def file_counts(parsed: DataFrame) -> DataFrame:
    """(source_file, accepted, rejected) rows of each file."""
    return parsed.groupBy("source_file").agg(
        F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def import_counts(parsed: DataFrame) -> DataFrame:
    """One row: files without and with an unusable row."""
    return file_counts(parsed).agg(
        F.count_if(F.col("rejected") == 0).alias("imported"),
        F.count_if(F.col("rejected") > 0).alias("failed"),
    )


def combined_rows(lines: DataFrame, output_name: str = COMBINED_NAME) -> DataFrame:
    """Every row of the files as a map from column name to text, with its file.

    Only the file that carries the output's own name is left out.
    """
    rows = with_headers(lines.where(F.col("source_file") != output_name))
    width = F.size("header")
    padded = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.nullif(F.get("fields", i), F.lit("")))
    return rows.select(F.map_from_arrays("header", padded).alias("row"), *ROW_ORDER)


def combine_csvs(
    spark: SparkSession, folder: str, output_name: str = COMBINED_NAME, columns: Sequence[str] | None = None
) -> DataFrame:
    """All files of a folder under each other with a ``__source_file`` column.

    Columns go by name and are null where a file lacks them. Unless ``columns`` are given, the
    different column names come to the driver, which must know them to make a frame.
    """
    rows = combined_rows(read_lines(spark, folder), output_name)
    if columns is None:
        found = rows.select(F.explode(F.map_keys("row")).alias("name")).distinct().limit(MAX_COLUMNS + 1)
        columns = sorted(row["name"] for row in found.collect())
        if len(columns) > MAX_COLUMNS:
            raise ValueError(f"more than {MAX_COLUMNS} column names in {folder}: do the files have headers?")
    if not columns:
        raise ValueError(f"no files to combine in {folder}")
    return rows.select(
        *[F.col("row")[name].alias(name) for name in columns], F.col("source_file").alias("__source_file")
    )


def read_tickers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tickers of comma- and line-separated lists, blanks dropped, with their position."""
    return split_tickers(read_lines(spark, path, suffix=None))


def split_tickers(lines: DataFrame) -> DataFrame:
    split = lines.select(
        F.posexplode(F.split("value", ",")).alias("source_column", "ticker"), *ROW_ORDER
    )
    return split.withColumn("ticker", F.trim("ticker")).where(F.col("ticker") != "")


TICKER_ORDER = (*ROW_ORDER, "source_column")


def read_requests(spark: SparkSession, path: str | list[str], head: int | None = None) -> DataFrame:
    """Request lists with normalised dates and whole strikes, optionally only the first rows."""
    return parse_requests(named_fields(with_headers(read_lines(spark, path, suffix=None)), REQUEST_FILE), head)


def parse_requests(raw: DataFrame, head: int | None = None) -> DataFrame:
    """Typed requests from text columns; rows of files that lack a column are left out."""
    raw = raw.where(F.size("missing") == 0)
    if head is not None:
        raw = raw.orderBy(*ROW_ORDER).limit(head)
    return raw.select(
        F.col("Symbol").alias("symbol"),
        normalized_day(F.trim("StartDate")).alias("start_date"),
        normalized_day(F.trim("EndDate")).alias("end_date"),
        normalized_day(F.trim("Expiry")).alias("expiry"),
        whole(F.col("Low")).alias("low"),
        whole(F.col("High")).alias("high"),
    )


def read_dataset(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exported CSV data set; columns go by name, and one that is missing is null."""
    raw = named_fields(with_headers(read_lines(spark, path, suffix=None)), schema.names)
    return raw.select(
        *[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema.fields]
    )
