"""Data-quality checks as (section, check, status, detail) rows.

Each check reads its table once with aggregates only. ``status`` is PASSED, WARNING or
FAILED; as warnings never fail a run, the overall status looks for FAILED alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.numbers import floor_time, micros
from candlewick.operators.filters import clock, in_session
from candlewick.operators.joins import with_readings_of
from candlewick.schemas import INDICATOR_COLUMNS, TABLES

# The report's section titles in their order.
SECTIONS = (
    "Database Schema",
    "Retention Policy",
    "Data Flow",
    "Technical Indicators",
    "Real-time Performance",
    "Scalping Strategy Data",
)

RETENTION_DAYS = 7
SAMPLE_ROWS = 100
WEEK = 7 * 24 * 60 * 60
NEWEST_RANGES = 10

REPORT = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ("section", "check", "status", "detail")]
)


def schema_rows(
    spark: SparkSession, tables: Mapping[str, DataFrame], views: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Presence and type of each required table, column and view; needs no job. A missing view only warns."""
    rows = []
    for name, schema in TABLES.items():
        fault = "missing table"
        if name in tables:
            kinds = dict(tables[name].dtypes)
            lacking = [c for c in schema.names if c not in kinds]
            wrong = [f.name for f in schema if kinds.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
            fault = "; ".join(
                text + ",".join(names) for text, names in (("missing ", lacking), ("wrong type ", wrong)) if names
            )
        rows.append((SECTIONS[0], f"table {name}", "FAILED" if fault else "PASSED", fault or "complete"))
    there = views is not None and "first_two_hours_data" in views
    rows.append(
        (SECTIONS[5], "view first_two_hours_data", *(("PASSED", "exists") if there else ("WARNING", "missing")))
    )
    return spark.createDataFrame(rows, REPORT)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def instrument_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("row_count"))


def timeframe_counts(indicators: DataFrame) -> DataFrame:
    return indicators.groupBy("timeframe").agg(F.count(F.lit(1)).alias("row_count"))


def completeness(candles: DataFrame, indicators: DataFrame, timeframe: str = "1min") -> DataFrame:
    """One row: which indicators occur in the latest 100 candles, and whether all do."""
    # The newest candles are picked before the join: a left join on a unique key keeps their number.
    sample = candles.select("time", "instrument_id").orderBy(F.desc("time"), "instrument_id").limit(SAMPLE_ROWS)
    found = with_readings_of(sample, indicators, timeframe).agg(
        F.count(F.lit(1)).alias("sampled"),
        *[(F.count(name) > 0).alias(f"has_{name}") for name in INDICATOR_COLUMNS],
    )
    every = reduce(lambda a, b: a & b, [F.col(f"has_{name}") for name in INDICATOR_COLUMNS])
    return found.withColumn("complete", every)


def freshness(tables: Mapping[str, DataFrame], as_of: str | datetime | None = None) -> DataFrame:
    """(table_name, latest_time, age_minutes) for each table."""
    age = (micros(clock(as_of)) - micros(F.col("latest_time"))) / F.lit(60_000_000.0)
    return _stack(
        [
            df.agg(F.max("time").alias("latest_time")).select(
                F.lit(name).alias("table_name"), "latest_time", F.round(age, 4).alias("age_minutes")
            )
            for name, df in tables.items()
        ]
    )


def session_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, session_rows): rows in the first two session hours."""
    return _stack(
        [
            df.agg(F.count_if(in_session(F.col("time"))).alias("session_rows")).select(
                F.lit(name).alias("table_name"), "session_rows"
            )
            for name, df in tables.items()
        ]
    )


def time_ranges(
    tables: Mapping[str, DataFrame], seconds: int = WEEK, newest: int = NEWEST_RANGES
) -> DataFrame:
    """(table_name, range_start, first_time, last_time, row_count), the newest few over all tables."""
    every = _stack(
        [
            df.groupBy(floor_time(F.col("time"), seconds).alias("range_start"))
            .agg(
                F.min("time").alias("first_time"),
                F.max("time").alias("last_time"),
                F.count(F.lit(1)).alias("row_count"),
            )
            .select(F.lit(name).alias("table_name"), "range_start", "first_time", "last_time", "row_count")
            for name, df in tables.items()
        ]
    )
    return every.orderBy("table_name", F.desc("range_start")).limit(newest)


def retention_rows(
    tables: Mapping[str, DataFrame], as_of: str | datetime | None = None, days: int = RETENTION_DAYS
) -> DataFrame:
    """A warning for every table that holds rows older than the retention."""
    oldest = clock(as_of) - F.make_dt_interval(F.lit(days))
    return _stack(
        [
            _checked(
                df.agg(F.count_if(F.col("time") < oldest).alias("n")),
                SECTIONS[1],
                f"retention of {name}",
                F.col("n") == 0,
                F.concat(F.col("n").cast("string"), F.lit(" rows past retention")),
            )
            for name, df in tables.items()
        ]
    )


def report(
    tables: Mapping[str, DataFrame],
    views: Mapping[str, DataFrame] | None = None,
    as_of: str | datetime | None = None,
) -> DataFrame:
    """All six sections over tables named as in the schema.

    Counts, ages and coverage of a table come from one pass over it.
    """
    spark = tables["instruments"].sparkSession
    minute, readings = tables["candle_data_1min"], tables["technical_indicators"]
    every = F.concat(F.col("sampled").cast("string"), F.lit(" latest candles sampled"))
    return _stack(
        [
            schema_rows(spark, tables, views),
            _facts_rows(_stack([_facts(name, df, as_of) for name, df in tables.items()]), as_of),
            _checked(completeness(minute, readings), SECTIONS[3], "indicators present", F.col("complete"), every),
        ]
    )


def _facts(name: str, df: DataFrame, as_of: str | datetime | None) -> DataFrame:
    """One row of what the report says about a table."""
    count = F.count(F.lit(1)).alias("row_count")
    if "time" not in df.columns:
        nothing = F.lit(None).cast("timestamp_ntz").alias("latest_time"), F.lit(None).cast("bigint").alias("stale")
        facts = df.agg(count).select("row_count", *nothing, F.lit(None).cast("bigint").alias("session_rows"))
    else:
        session = in_session(F.col("time"))
        if "timeframe" in df.columns:
            session = session & (F.col("timeframe") == "15sec")
        oldest = clock(as_of) - F.make_dt_interval(F.lit(RETENTION_DAYS))
        facts = df.agg(
            count,
            F.max("time").alias("latest_time"),
            F.count_if(F.col("time") < oldest).alias("stale"),
            F.count_if(session).alias("session_rows"),
        )
    return facts.withColumn("table_name", F.lit(name))


def _facts_rows(facts: DataFrame, as_of: str | datetime | None) -> DataFrame:
    name = F.col("table_name")
    timed = [n for n in TABLES if n != "instruments"]
    flowing = [n for n in TABLES if n != "trading_signals"]
    live = [n for n in timed if n in flowing]
    age = F.round((micros(clock(as_of)) - micros(F.col("latest_time"))) / F.lit(60_000_000.0), 4)
    old = F.concat(F.round(age, 2).cast("decimal(20,2)").cast("string"), F.lit(" minutes old"))

    def row(names: list[str], section: str, check: str, holds: Column, detail: Column) -> Column:
        made = F.struct(
            F.lit(section).alias("section"),
            F.concat(F.lit(f"{check} "), name).alias("check"),
            F.when(holds, "PASSED").otherwise("WARNING").alias("status"),
            detail.alias("detail"),
        )
        return F.when(name.isin(*names), made)

    def rows_of(column: str, text: str) -> Column:
        return F.concat(F.col(column).cast("string"), F.lit(text))

    listed = F.array(
        row(timed, SECTIONS[1], "retention of", F.col("stale") == 0, rows_of("stale", " rows past retention")),
        row(flowing, SECTIONS[2], "rows in", F.col("row_count") > 0, rows_of("row_count", " rows")),
        row(live, SECTIONS[4], "latest in", F.col("latest_time").isNotNull(), F.coalesce(old, F.lit("no rows"))),
        row(
            ["candle_data_15sec", "technical_indicators"], SECTIONS[5], "session rows in",
            F.col("session_rows") > 0, rows_of("session_rows", " rows"),
        ),
    )
    return facts.select(F.inline(F.array_compact(listed)))


def overall(checks: DataFrame) -> DataFrame:
    """One row: whether no check failed."""
    passed = F.coalesce(F.bool_and(F.col("status") != "FAILED"), F.lit(True))
    return checks.agg(F.when(passed, "PASSED").otherwise("FAILED").alias("status"))


def _checked(df: DataFrame, section: str, check: str | Column, holds: Column, detail: Column) -> DataFrame:
    named = F.lit(check) if isinstance(check, str) else check
    return df.select(
        F.lit(section).alias("section"),
        named.alias("check"),
        F.when(holds, "PASSED").otherwise("WARNING").alias("status"),
        detail.alias("detail"),
    )


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
