from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from candlewick.operators import quality
from candlewick.operators.indicators import indicators
from candlewick.operators.instruments import (
    best_instrument,
    contract_catalog,
    contract_slice,
    expiries,
    first_instrument,
    get_or_create,
    number_rows,
    preferred_instrument,
    strikes,
    underlyings,
)
from candlewick.schemas import CANDLES, INDICATORS, INSTRUMENTS, SIGNALS
from helpers import START, candle_frame, random_candles
from pyspark.sql import functions as F


@pytest.fixture
def tables(spark):
    candles = candle_frame(spark, random_candles(1, {1: 60, 2: 60}, gappy=False))
    return {
        "instruments": spark.createDataFrame([(1, "A", None, None, None, None, None)], INSTRUMENTS),
        "candle_data_1min": candles,
        "candle_data_15sec": spark.createDataFrame([], CANDLES),
        "technical_indicators": indicators(candles),
        "trading_signals": spark.createDataFrame([], SIGNALS),
    }


def found(report):
    return {(r.section, r.check): (r.status, r.detail) for r in report.collect()}


def test_report(tables):
    as_of = START + timedelta(minutes=69)
    rows = found(quality.report(tables, {}, as_of))
    assert rows["Database Schema", "table instruments"] == ("PASSED", "complete")
    assert rows["Data Flow", "rows in candle_data_1min"] == ("PASSED", "120 rows")
    assert rows["Data Flow", "rows in candle_data_15sec"] == ("WARNING", "0 rows")
    assert rows["Technical Indicators", "indicators present"] == ("PASSED", "100 latest candles sampled")
    assert rows["Real-time Performance", "latest in candle_data_1min"] == ("PASSED", "9.00 minutes old")
    assert rows["Real-time Performance", "latest in candle_data_15sec"] == ("WARNING", "no rows")
    assert rows["Scalping Strategy Data", "view first_two_hours_data"][0] == "WARNING"
    assert rows["Retention Policy", "retention of candle_data_1min"] == ("PASSED", "0 rows past retention")
    assert {s for s, _ in rows} == set(quality.SECTIONS)
    assert quality.overall(quality.report(tables, {}, as_of)).first().status == "PASSED"


def test_a_missing_column_or_table_fails(tables):
    tables["candle_data_1min"] = tables["candle_data_1min"].withColumn("x", F.lit(1))
    tables["instruments"] = tables["instruments"].drop("symbol")
    spark = tables["instruments"].sparkSession
    rows = found(quality.schema_rows(spark, {k: v for k, v in tables.items() if k != "trading_signals"}))
    assert rows["Database Schema", "table candle_data_1min"][0] == "PASSED"
    assert rows["Database Schema", "table instruments"] == ("FAILED", "missing symbol")
    assert rows["Database Schema", "table trading_signals"] == ("FAILED", "missing table")
    assert quality.overall(quality.report(tables)).first().status == "FAILED"


def test_completeness_sees_a_missing_indicator(tables):
    ind = tables["technical_indicators"].withColumn("tvi", F.lit(None).cast("double"))
    row = quality.completeness(tables["candle_data_1min"], ind).first()
    assert (row.sampled, row.has_tvi, row.has_obv, row.complete) == (100, False, True, False)


def test_counts_and_ranges(tables):
    counts = {r.instrument_id: r.row_count for r in quality.instrument_counts(tables["candle_data_1min"]).collect()}
    assert counts == {1: 60, 2: 60}
    assert quality.timeframe_counts(tables["technical_indicators"]).first().row_count == 120
    ranges = quality.time_ranges({"c": tables["candle_data_1min"]}, seconds=1800, newest=2).orderBy(F.desc("range_start")).collect()
    assert [r.row_count for r in ranges] == [32, 60]
    assert ranges[0].range_start == datetime(2024, 3, 1, 10, 0)
    session = quality.session_coverage({"c": tables["candle_data_1min"]}).first()
    assert session.session_rows == 120
    assert tables["technical_indicators"].columns == INDICATORS.names


def contracts(spark, *rows):
    return spark.createDataFrame(
        [(i, s, "option", o, k, e, None) for i, (s, o, k, e) in enumerate(rows, 1)], INSTRUMENTS
    )


def test_catalogue(spark):
    from decimal import Decimal

    e1, e2 = date(2024, 3, 28), date(2024, 4, 25)
    dim = contracts(
        spark,
        ("ACME_1CE", "CE", Decimal(1), e1),
        ("NIFTY_2CE", "CE", Decimal(2), e2),
        ("NIFTY_1PE", "PE", Decimal(1), e2),
        ("NIFTY_1CE", "CE", Decimal(1), e1),
        ("BANKNIFTY_5CE", "CE", Decimal(5), e1),
        ("123", None, None, None),
    )
    assert [r.underlying for r in underlyings(dim).collect()] == ["NIFTY", "BANKNIFTY", "ACME"]
    assert [r.expiry_date for r in expiries(dim, "NIFTY").collect()] == [e1, e2]
    assert [int(r.strike_price) for r in strikes(dim, "NIFTY", e2).collect()] == [1, 2]
    assert [r.symbol for r in contract_slice(dim, "NIFTY", e2, 1, "PE").collect()] == ["NIFTY_1PE"]
    assert contract_catalog(dim).count() == 5
    assert preferred_instrument(dim).first().symbol == "NIFTY_2CE"
    assert first_instrument(dim).first().symbol == "ACME_1CE"
    one_reading = spark.createDataFrame([(START, i, "1min", None, None, None, None, None) for i in (1, 5)], INDICATORS)
    frame = candle_frame(spark, random_candles(1, {1: 2, 2: 2, 5: 2}))
    assert best_instrument(dim, frame, one_reading).first().symbol == "BANKNIFTY_5CE"
    assert best_instrument(dim, frame, one_reading.where("instrument_id = 1")).first().symbol == "ACME_1CE"
    assert best_instrument(dim, frame, one_reading.where("instrument_id = 9")).isEmpty()


def test_numbering_is_dense_and_in_digest_order(spark):
    rows = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("symbol"))
    got = number_rows(rows, F.md5("symbol")).withColumn("d", F.md5("symbol")).orderBy("d").collect()
    assert [r.position for r in got] == list(range(1, 3001))


def test_get_or_create_leaves_known_rows(spark):
    from decimal import Decimal

    dim = contracts(spark, ("ACME_1CE", "CE", Decimal(1), date(2024, 3, 28)))
    asked = spark.createDataFrame([("ACME_1CE",), ("Z_7PE-01JAN2025",), ("Z_7PE-01JAN2025",)], "symbol string")
    rows = {r.symbol: r for r in get_or_create(asked, dim, "2024-01-31").collect()}
    assert len(rows) == 2 and rows["ACME_1CE"] == dim.first()
    new = rows["Z_7PE-01JAN2025"]
    assert (new.instrument_id, new.option_type, new.strike_price, new.expiry_date) == (2, "PE", 7, date(2025, 1, 1))


def test_a_wrong_column_type_fails(spark, tables):
    bad = {**tables, "candle_data_1min": tables["candle_data_1min"].withColumn("volume", F.col("volume").cast("string"))}
    rows = found(quality.schema_rows(spark, bad))
    assert rows["Database Schema", "table candle_data_1min"] == ("FAILED", "wrong type volume")
