from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlewick.functions.numbers import relative_change, whole
from candlewick.functions.symbols import (
    channel_symbol,
    contract_fields,
    normalized_day,
    ticker_fields,
    underlying,
)
from candlewick.functions.ticks import accepted, decode_ticks, rejected
from candlewick.schemas import TICK_ENVELOPE

ARRIVAL = datetime(2024, 3, 1, 12, 0)
FULL = {"open": 1, "high": 2, "low": 1, "close": 2, "volume": "10.0", "oi": "7"}


def decode(spark, *payloads):
    rows = [
        (i, "NSE_EQ.A.JSON", p if isinstance(p, str) else json.dumps(p), ARRIVAL)
        for i, p in enumerate(payloads)
    ]
    return decode_ticks(spark.createDataFrame(rows, TICK_ENVELOPE))


def one(spark, payload):
    return decode(spark, payload).first()


def test_json_tick(spark):
    row = one(spark, {"time": "2024-03-01T09:15:03+00:00", **FULL})
    assert row.symbol == "NSE_EQ.A"
    assert row.time == datetime(2024, 3, 1, 9, 15, 3)
    assert (row.open, row.high, row.low, row.close) == (1.0, 2.0, 1.0, 2.0)
    assert (row.volume, row.open_interest, row.reject_reason) == (10, 7, None)


@pytest.mark.parametrize(
    "times, want",
    [
        ({}, ARRIVAL),
        ({"time": "2024-03-01T09:15:03"}, datetime(2024, 3, 1, 9, 15, 3)),
        ({"time": "2024-03-01T09:15:03+05:30"}, datetime(2024, 3, 1, 3, 45, 3)),
        ({"time": "2024-03-01"}, datetime(2024, 3, 1)),
        ({"time": "2024-03-01T09:00:00", "dt": "2024-03-02T00:00:00"}, datetime(2024, 3, 2)),
        ({"dt": "2024-03-02T00:00:00", "time": "2024-03-01T09:00:00"}, datetime(2024, 3, 2)),
        ({"time": "2024-03-01T09:00:00", "datetime": "soon"}, ARRIVAL),
        ({"time": "2024-03-01T09:00:00", "timestamp": None}, ARRIVAL),
        ({"time": 1709283600}, ARRIVAL),
    ],
)
def test_json_time_keys(spark, times, want):
    assert one(spark, {**FULL, **times}).time == want


def test_json_defaults_and_bad_numbers(spark):
    rows = decode(
        spark, {}, {**FULL, "close": "x"}, {**FULL, "volume": None}, {**FULL, "oi": "x"}, {"volume": "-3.9"}
    ).orderBy("seq").collect()
    assert (rows[0].open, rows[0].volume, rows[0].open_interest, rows[0].reject_reason) == (0.0, 0, None, None)
    assert [r.reject_reason is not None for r in rows] == [False, True, True, True, False]
    assert rows[4].volume == -3


def test_positional_ticks(spark):
    good = "x,y,20240301,915,1,2,1,2,10.7,7"
    rows = decode(
        spark,
        good,
        "x,y,20240301,0915,1,2,1,2,10,",
        "x,y,20240301,915,1,2,1,2,10",
        "x,y,20240301,2515,1,2,1,2,10,7",
        "x,y,20240301,915,1,2,1,?,10,7",
        "[1, 2]",
    ).orderBy("seq").collect()
    assert rows[0].time == datetime(2024, 3, 1, 9, 15) and rows[0].volume == 10
    assert (rows[0].open, rows[0].high, rows[0].low, rows[0].close) == (1.0, 2.0, 1.0, 2.0)
    assert rows[1].open_interest is None and rows[1].reject_reason is None
    assert [r.reject_reason for r in rows[2:]] == [
        "too few fields", "unreadable time", "unreadable number", "too few fields"
    ]


def test_quarantine_is_the_complement(spark):
    decoded = decode(spark, FULL, "junk", {**FULL, "open": "x"})
    assert accepted(decoded).count() == 1 and rejected(decoded).count() == 2


def fields(spark, maker, text):
    return spark.createDataFrame([(text,)], "t string").select(
        *[c.alias(n) for n, c in maker(F.col("t")).items()]
    ).first()


@pytest.mark.parametrize(
    "ticker, want",
    [
        ("NSE_OPTIDX_AAA_28MAR2024_22000_CE", ("option", "CE", Decimal("22000"), "2024-03-28")),
        ("NSE_OPTIDX_AAA_1mar2024_220.5_PE", ("option", "PE", Decimal("220.5"), "2024-03-01")),
        ("NSE_OPTIDX_AAA_28MAR2024_high_CE", ("option", None, None, None)),
        ("NSE_OPTIDX_AAA_31FEB2024_22000_CE", ("option", None, None, None)),
        ("NSE_OPTSTK_AAA", ("option", None, None, None)),
        ("NSE_FUTIDX_AAA_28MAR2024", ("future", None, None, "2024-03-28")),
        ("NSE_FUTIDX_AAA_soon", ("future", None, None, None)),
        ("BSE_INDICES_BBB", ("index", None, None, None)),
        ("NSE_EQ_DDD", ("stock", None, None, None)),
        ("X_Y", (None, None, None, None)),
        ("", (None, None, None, None)),
    ],
)
def test_vendor_tickers(spark, ticker, want):
    row = fields(spark, ticker_fields, ticker)
    got = (row.instrument_type, row.option_type, row.strike_price, row.expiry_date and str(row.expiry_date))
    assert got == want


@pytest.mark.parametrize(
    "symbol, want",
    [
        ("AAA_22000CE-28MAR2024", ("option", "CE", Decimal("22000"), "2024-03-28")),
        (" AAA_22000PE-28MAR2024.NFO", ("option", "PE", Decimal("22000"), "2024-03-28")),
        ("RELIANCE", ("option", None, None, None)),
        ("aaa_22000CE-28MAR2024", ("option", None, None, None)),
        ("SILVER", ("index", None, None, None)),
    ],
)
def test_contract_symbols(spark, symbol, want):
    row = fields(spark, contract_fields, symbol)
    got = (row.instrument_type, row.option_type, row.strike_price, row.expiry_date and str(row.expiry_date))
    assert got == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("28MAR2024", "28MAR2024"),
        ("1-Mar-2024", "01MAR2024"),
        ("01-mar-24", "01MAR2024"),
        ("28Mar24", "28MAR2024"),
        ("2024/03/28x", "2024/03/28X"),
        ("31-Feb-2024", "31-FEB-2024"),
    ],
)
def test_day_spellings(spark, text, want):
    assert spark.range(1).select(normalized_day(F.lit(text)).alias("d")).first().d == want


def test_small_expressions(spark):
    row = spark.range(1).select(
        channel_symbol(F.lit("A.B.JSON")).alias("a"),
        channel_symbol(F.lit("AB")).alias("b"),
        underlying(F.lit("1NIFTY_5CE")).alias("c"),
        underlying(F.lit("123")).alias("d"),
        whole(F.lit("12.7")).alias("e"),
        whole(F.lit("-12.7")).alias("f"),
        whole(F.lit("12d")).alias("g"),
        relative_change(F.lit(3.0), F.lit(0.0)).alias("h"),
        relative_change(F.lit(0.0), F.lit(0.0)).alias("i"),
        relative_change(F.lit(3.0), F.lit(2.0)).alias("j"),
    ).first()
    assert tuple(row) == ("A.B", "AB", "NIFTY", None, 12, -12, None, float("inf"), None, 0.5)
