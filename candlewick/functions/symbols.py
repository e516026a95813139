"""Parsing of tickers, contract symbols, channels and loosely formatted dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.functions.numbers import number
from candlewick.schemas import STRIKE

# The segments that are collected.
SEGMENT_PREFIXES = ("NSE_", "BSE_")

# Fixed value: historical contract symbols such as AAA_22000CE-28MAR2024.
CONTRACT_PATTERN = r"^([A-Z]+)_(\d+)(CE|PE)-(\d{2}[A-Z]{3}\d{4})"

COMPACT_DAY = r"^\d{1,2}[A-Za-z]{3}\d{4}$"

# Accepted spellings of a day: a shape test and the parse format that goes with it.
DAY_SPELLINGS = (
    (COMPACT_DAY, "dMMMyyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
    (r"^\d{1,2}[A-Za-z]{3}\d{2}$", "dMMMyy"),
)


def compact_day(text: Column) -> Column:
    """``28MAR2024`` (any case) as a date, null when malformed."""
    return F.try_to_date(F.regexp_extract(text, COMPACT_DAY, 0), "dMMMyyyy")


def normalized_day(text: Column) -> Column:
    """Any accepted spelling as upper-case ``ddMMMyyyy``; other input only upper-cased."""
    parsed = F.coalesce(
        *[F.try_to_date(F.regexp_extract(text, shape, 0), fmt) for shape, fmt in DAY_SPELLINGS]
    )
    return F.upper(F.coalesce(F.date_format(parsed, "ddMMMyyyy"), text))


def in_segment(ticker: Column) -> Column:
    first, *rest = [ticker.startswith(prefix) for prefix in SEGMENT_PREFIXES]
    for test in rest:
        first = first | test
    return first


def ticker_fields(ticker: Column) -> dict[str, Column]:
    """Attributes of a vendor ticker, named as in the instruments table.

    The second token gives the type. An option carries type, strike and expiry in its
    last three tokens, and one unreadable part voids all three.
    """
    tokens = F.split(ticker, "_")
    token = lambda position: F.try_element_at(tokens, F.lit(position))
    kind = F.when(
        F.size(tokens) >= 3,
        F.when(token(2).startswith("OPT"), "option")
        .when(token(2).startswith("FUT"), "future")
        .when(token(2) == "INDICES", "index")
        .otherwise("stock"),
    )
    strike, expiry = number(token(-2)), compact_day(token(-3))
    readable = (kind == "option") & strike.isNotNull() & expiry.isNotNull()
    return {
        "instrument_type": kind,
        "option_type": F.when(readable, token(-1)),
        "strike_price": F.when(readable, strike).try_cast(STRIKE),
        "expiry_date": F.when(readable, expiry).when(kind == "future", compact_day(token(-1))),
    }


def contract_fields(symbol: Column) -> dict[str, Column]:
    """Attributes of a historical contract symbol, named as in the instruments table.

    The type looks only for CE or PE anywhere in the symbol, so names that contain
    either by chance also count as options.
    """
    trimmed = F.trim(symbol)
    part = lambda group: F.nullif(
        F.regexp_extract(trimmed, CONTRACT_PATTERN, group), F.lit("")
    )
    return {
        "instrument_type": F.when(symbol.contains("CE") | symbol.contains("PE"), "option").otherwise(
            "index"
        ),
        "option_type": part(3),
        "strike_price": part(2).try_cast(STRIKE),
        "expiry_date": compact_day(part(4)),
    }


def underlying(symbol: Column) -> Column:
    """The first run of capitals, null when there is none."""
    return F.nullif(F.regexp_extract(symbol, "([A-Z]+)", 1), F.lit(""))


def channel_symbol(channel: Column) -> Column:
    """The channel name without its last dotted suffix."""
    return F.regexp_replace(channel, r"\.[^.]*$", "")


def index_rank(symbol: Column) -> Column:
    """Preference order among index names: NIFTY, BANKNIFTY, other NIFTY names, the rest."""
    return (
        F.when(symbol.like("NIFTY%"), 0)
        .when(symbol.like("BANKNIFTY%"), 1)
        .when(symbol.like("%NIFTY%"), 2)
        .otherwise(3)
    )
