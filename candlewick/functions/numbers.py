"""Numeric and time-stamp expressions with no ANSI failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or exponent notation; rules out type suffixes that a JVM parse would accept.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """Text to double, null when it is not a number.

    Like the other readers here it mentions its input once: Spark copies expressions
    into pushed-down filters, where a nested input would be evaluated per mention.
    """
    return F.regexp_extract(text, NUMBER_PATTERN, 0).try_cast("double")


def whole(text: Column) -> Column:
    """Text to bigint, truncating toward zero ('12.7' gives 12)."""
    return number(text).try_cast("bigint")


def day_and_clock(day: Column, clock: Column) -> Column:
    """``yyyyMMdd`` and an unpadded ``HHmm`` as a zone-less timestamp, null when malformed."""
    padded = F.concat(F.trim(day), F.lit(":0000"), F.trim(clock))
    text = F.regexp_replace(padded, r"^(\d{8}):0{0,4}?(\d{4})$", "$1$2")
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")


def iso_time(text: Column) -> Column:
    """ISO date or date-time; an offset is applied, and no offset means UTC."""
    shaped = F.regexp_extract(text, r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}.*)?)?$", 0)
    return shaped.try_cast("timestamp").cast("timestamp_ntz")


def finite(value: Column) -> Column:
    """Null in place of infinities and NaN."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def clip(value: Column, bound: float) -> Column:
    return F.greatest(F.least(value, F.lit(bound)), F.lit(-bound))


def relative_change(value: Column, base: Column) -> Column:
    """value / base - 1; from a zero base a change is infinite and no change is undefined."""
    value, base = value.cast("double"), base.cast("double")
    return F.when(base != 0, value / F.nullif(base, F.lit(0.0)) - 1.0).when(
        (base == 0) & (value != 0), F.signum(value) * F.lit(float("inf"))
    )


def micros(time: Column) -> Column:
    """A zone-less timestamp as microseconds since 1970 (sessions are pinned to UTC)."""
    return F.unix_micros(time.cast("timestamp"))


def floor_time(time: Column, seconds: int) -> Column:
    """The start of the fixed interval holding ``time``."""
    width = seconds * 1_000_000
    stamp = micros(time)
    return F.timestamp_micros(stamp - F.pmod(stamp, F.lit(width))).cast("timestamp_ntz")
