"""Decoding of tick payloads into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numbers import day_and_clock, iso_time, number, whole
from candlewick.functions.symbols import channel_symbol

# Keys that may carry the tick time, in the order they are tried.
TIME_KEYS = ("time", "timestamp", "datetime", "dt")

# Fixed value: fields a positional tick must have.
MIN_FIELDS = 10

PRICES = ("open", "high", "low", "close")


def _given(key: str) -> Column:
    """Whether a JSON tick has the key, be it with a null."""
    return F.coalesce(F.map_contains_key("_fields", key), F.lit(False))


def _texts() -> dict[str, Column]:
    """The raw text of each value, from the JSON object or from its position."""
    is_json = F.col("_fields").isNotNull()
    field = lambda position: F.try_element_at("_parts", F.lit(position))
    texts = {
        name: F.when(is_json, F.when(_given(name), F.col("_fields")[name]).otherwise("0")).otherwise(
            field(5 + i)
        )
        for i, name in enumerate((*PRICES, "volume"))
    }
    texts["open_interest"] = F.when(is_json, F.col("_fields")["oi"]).otherwise(field(10))
    return texts


def _json_time() -> Column:
    """The text of the last time key given, even one that cannot be read."""
    text = F.lit(None).cast("string")
    for key in TIME_KEYS:
        text = F.when(_given(key), F.col("_fields")[key]).otherwise(text)
    return text


def decode_ticks(envelopes: DataFrame) -> DataFrame:
    """Decode (seq, channel, data, timestamp) rows, JSON objects and positional text alike.

    Every input row is kept: ``reject_reason`` is null for a usable tick and says what
    is wrong otherwise. Works on static and streaming frames.
    """
    is_json = F.col("_fields").isNotNull()
    split = envelopes.withColumn(
        "_fields", F.when(F.ltrim("data").startswith("{"), F.from_json("data", "map<string,string>"))
    ).withColumn("_parts", F.when(F.col("_fields").isNull(), F.split("data", ",")))
    raw = split.select(
        "seq",
        channel_symbol(F.col("channel")).alias("symbol"),
        F.when(is_json, F.coalesce(iso_time(_json_time()), F.col("timestamp")))
        .otherwise(
            day_and_clock(
                F.try_element_at("_parts", F.lit(3)), F.try_element_at("_parts", F.lit(4))
            )
        )
        .alias("time"),
        *[text.alias(f"_{name}") for name, text in _texts().items()],
        F.when(is_json, _given("oi")).otherwise(F.try_element_at("_parts", F.lit(10)) != "").alias(
            "_has_interest"
        ),
        (~is_json & (F.coalesce(F.size("_parts"), F.lit(0)) < MIN_FIELDS)).alias("_short"),
    )
    values = F.struct(
        "time",
        *[number(F.col(f"_{name}")).alias(name) for name in PRICES],
        whole(F.col("_volume")).alias("volume"),
        whole(F.col("_open_interest")).alias("open_interest"),
        "_has_interest",
        "_short",
    )
    # Generating the one row keeps a filter on the outcome from being pushed below the
    # decoding, where it would parse every payload once per column it looks at.
    typed = raw.select("seq", "symbol", F.inline(F.array(values)))
    unreadable = F.greatest(*[F.col(name).isNull() for name in (*PRICES, "volume")]) | (
        F.col("_has_interest") & F.col("open_interest").isNull()
    )
    return typed.select(
        "seq",
        "symbol",
        "time",
        *PRICES,
        "volume",
        "open_interest",
        F.when(F.col("_short"), "too few fields")
        .when(F.col("time").isNull(), "unreadable time")
        .when(unreadable, "unreadable number")
        .alias("reject_reason"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(decoded: DataFrame) -> DataFrame:
    """The quarantine side of :func:`accepted`."""
    return decoded.where(F.col("reject_reason").isNotNull())
