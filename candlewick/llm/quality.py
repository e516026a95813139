"""Quality rules with thresholds that follow the data.

Every document gets a few measures. Per language and source, a mergeable quantile sketch of each
rate gives its quartiles, and from these the bounds that its documents are judged by; small
groups take the bounds of their language, or of all documents. The sketch counts values rounded
down to their seven leading binary digits, so it is exact under merging and in any order of rows,
its relative error is below 1/64 and its size is bounded.

Defined cases: a null or empty text has no words and fails the base rule. Null languages and
sources are groups of their own. Repeated rows count as often as they occur. Other columns,
whatever their names, are passed on.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from candlewick.llm.common import BLANKS, free_name, small_batches, stored, texts

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")
_STRUCT = ", ".join(f"{name} long" for name in MEASURES)

#: The judged rates in thousandths, and the least distance of quartiles that is assumed, as a
#: group whose documents are all alike says nothing about what is far from them.
RATES = {
    "chars_per_word": 1000,
    "symbols_per_word": 50,
    "upper_per_char": 50,
    "dup_lines_per_line": 200,
}
FENCE = 3
MIN_GROUP = 100
LEADING_BITS = 7
BROADCAST_GROUPS = 50_000


def _repeat_words(data: bytes, words: list[bytes]) -> int:
    """Words that lie in windows of eight words found twice or more, first ones included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    order = np.argsort(mixed, kind="stable")
    ranked = mixed[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.r_[True, ~same])
    for lo, hi in zip(starts, np.r_[starts[1:], n], strict=True):
        if hi - lo < 2:
            continue
        # Equal hashes are only candidates: the words themselves decide.
        groups: dict[tuple, list[int]] = {}
        for at in order[lo:hi].tolist():
            groups.setdefault(tuple(words[at : at + WINDOW]), []).append(at)
        for places in groups.values():
            if len(places) > 1:
                covered[places] += 1
                covered[np.array(places) + WINDOW] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure(data: bytes) -> tuple[int, ...]:
    words = data.split()  # on bytes: exactly the six blanks
    seen: set[bytes] = set()
    dup = with_words = 0
    for line in data.split(b"\n"):
        if line.strip(BLANKS):
            with_words += 1
            dup += line in seen
            seen.add(line)
    codes = np.frombuffer(data, np.uint8)
    chars = len(codes) - int(((codes & 0xC0) == 0x80).sum())
    blanks = sum(data.count(BLANKS[i : i + 1]) for i in range(len(BLANKS)))
    return (
        len(words), chars - blanks, sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))), dup,
        _repeat_words(data, words), int(((codes >= 65) & (codes <= 90)).sum()), with_words,
    )


def _measures(text: pa.Array) -> pa.Array:
    rows = [measure(value) for value in texts(text)]
    columns = zip(*rows, strict=True) if rows else [[]] * len(MEASURES)
    return pa.StructArray.from_arrays(
        [pa.array(column, pa.int64()) for column in columns], names=list(MEASURES)
    )


def measured(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the struct column ``name`` of all measures."""
    return small_batches(docs).withColumn(name, F.arrow_udf(_measures, _STRUCT)(F.col(text_col).cast("string")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (
        m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT
    )


def rates(m: Column) -> dict[str, Column]:
    """The judged rates in thousandths, whole numbers; zero where there is nothing to divide by."""

    def share(a: str, b: str) -> Column:
        return F.when(m[b] > 0, F.floor(m[a] * 1000 / m[b])).otherwise(0).cast("long")

    return {
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "upper_per_char": share("n_upper", "word_chars"),
        "dup_lines_per_line": share("n_dup_lines", "n_lines"),
    }


def leading(value: Column) -> Column:
    """``value`` with all but its seven leading binary digits set to zero."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - LEADING_BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(measures: DataFrame, m: str, keys: list[str]) -> DataFrame:
    """(keys, rate, bucket, n): counts of rounded rates. Sketches merge by adding counts.

    Documents that fail the base rule are no model for the others and stay out.
    """
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("rate"), leading(value).alias("bucket"))
            for name, value in rates(F.col(m)).items()
        ])
    ).alias("pair")
    return (
        measures.where(~base_failed(F.col(m))).select(*keys, pairs)
        .groupBy(*keys, "pair.rate", "pair.bucket").agg(F.count("*").alias("n"))
    )


def bounds(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rate, total, low, high) from a sketch: quartiles, and three times their
    distance beyond."""
    by = [*keys, "rate"]
    running = W.partitionBy(*by).orderBy("bucket")
    placed = counts.groupBy(*by, "bucket").agg(F.sum("n").alias("n")).select(
        *by, "bucket", F.sum("n").over(running).alias("upto"),
        F.sum("n").over(W.partitionBy(*by)).alias("total"),
    )

    def quartile(k: int) -> Column:
        return F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bucket")))

    quartiles = placed.groupBy(*by, "total").agg(
        *[quartile(k).alias(f"q{k}") for k in (1, 2, 3)]
    )
    least = reduce(lambda c, kv: c.when(F.col("rate") == kv[0], kv[1]), RATES.items(), F)
    spread = FENCE * F.greatest(F.col("q3") - F.col("q1"), F.floor(F.col("q2") / 4), least)
    return quartiles.select(
        *by, "total", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")
    )


def thresholds(measures: DataFrame, m: str, lang: str, source: str) -> DataFrame:
    """One row per language and source that occurs, with its bounds: l_<rate> and h_<rate>."""
    counts = sketch(
        measures.select(F.col(lang).alias("lang"), F.col(source).alias("source"), m), m, ["lang", "source"]
    )
    levels = [
        bounds(counts, keys).select(
            *keys, "rate", *[F.col(c).alias(f"{c}{i}") for c in ("total", "low", "high")]
        )
        for i, keys in enumerate((["lang", "source"], ["lang"], []))
    ]
    every = measures.select(F.col(lang).alias("lang"), F.col(source).alias("source")).distinct()
    every = every.select("*", F.explode(F.array(*map(F.lit, RATES))).alias("rate"))
    for i, level in enumerate(levels):
        keys = [k for k in ("lang", "source", "rate") if k in level.columns]
        right = level.select(*[F.col(c).alias(f"r_{c}" if c in keys else c) for c in level.columns])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys])
        every = every.join(right, on, "left").drop(*[f"r_{k}" for k in keys])

    def pick(side: str) -> Column:
        return F.coalesce(
            F.when(F.col("total0") >= MIN_GROUP, F.col(f"{side}0")),
            F.when(F.col("total1") >= MIN_GROUP, F.col(f"{side}1")),
            F.col(f"{side}2"),
        )

    picked = every.select("lang", "source", "rate", pick("low").alias("low"), pick("high").alias("high"))
    return picked.groupBy("lang", "source").agg(
        *[
            F.max(F.when(F.col("rate") == name, F.col(side))).alias(f"{side[0]}_{name}")
            for name in RATES for side in ("low", "high")
        ]
    )


def judged(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", measures: str = "measures", verdict: str = "kept") -> DataFrame:
    """``docs`` with a struct of measures and the verdict: base rule passed and all rates within bounds."""
    m = free_name(docs, "__m")
    rows = measured(docs, m, text_col)
    limits = stored(thresholds(rows, m, lang_col, source_col), "limits")
    few = limits.count() <= BROADCAST_GROUPS
    limits = limits.select(*[F.col(c).alias(f"__limit_{c}") for c in limits.columns])
    # So many groups are a few megabytes; more of them are joined as Spark sees fit.
    limits = F.broadcast(limits) if few else limits
    joined = rows.join(
        limits,
        F.col(lang_col).eqNullSafe(F.col("__limit_lang"))
        & F.col(source_col).eqNullSafe(F.col("__limit_source")),
        "left",
    )
    inside = reduce(
        lambda a, b: a & b,
        [
            F.coalesce(value.between(F.col(f"__limit_l_{name}"), F.col(f"__limit_h_{name}")), F.lit(True))
            for name, value in rates(F.col(m)).items()
        ],
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(m).alias(measures),
        (~base_failed(F.col(m)) & inside).alias(verdict),
    )
