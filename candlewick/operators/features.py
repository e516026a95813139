"""Training set, feature matrix, scaling and split, for every instrument in one plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numbers import clip, micros, relative_change
from candlewick.operators.indicators import full_average
from candlewick.operators.joins import with_indicators
from candlewick.operators.series import Running, open_series
from candlewick.schemas import INDICATOR_COLUMNS

# The feature list in its order, the horizon, the clip bound and the split.
FEATURES = (
    "open",
    "high",
    "low",
    "close",
    "volume",
    "open_interest",
    "tvi",
    "obv",
    "rsi",
    "pvi",
    "pvt",
    "price_change",
    "volume_change",
    "oi_change",
    "ma5",
    "ma20",
    "rsi_change",
)
HORIZON = 4
FEATURE_BOUND = 1e10
TEST_TENTHS = 2
SPLIT_SEED = 42

RAW = ("open", "high", "low", "close", "volume", "open_interest", *INDICATOR_COLUMNS)


def training_set(
    candles: DataFrame,
    indicators: DataFrame | None,
    timeframe: str = "1min",
    counted: DataFrame | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Candles with indicators, target and derived features; rows with any undefined value go.

    The target says whether the close four candles on is higher. A change from a zero
    base is infinite and is kept here; :func:`feature_matrix` removes it. Candles that carry their
    indicators need no second table.
    """
    joined = with_indicators(candles, indicators, timeframe, how="inner").select(
        "time", "instrument_id", *RAW
    )
    series = open_series(
        joined,
        before=19,
        after=HORIZON,
        counted=candles if counted is None else counted,
        rows_per_slice=rows_per_slice,
    )
    # A missing open interest is bridged: the change counts from the last known one.
    frame = series.running(
        series.frame, _oi0=Running("last", F.col("open_interest"), before_row=True)
    )
    close, window = F.col("close"), series.window
    framed = series.close(
        frame.select(
            "*",
            F.lead("close", HORIZON).over(window).alias("future_price"),
            F.lag("close").over(window).alias("_close0"),
            F.lag("volume").over(window).alias("_volume0"),
            F.lag("rsi").over(window).alias("_rsi0"),
            full_average(close, series, 5).alias("ma5"),
            full_average(close, series, 20).alias("ma20"),
        )
    )
    return framed.select(
        "instrument_id",
        "time",
        *RAW,
        "future_price",
        (F.col("future_price") > close).cast("int").alias("target"),
        relative_change(close, F.col("_close0")).alias("price_change"),
        relative_change(F.col("volume"), F.col("_volume0")).alias("volume_change"),
        relative_change(F.col("open_interest"), F.col("_oi0")).alias("oi_change"),
        "ma5",
        "ma20",
        (F.col("rsi") - F.col("_rsi0")).alias("rsi_change"),
    ).dropna()


def feature_matrix(training: DataFrame) -> DataFrame:
    """(instrument_id, time, target, 17 features): finite rows only, clipped."""
    # Null, NaN and both infinities all fail the one comparison. One test over an array
    # keeps the generated code small enough to be compiled to machine code.
    values = F.array(*[F.col(name).cast("double") for name in FEATURES])
    finite = F.forall(values, lambda value: F.abs(value) < F.lit(float("inf")))
    return training.where(finite).select(
        "instrument_id",
        "time",
        "target",
        *[clip(F.col(name).cast("double"), FEATURE_BOUND).alias(name) for name in FEATURES],
    )


def fit_scaler(features: DataFrame) -> DataFrame:
    """One row per instrument and feature: mean and population standard deviation."""
    fitted = features.groupBy("instrument_id").agg(
        *[
            F.struct(
                F.avg(name).alias("mean"), F.stddev_pop(name).alias("std")
            ).alias(name)
            for name in FEATURES
        ]
    )
    return fitted.select(
        "instrument_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature"),
                        F.col(name)["mean"].alias("mean"),
                        F.col(name)["std"].alias("std"),
                    )
                    for name in FEATURES
                ]
            )
        ),
    )


def _by_position(scaler: DataFrame) -> DataFrame:
    """One row per instrument: its (mean, divisor) pairs in feature order."""
    place = F.array_position(F.array(*[F.lit(name) for name in FEATURES]), F.col("feature"))
    divisor = F.when(F.col("std") == 0, 1.0).otherwise(F.col("std"))
    pairs = F.struct(place.alias("place"), F.col("mean"), divisor.alias("divisor"))
    return scaler.groupBy("instrument_id").agg(F.sort_array(F.collect_list(pairs)).alias("_fit"))


def scale(features: DataFrame, scaler: DataFrame) -> DataFrame:
    """Features minus mean over deviation, by instrument; a zero deviation divides by one."""
    joined = features.join(_by_position(scaler), "instrument_id")
    fit = F.col("_fit")
    return joined.select(
        "instrument_id",
        "time",
        "target",
        *[
            ((F.col(name) - fit[i]["mean"]) / fit[i]["divisor"]).alias(name)
            for i, name in enumerate(FEATURES)
        ],
    )


def standardized(features: DataFrame, fit_on: str = "all") -> DataFrame:
    """Features scaled by their own scaler.

    A matrix that comes from windows lies by instrument, so neither the fit nor the join shuffles it; both
    read the one shuffle below the windows.
    """
    return scale(features, fit_scaler(fitting_rows(features, fit_on)))


def daily_moments(features: DataFrame) -> DataFrame:
    """(time, instrument_id, feature, n, mean, m2) of each day: what a scaler needs, and merges.

    ``m2`` is the sum of squared deviations from the day's mean.
    """
    day = F.date_trunc("DAY", "time").cast("timestamp_ntz").alias("time")
    summed = features.groupBy(day, "instrument_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.struct(F.avg(name).alias("mean"), F.var_pop(name).alias("variance")).alias(name) for name in FEATURES],
    )
    each = F.array(*[
        F.struct(
            F.lit(name).alias("feature"), F.col("n"), F.col(name)["mean"].alias("mean"),
            (F.col(name)["variance"] * F.col("n")).alias("m2"),
        )
        for name in FEATURES
    ])
    return summed.select("time", "instrument_id", F.inline(each))


def scaler_of_moments(moments: DataFrame) -> DataFrame:
    """As :func:`fit_scaler`, from daily moments merged pair by pair in the order of the days.

    An instrument has one row a day and feature, so what is gathered follows its calendar, not its rows.
    """
    days = F.array_sort(F.collect_list(F.struct("time", "n", "mean", "m2"))).alias("days")

    def merged(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        )

    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    total = F.aggregate("days", none, merged)
    return moments.groupBy("instrument_id", "feature").agg(days).select(
        "instrument_id", "feature", total.alias("_all")
    ).select(
        "instrument_id", "feature", F.col("_all.mean").alias("mean"), F.sqrt(F.col("_all.m2") / F.col("_all.n")).alias("std")
    )


def split_tenth(seed: int = SPLIT_SEED) -> Column:
    """0..9, drawn from a hash of seed, instrument and time, so reruns agree."""
    text = F.concat_ws(
        "|", F.lit(str(seed)), F.col("instrument_id").cast("string"), micros(F.col("time")).cast("string")
    )
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(10))


def assign_split(features: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``split``: about 80 percent train, 20 percent test."""
    return features.withColumn(
        "split", F.when(split_tenth(seed) < TEST_TENTHS, "test").otherwise("train")
    )


def fitting_rows(features: DataFrame, fit_on: str = "all", seed: int = SPLIT_SEED) -> DataFrame:
    """The rows a scaler is fitted on: all of them, or the train rows only."""
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    if fit_on == "all":
        return features
    return assign_split(features, seed).where(F.col("split") == "train").drop("split")


def ml_slice(dataset: DataFrame, **contract) -> DataFrame:
    """Filter on those of symbol, expiry_date, strike_price and option_type the dataset has."""
    tests = [F.col(name) == value for name, value in contract.items() if name in dataset.columns]
    return dataset.where(reduce(lambda a, b: a & b, tests)) if tests else dataset
