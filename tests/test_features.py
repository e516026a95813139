from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators.features import (
    FEATURES,
    assign_split,
    feature_matrix,
    fit_scaler,
    fitting_rows,
    ml_slice,
    scale,
    standardized,
    training_set,
)
from candlewick.operators.indicators import indicators
from helpers import candle_frame, random_candles


@pytest.fixture(scope="module")
def data(spark):
    rows = random_candles(12, {1: 150, 2: 90, 3: 20}, gappy=False)
    frame = candle_frame(spark, rows).cache()
    return frame, indicators(frame).cache()


def by_hand(candles: pd.DataFrame, readings: pd.DataFrame) -> pd.DataFrame:
    """The training set of one instrument in pandas, row by row where that is clearer."""
    df = candles.merge(readings, on=["time", "instrument_id"]).sort_values("time").reset_index(drop=True)
    df["future_price"] = df["close"].shift(-4)

    def change(values):
        out, prev = [], None
        for v in values:
            missing = v is None or (isinstance(v, float) and math.isnan(v))
            if prev is None or missing:
                out.append(np.nan)
            elif prev == 0:
                out.append(np.inf if v > 0 else np.nan)
            else:
                out.append(v / prev - 1)
            prev = prev if missing else v
        return out

    df["price_change"] = change(df["close"])
    df["volume_change"] = change(df["volume"])
    df["oi_change"] = change(df["open_interest"])
    df["ma5"] = df["close"].rolling(5).mean()
    df["ma20"] = df["close"].rolling(20).mean()
    df["rsi_change"] = df["rsi"].diff()
    df["target"] = (df["future_price"] > df["close"]).astype(int)
    return df.dropna()


def test_training_set(data):
    candles, readings = data
    got = training_set(candles, readings).toPandas()
    c, r = candles.toPandas(), readings.drop("timeframe").toPandas()
    assert np.isinf(got["oi_change"]).any()
    for instrument in (1, 2, 3):
        want = by_hand(c[c.instrument_id == instrument], r[r.instrument_id == instrument])
        mine = got[got.instrument_id == instrument].sort_values("time").reset_index(drop=True)
        assert list(mine["time"]) == list(want["time"])
        for name in (*FEATURES, "future_price", "target"):
            np.testing.assert_allclose(
                mine[name].to_numpy(float), want[name].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=name
            )


def test_feature_matrix_is_finite_and_clipped(spark, data):
    made = training_set(*data)
    matrix = feature_matrix(made)
    finite = made.where(" AND ".join(f"abs({f}) < double('inf')" for f in FEATURES))
    assert 0 < matrix.count() == finite.count() < made.count()
    wild = made.limit(1).withColumn("tvi", F.lit(-9e12))
    assert feature_matrix(wild.withColumn("oi_change", F.lit(0.0)).withColumn("volume_change", F.lit(0.0))).first().tvi == -1e10


def test_scaling(data):
    matrix = feature_matrix(training_set(*data))
    scaled = scale(matrix, fit_scaler(matrix)).toPandas()
    plain = matrix.toPandas()
    for instrument, part in plain.groupby("instrument_id"):
        mine = scaled[scaled.instrument_id == instrument].sort_values("time")
        part = part.sort_values("time")
        for name in FEATURES:
            std = part[name].std(ddof=0) or 1.0
            np.testing.assert_allclose(mine[name], (part[name] - part[name].mean()) / std, rtol=1e-7, atol=1e-7)


def test_constant_features_scale_to_zero(data):
    matrix = feature_matrix(training_set(*data)).withColumn("ma5", F.lit(3.0))
    assert scale(matrix, fit_scaler(matrix)).where("ma5 <> 0").isEmpty()


def test_split_is_stable_and_about_a_fifth(data):
    matrix = feature_matrix(training_set(*data))
    first = assign_split(matrix).select("instrument_id", "time", "split")
    again = assign_split(matrix.repartition(7)).select("instrument_id", "time", "split")
    assert first.exceptAll(again).isEmpty()
    assert first.exceptAll(assign_split(matrix, seed=1).select("instrument_id", "time", "split")).count() > 0


def test_fit_on_train_only(data):
    matrix = feature_matrix(training_set(*data))
    scaler = fit_scaler(fitting_rows(matrix, "train"))
    train = assign_split(matrix).where("split = 'train'")
    want = {r.instrument_id: r.m for r in train.groupBy("instrument_id").agg(F.avg("close").alias("m")).collect()}
    got = {r.instrument_id: r["mean"] for r in scaler.where("feature = 'close'").collect()}
    assert got == pytest.approx(want)
    assert fitting_rows(matrix).count() == matrix.count()
    with pytest.raises(ValueError):
        fitting_rows(matrix, "test")


def test_slice_uses_only_columns_that_exist(spark):
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, target int")
    assert ml_slice(rows, symbol="B", strike_price=5).first().target == 2
    assert ml_slice(rows, option_type="CE").count() == 2


def test_moments_merge_to_the_scaler(spark):
    """Daily moments, also merged in parts, give the scaler of all rows; near-constant columns included."""
    from functools import reduce

    from candlewick.operators import features

    names = features.FEATURES
    rows = [
        (i % 3, f"2024-01-{1 + i % 9:02d} 10:{i % 60:02d}:00", *[1e9 + (i * (k + 1)) % 17 if k < 3 else float((i * k) % 23) for k in range(len(names))])
        for i in range(400)
    ]
    kinds = ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame(rows, f"instrument_id int, time string, {kinds}").withColumn("time", F.col("time").cast("timestamp_ntz"))
    want = {(r.instrument_id, r.feature): r for r in features.fit_scaler(df).collect()}
    days = [features.daily_moments(df.where(F.dayofmonth("time").isin(*part))) for part in ((1, 2, 3), (4,), (5, 6, 7, 8, 9))]
    got = features.scaler_of_moments(reduce(lambda a, b: a.unionByName(b), days)).collect()
    assert len(got) == len(want) == 3 * len(names)
    for r in got:
        other = want[r.instrument_id, r.feature]
        assert abs(r["mean"] - other["mean"]) <= 1e-9 * max(1, abs(other["mean"]))
        assert abs(r["std"] - other["std"]) <= 1e-6


def test_scaling_shuffles_no_matrix_that_lies_by_instrument(spark):
    columns = [F.rand(i).alias(name) for i, name in enumerate(FEATURES)]
    rows = spark.range(10**9).select((F.col("id") % 1000).alias("instrument_id"), F.col("id").alias("time"), F.lit(1).alias("target"), *columns)
    plan = standardized(rows.repartition("instrument_id"))._jdf.queryExecution().executedPlan().toString()
    # The two made above, which are one when the columns below are the same.
    assert plan.count("Exchange ") == 2 and "ENSURE_REQUIREMENTS" not in plan
