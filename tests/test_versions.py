"""Tables as logs of versions, against the upsert of whole tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick.operators import merge
from candlewick.schemas import CANDLES
from candlewick.sources import folders
from candlewick.sources.store import Store

START = datetime(2024, 1, 1, 10)
NAME = "candle_data_1min"


def batch_of(spark, draw, n, days=3):
    rows = [
        (START + timedelta(days=draw.randrange(days), minutes=draw.randrange(40)), draw.randrange(5), float(draw.randrange(1000)), i)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "time timestamp_ntz, instrument_id long, close double, seq long")
    return df.withColumns({c: F.lit(1.0) for c in ("open", "high", "low")}).withColumns(
        {c: F.lit(2).cast("long") for c in ("volume", "open_interest")}
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*CANDLES.names).collect())


def test_upserts_and_inserts_equal_whole_tables(spark, tmp_path):
    """Any order of upserts, inserts, compaction and clearing reads like the whole-table operators."""
    draw = random.Random(1)
    store = Store(spark, str(tmp_path / "store"), compact_every=7)
    want = spark.createDataFrame([], CANDLES)
    for step in range(20):
        batch = batch_of(spark, draw, 30)
        if step % 3 == 2:
            store.insert_ignore(NAME, batch, merge.CANDLE_KEY, ("seq",))
            want = want.unionByName(merge.inserted(want, batch, merge.CANDLE_KEY, ("seq",)))
        else:
            store.upsert_candles(batch, "1min")
            want = merge.upserted(want, batch, merge.CANDLE_KEY, ("seq",))
        want = spark.createDataFrame(want.collect(), CANDLES)
        if step == 8:
            store.compact(NAME)
        if step == 12:
            store.vacuum(NAME)
        if step % 4 == 0 or step > 16:
            assert rows_of(store.candles()) == rows_of(want)
    before = rows_of(store.candles())
    store.compact(NAME)
    assert rows_of(store.candles()) == before and store.table(NAME).changes_held() == 0
    store.vacuum(NAME)
    assert rows_of(store.candles()) == before
    assert len(folders.names(spark, f"{store.path(NAME)}/changes")) == 0


def test_bytes_written_follow_the_batch(spark, tmp_path):
    draw = random.Random(2)
    store = Store(spark, str(tmp_path / "store"))
    big = spark.range(60_000).select(
        (F.lit(START) + F.make_dt_interval(mins=F.col("id") % 300)).alias("time"), (F.col("id") / 300).cast("long").alias("instrument_id"),
        *[F.rand(1).alias(c) for c in ("open", "high", "low", "close")],
        *[F.col("id").alias(c) for c in ("volume", "open_interest")],
    )
    store.upsert_candles(big, "1min", order=("time",))
    whole = folders.size(spark, store.path(NAME))
    steps = []
    for _ in range(20):
        before = folders.size(spark, store.path(NAME))
        store.upsert_candles(batch_of(spark, draw, 50, days=1), "1min")
        steps.append(folders.size(spark, store.path(NAME)) - before)
    assert max(steps) < whole / 20 and max(steps) < 2 * min(steps)
    assert store.candles().count() == 60_000


def test_repeated_batches_and_days_without_changes(spark, tmp_path):
    draw = random.Random(3)
    store = Store(spark, str(tmp_path / "store"))
    batch = batch_of(spark, draw, 100)
    store.upsert_candles(batch, "1min")
    store.compact(NAME)
    first = rows_of(store.candles())
    store.upsert_candles(batch.where(F.col("time") < F.lit(START + timedelta(days=1))), "1min")
    assert rows_of(store.candles()) == first
    # A filter on the day reaches the files of rows and of changes alike.
    plan = store.table(NAME).read().where(F.col("date") == "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(date") >= 3


def test_lost_writers_leave_nothing_to_read(spark, tmp_path):
    draw = random.Random(4)
    store = Store(spark, str(tmp_path / "store"))
    store.upsert_candles(batch_of(spark, draw, 50), "1min")
    first = rows_of(store.candles())
    table = store.table(NAME)
    dated = batch_of(spark, draw, 50).drop("seq").dropDuplicates(["time", "instrument_id"]).withColumn("date", F.to_date("time"))

    def fail(*_):
        raise RuntimeError("lost")

    table._commit = fail
    for write in (table.append, table.change, table.replace):
        with pytest.raises(RuntimeError):
            write(dated.select(*CANDLES.names, "date"))
    assert rows_of(store.candles()) == first
    held = store.candles()
    store.replace(NAME, store.candles().where("instrument_id > 1"))
    assert rows_of(held) == first  # those who listed the old files still read them
    store.vacuum(NAME)
    left = [r for r in first if r[1] > 1]
    assert rows_of(store.candles()) == left
    store.upsert_candles(batch_of(spark, draw, 5), "1min")
    assert len(rows_of(store.candles())) >= len(left)


def test_instruments_are_appended(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    symbols = spark.createDataFrame([("NIFTY_22000CE-28MAR2024",), ("ACME",)], "symbol string")
    store.create_instruments(symbols, "2024-01-01")
    first = sorted(store.instruments().collect())
    size = folders.size(spark, store.path("instruments"))
    store.create_instruments(symbols, "2024-02-01")
    assert folders.size(spark, store.path("instruments")) == size
    assert sorted(store.instruments().collect()) == first
    store.create_instruments(symbols.unionByName(spark.createDataFrame([("NEW",)], "symbol string")))
    assert sorted(r.instrument_id for r in store.instruments().collect()) == [1, 2, 3]
    tickers = spark.createDataFrame([("ACME",), ("NSE_EQ_X",)], "ticker string")
    for _ in range(2):
        store.upsert_instruments(tickers, "2024-03-01")
        found = {r.symbol: r for r in store.instruments().collect()}
        assert sorted(r.instrument_id for r in found.values()) == [1, 2, 3, 4]
        assert found["ACME"].updated_at == datetime(2024, 3, 1) and found["NEW"].instrument_id == 3
    store.compact("instruments")
    assert {r.symbol: r for r in store.instruments().collect()} == found


def test_the_newest_rows_read_few_days(spark, tmp_path):
    from candlewick.operators.joins import latest

    draw = random.Random(5)
    store = Store(spark, str(tmp_path / "store"))
    store.create_instruments(spark.createDataFrame([(f"S{i}",) for i in range(5)], "symbol string"))
    store.upsert_candles(batch_of(spark, draw, 4000, days=40), "1min")
    for options in ({"limit": 20}, {"limit": 20, "symbol": "S3"}, {"limit": 100_000}):
        got = store.latest(**options)
        want = latest(store.candles(), store.instruments(), store.indicators(), **options)
        assert got.collect() == want.collect()
    few = [f for f in store.latest(20).inputFiles() if NAME in f]
    every = [f for f in store.candles().inputFiles() if NAME in f]
    assert len(few) <= 2 < len(every)
