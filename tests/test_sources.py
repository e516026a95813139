from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from candlewick.operators.instruments import option_chain, relevant_tickers, upsert_instruments
from candlewick.schemas import CANDLES, INSTRUMENTS
from candlewick.sources.exports import read_split, to_csv, to_json, training_tables, validation_report
from candlewick.sources.files import (
    CANDLE_FILE,
    TICKER_ORDER,
    combine_csvs,
    file_counts,
    import_counts,
    named_fields,
    parse_candles,
    read_candle_csv,
    read_dataset,
    read_lines,
    read_requests,
    read_tickers,
    whole_files,
    with_headers,
)
from candlewick.sources.importing import import_candles
from candlewick.sources.store import Store
from helpers import assert_same_rows, candle_frame, random_candles

HEADER = "Ticker,Date,Time,Open,High,Low,Close,Volume,OI\n"
A, B = "AAA_22000CE-28MAR2024", "BBB"


@pytest.fixture
def folder(tmp_path):
    made = tmp_path / "csv"
    made.mkdir()
    (made / "a.csv").write_text(
        HEADER
        + f"{A},20240301,915,101.5,103,101,102.5,1200,5000\n"
        + f"{A},20240301,916,102.5,102.5,100,100.25,,\n"
        + f"{A},20240301,916,1,1,1,1,1,1\n"
    )
    (made / "b.csv").write_text(
        HEADER
        + f"{A},20240301,915,9,9,9,9,9,9\n"
        + f"{B},20240302,1015,1,2,0.5,1.5,3.9,2.9\n"
        + f"{B},20240302,1016,1,2,oops,1.5,3,2\n"
        + f"{B},2024030,1016,1,2,1,1.5,3,2\n"
    )
    (made / "combined_master.csv").write_text(HEADER + f"{A},20240301,917,1,1,1,1,1,1\n")
    return made


def test_candle_files(spark, folder):
    parsed = parse_candles(read_candle_csv(spark, str(folder))).orderBy("source_file", "source_row")
    rows = parsed.collect()
    assert len(rows) == 7
    first, second = rows[0], rows[1]
    assert first.time == datetime(2024, 3, 1, 9, 15)
    assert (first.open, first.high, first.low, first.close) == (101.5, 103.0, 101.0, 102.5)
    assert (first.volume, first.open_interest) == (1200, 5000)
    assert (second.volume, second.open_interest) == (0, None)
    assert (rows[4].volume, rows[4].open_interest) == (3, 2)
    assert [r.reject_reason for r in rows[5:]] == ["unreadable number", "unreadable time"]
    counts = {r.source_file: (r.accepted, r.rejected) for r in file_counts(parsed).collect()}
    assert counts == {"a.csv": (3, 0), "b.csv": (2, 2)}
    assert tuple(import_counts(parsed).first()) == (1, 1)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_quotes_blanks_and_headers_of_a_file(spark, tmp_path):
    (tmp_path / "q.csv").write_text('\ufeffA,"B",C\n\n  \n"x,1",say ""no"",\n1,2\n')
    rows = with_headers(read_lines(spark, str(tmp_path))).orderBy("source_row").collect()
    assert [r.header for r in rows] == [["A", "B", "C"]] * 2
    assert [r.fields for r in rows] == [["x,1", 'say "no"', ""], ["1", "2"]]


def test_lines_are_neither_sorted_nor_shuffled_for_their_headers(spark):
    """Of lines that are too many to be broadcast by their size; all of a file would meet in one task."""
    lines = spark.range(10**9).select(
        F.concat_ws(",", "id", F.lit("x")).alias("value"), F.lit("a").alias("source_path"),
        F.lit("a").alias("source_file"), F.lit(0).cast("long").alias("source_block"), F.col("id").alias("source_row"),
    )
    plan = _plan(with_headers(lines))
    assert "SortMergeJoin" not in plan and "min_by" not in plan
    assert plan.count("concat_ws") == 2


def test_import_keeps_the_first_row_of_a_key(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    import_candles(store, str(folder), as_of="2024-04-01")
    named = {r.symbol: r for r in store.instruments().collect()}
    assert set(named) == {A, B}
    assert str(named[A].expiry_date) == "2024-03-28" and named[A].instrument_type == "option"
    rows = {(r.instrument_id, r.time.minute): r for r in store.candles().collect()}
    ids = {symbol: row.instrument_id for symbol, row in named.items()}
    assert set(rows) == {(ids[A], 15), (ids[A], 16), (ids[B], 15)}
    assert rows[ids[A], 15].open == 101.5 and rows[ids[A], 16].open == 102.5
    before = store.candles().orderBy("instrument_id", "time").collect()
    import_candles(store, str(folder), as_of="2025-01-01")
    assert store.candles().orderBy("instrument_id", "time").collect() == before
    assert {r.symbol: r for r in store.instruments().collect()} == named


def test_the_search_for_broken_files_reads_each_line_once(spark, folder):
    parsed = parse_candles(named_fields(with_headers(read_lines(spark, str(folder))), CANDLE_FILE))
    whole = whole_files(parsed)
    assert {r.source_file for r in whole.collect()} == {"a.csv", "combined_master.csv"}
    # Of the lines, for the rows and for the search, and of their headers, each with and without quotes.
    assert _plan(whole_files(parsed)).count("split(") <= 8


def test_import_of_whole_files_only(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    import_candles(store, str(folder), only_whole_files=True)
    assert [r.symbol for r in store.instruments().collect()] == [A]
    assert store.candles().count() == 2


def test_combine_aligns_columns_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("A,B\n1,2\n3,4\n")
    (tmp_path / "y.csv").write_text("B,C\n5,6\n")
    (tmp_path / "combined_master.csv").write_text("A,B\n9,9\n")
    got = combine_csvs(spark, str(tmp_path))
    assert sorted(got.columns) == ["A", "B", "C", "__source_file"]
    rows = {tuple(r) for r in got.select("A", "B", "C", "__source_file").collect()}
    assert rows == {("1", "2", None, "x.csv"), ("3", "4", None, "x.csv"), (None, "5", "6", "y.csv")}


def test_ticker_lists(spark, tmp_path):
    path = tmp_path / "tickers.txt"
    path.write_text("NSE_B, ,MCX_C\n\n BSE_A ,NSE_D,\nNSE_A\n")
    tickers = read_tickers(spark, str(path))
    assert sorted(r.ticker for r in tickers.collect()) == ["BSE_A", "MCX_C", "NSE_A", "NSE_B", "NSE_D"]
    chosen = relevant_tickers(tickers, list(TICKER_ORDER), 3)
    assert [r.ticker for r in chosen.orderBy(*TICKER_ORDER).collect()] == ["NSE_B", "BSE_A", "NSE_D"]


def test_request_lists(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "Symbol,StartDate,EndDate,Expiry,Low,High\n"
        "AAA,01-Mar-24,28MAR2024,28-Mar-2024,22000,22100\n"
        "BBB,01-Mar-24,28MAR2024,28-Mar-2024,10,9\n"
    )
    rows = read_requests(spark, str(path))
    assert [r.symbol for r in read_requests(spark, str(path), head=1).collect()] == ["AAA"]
    first = rows.where("symbol = 'AAA'").first()
    assert tuple(first) == ("AAA", "01MAR2024", "28MAR2024", "28MAR2024", 22000, 22100)
    chain = option_chain(rows).orderBy("contract").collect()
    assert [r.contract for r in chain] == [
        f"AAA28MAR2024{s}{t}" for s in (22000, 22050, 22100) for t in ("CE", "PE")
    ]


def test_exports_read_back(spark, tmp_path):
    frame = candle_frame(spark, random_candles(1, {1: 20}))
    to_csv(frame, str(tmp_path / "c"))
    assert_same_rows(read_dataset(spark, str(tmp_path / "c"), CANDLES), frame, ["time"])
    to_json(frame, str(tmp_path / "j"))
    line = spark.read.text(str(tmp_path / "j")).orderBy("value").first().value
    assert '"time":"2024-03-01T09:15:' in line
    assert_same_rows(spark.read.schema(CANDLES).json(str(tmp_path / "j")), frame, ["time"])


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    made.append("candle_data_1min", candle_frame(spark, random_candles(2, {1: 60, 2: 60})))
    return made


def test_upsert_is_idempotent_and_the_last_row_wins(spark, store):
    old = store.candles().orderBy("time", "instrument_id").collect()
    again, fresh = old[3], old[-1]
    batch = spark.createDataFrame(
        [
            (again.time, again.instrument_id, 1.0, 2),
            (again.time, again.instrument_id, 5.0, 9),
            (fresh.time.replace(year=2030), 7, 3.0, 1),
        ],
        "time timestamp_ntz, instrument_id bigint, close double, seq bigint",
    )
    for _ in range(2):
        store.upsert_candles(batch, "1min")
        rows = store.candles().collect()
        assert len(rows) == len(old) + 1
        found = {(r.time, r.instrument_id): r for r in rows}
        assert found[again.time, again.instrument_id].close == 5.0
        assert found[fresh.time.replace(year=2030), 7].close == 3.0
        for row in old[:3] + old[4:]:
            assert found[row.time, row.instrument_id] == row


def test_insert_ignore_never_changes_rows(spark, store):
    old = {(r.time, r.instrument_id): r for r in store.candles().collect()}
    key = next(iter(old))
    batch = spark.createDataFrame(
        [(key[0], key[1], -1.0, 1), (key[0].replace(year=2031), 9, 4.0, 2), (key[0].replace(year=2031), 9, 5.0, 3)],
        "time timestamp_ntz, instrument_id bigint, close double, seq bigint",
    )
    for _ in range(2):
        store.insert_ignore("candle_data_1min", batch, ("time", "instrument_id"), ("seq",))
        found = {(r.time, r.instrument_id): r for r in store.candles().collect()}
        assert len(found) == store.candles().count() == len(old) + 1
        assert all(found[k] == row for k, row in old.items())
        assert found[key[0].replace(year=2031), 9].close == 4.0


def test_range_scan_prunes_days(store):
    times = sorted(r.time for r in store.candles().where("instrument_id = 1").collect())
    got = store.candle_range(1, times[5], times[20])
    assert [r.time for r in got.collect()] == times[5:21]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_retention_drops_folders_and_cuts_the_boundary_day(spark, store):
    rows = store.candles().collect()
    times = sorted({r.time for r in rows})
    as_of = times[len(times) // 2]
    store.retain("candle_data_1min", days=0, as_of=as_of)
    left = store.candles().collect()
    assert sorted(left, key=lambda r: (r.time, r.instrument_id)) == sorted(
        [r for r in rows if r.time >= as_of], key=lambda r: (r.time, r.instrument_id)
    )


def test_views(spark, store):
    store.replace(
        "instruments",
        spark.createDataFrame([(1, "A", "stock", None, None, None, None), (2, "B", "stock", None, None, None, None)], INSTRUMENTS),
    )
    from candlewick.operators.indicators import indicators

    store.upsert_indicators(indicators(store.candles()))
    store.register_views()
    n = store.candles().count()
    assert spark.table("scalping_data").count() == n
    assert len(spark.table("scalping_data").columns) == 16
    assert spark.table("market_summary").count() == n - 2
    hours = [r.h for r in spark.sql("SELECT DISTINCT hour(time) h FROM first_two_hours_data").collect()]
    assert set(hours) <= {9, 10}
    store.upsert_indicators(indicators(store.candles()))
    assert store.indicators().count() == n


def test_instrument_upsert(spark):
    known = spark.createDataFrame(
        [(4, "NSE_EQ_A", None, None, None, None, datetime(2020, 1, 1)), (9, "OLD", "index", None, None, None, datetime(2020, 1, 1))],
        INSTRUMENTS,
    )
    tickers = spark.createDataFrame([("NSE_EQ_A",), ("BSE_FUTIDX_Z_28MAR2024",), ("NSE_EQ_B",), ("NSE_EQ_B",)], "ticker string")
    rows = {r.symbol: r for r in upsert_instruments(tickers, known, "2024-01-31").collect()}
    assert len(rows) == 4
    assert rows["OLD"] == known.where("symbol = 'OLD'").first()
    assert rows["NSE_EQ_A"].instrument_id == 4 and rows["NSE_EQ_A"].instrument_type == "stock"
    assert rows["NSE_EQ_A"].updated_at == datetime(2024, 1, 31)
    assert {rows["BSE_FUTIDX_Z_28MAR2024"].instrument_id, rows["NSE_EQ_B"].instrument_id} == {10, 11}


def test_training_tables(spark, tmp_path):
    from candlewick.operators.features import FEATURES, feature_matrix, training_set
    from candlewick.operators.indicators import indicators

    frame = candle_frame(spark, random_candles(6, {1: 200, 2: 150}, gappy=False))
    matrix = feature_matrix(training_set(frame, indicators(frame)))
    training_tables(matrix, str(tmp_path / "ml"))
    train, test = (read_split(spark, str(tmp_path / "ml"), s) for s in ("train", "test"))
    assert train.count() + test.count() == matrix.count()
    assert 0.1 < test.count() / matrix.count() < 0.3
    names = [r.feature for r in spark.read.parquet(str(tmp_path / "ml/features")).orderBy("position").collect()]
    assert names == list(FEATURES)
    assert spark.read.parquet(str(tmp_path / "ml/scaler")).count() == 2 * len(FEATURES)
    both = train.unionByName(test).groupBy("instrument_id").agg(F.avg("close").alias("m"), F.stddev_pop("close").alias("s"))
    for row in both.collect():
        assert abs(row.m) < 1e-9 and abs(row.s - 1) < 1e-9


def test_report_export(spark, tmp_path):
    rows = spark.createDataFrame([("s", "c", "PASSED", "d")], "section string, check string, status string, detail string")
    validation_report(rows, str(tmp_path / "r"))
    got = {r.section: r.status for r in spark.read.csv(str(tmp_path / "r"), header=True).collect()}
    assert got == {"s": "PASSED", "Overall": "PASSED"}
