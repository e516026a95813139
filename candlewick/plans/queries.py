"""The named queries: one per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.symbols import contract_fields, in_segment, normalized_day, ticker_fields
from candlewick.functions.ticks import accepted, decode_ticks, rejected
from candlewick.operators import features, filters, instruments, joins, merge, quality, summary
from candlewick.operators.indicators import (
    indicators,
    latest_candles,
    latest_indicators,
    moving_average,
    moving_average_by_place,
    price_totals,
)
from candlewick.operators.resample import arrival_candles, candles
from candlewick.operators.signals import of_type, scalping_signals, signal_counts, signal_rows
from candlewick.plans import mapping as m
from candlewick.sources import files, folders
from candlewick.streaming import channel_log

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns, as sums may be taken in another order elsewhere."""
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


def plain(df: DataFrame) -> DataFrame:
    """Strikes as doubles and dates as text, which every engine prints alike."""
    casts = {"strike_price": "double", "expiry_date": "string"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})


# -- indicators ------------------------------------------------------------------


def obv(spark, folder):
    return m.daily_indicators(spark, folder).select("time", "instrument_id", "obv")


def rsi_14(spark, folder):
    return rounded(m.daily_indicators(spark, folder).select("time", "instrument_id", "rsi"), rsi=6)


def tvi(spark, folder):
    return rounded(m.daily_indicators(spark, folder).select("time", "instrument_id", "tvi"), tvi=4)


def pvi(spark, folder):
    return rounded(m.daily_indicators(spark, folder).select("time", "instrument_id", "pvi"), pvi=6)


def pvt(spark, folder):
    return rounded(m.daily_indicators(spark, folder).select("time", "instrument_id", "pvt"), pvt=6)


def indicators_batch(spark, folder):
    return rounded(m.daily_indicators(spark, folder), rsi=6, tvi=4, pvi=6, pvt=6)


def indicators_trailing100(spark, folder):
    return rounded(latest_indicators(m.daily_candles(spark, folder)), rsi=6, tvi=4, pvi=6, pvt=6)


def moving_average_20(spark, folder):
    return moving_average(
        m.daily_candles(spark, folder), 20, counted=m.tick_count_frame(spark, folder)
    )


def moving_average_by_place_(spark, folder):
    """Moving averages by running totals, for two windows, as the SQL function gives them."""
    totals = price_totals(m.daily_candles(spark, folder))
    made = [moving_average_by_place(totals, n).withColumn("window_rows", F.lit(n)) for n in (5, 20)]
    return made[0].unionByName(made[1])


# -- candles ---------------------------------------------------------------------


def candles_event_time(spark, folder):
    return candles(m.event_ticks(spark, folder), 15, by=("symbol",))


def candles_1min(spark, folder):
    return candles(m.event_ticks(spark, folder), 60, by=("symbol",))


def candles_daily(spark, folder):
    return m.daily_candles(spark, folder)


def candles_arrival_order(spark, folder):
    return arrival_candles(m.event_ticks(spark, folder), 15)


def session_hours(spark, folder):
    ticks = m.event_ticks(spark, folder).select("seq", "symbol", "time", "close", "volume")
    return filters.first_two_hours(ticks)


def recency_filter(spark, folder):
    ticks = m.event_ticks(spark, folder).select("seq", "symbol", "time", "close")
    return filters.recent(ticks, "2024-01-15 12:00:00")


def retention(spark, folder):
    ticks = m.event_ticks(spark, folder).select("seq", "symbol", "time", "close")
    return filters.retained(ticks, m.AS_OF)


def candle_range(spark, folder):
    return filters.candle_range(m.daily_candles(spark, folder), 1, "1996-01-01", "1997-06-30")


# -- joins and top-n ---------------------------------------------------------------


def enriched_candles(spark, folder):
    view = joins.enriched_candles(
        m.carried_indicators(spark, folder),
        m.supplier_instruments(spark, folder),
    )
    return rounded(plain(view), rsi=6, tvi=4, pvi=6, pvt=6)


def enriched_candles_plain(spark, folder):
    return plain(
        joins.enriched_candles(
            m.daily_candles(spark, folder), m.supplier_instruments(spark, folder)
        )
    )


def _latest(spark, folder, **options):
    return rounded(
        plain(
            joins.latest(
                m.daily_candles(spark, folder),
                m.supplier_instruments(spark, folder),
                m.daily_indicators(spark, folder),
                **options,
            )
        ),
        rsi=6,
        tvi=4,
        pvi=6,
        pvt=6,
    )


def latest_n(spark, folder):
    return _latest(spark, folder)


def latest_n_symbol(spark, folder):
    return _latest(spark, folder, symbol="BANKNIFTY_20050PE-28MAR2024")


def latest_100_per_instrument(spark, folder):
    return latest_candles(m.daily_candles(spark, folder))


def unknown_symbols(spark, folder):
    """Events of users against the customers, taken as instruments."""
    ticks = m.event_ticks(spark, folder).select(
        "seq", "time", "close", F.concat(F.lit("user_"), F.col("user_id")).alias("symbol")
    )
    return joins.unknown_symbols(ticks, _known_customers(spark, folder))


def resolved_symbols(spark, folder):
    ticks = m.event_ticks(spark, folder).select(
        "seq", "time", "close", F.concat(F.lit("user_"), F.col("user_id")).alias("symbol")
    )
    return joins.resolve_symbols(ticks, _known_customers(spark, folder))


def _known_customers(spark, folder):
    """Customers as instruments whose symbols name every second user."""
    return m.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("instrument_id"),
        F.concat(F.lit("user_"), F.col("c_custkey") * 2).alias("symbol"),
    )


# -- signals and summary -------------------------------------------------------------


def _signals(spark, folder, **options):
    return rounded(
        scalping_signals(
            m.carried_indicators(spark, folder),
            None,
            m.supplier_instruments(spark, folder),
            counted=m.tick_count_frame(spark, folder),
            **options,
        ),
        rsi=6,
        tvi=4,
    )


def signals_all(spark, folder):
    return _signals(spark, folder, limit=None)


def signals_latest(spark, folder):
    return _signals(spark, folder)


def signals_symbol(spark, folder):
    return _signals(spark, folder, symbol="BANKNIFTY_20050PE-28MAR2024", limit=200)


def signal_type_counts(spark, folder):
    return signal_counts(
        scalping_signals(
            m.daily_candles(spark, folder),
            m.daily_indicators(spark, folder),
            m.supplier_instruments(spark, folder),
            counted=m.tick_count_frame(spark, folder),
            limit=None,
        )
    )


def _trending_signals(spark, folder):
    made = m.trending_candles(spark, folder)
    return rounded(
        scalping_signals(
            made, indicators(made, "1min"), m.supplier_instruments(spark, folder), limit=None,
            counted=m.tick_count_frame(spark, folder),
        ),
        rsi=6,
        tvi=4,
    )


def signals_trending(spark, folder):
    """Signals of candles in which all five kinds occur."""
    return _trending_signals(spark, folder)


def signal_counts_trending(spark, folder):
    return signal_counts(_trending_signals(spark, folder))


def signals_buy(spark, folder):
    return of_type(_trending_signals(spark, folder), "buy")


def signals_sell(spark, folder):
    return of_type(_trending_signals(spark, folder), "sell")


def signals_sink(spark, folder):
    """Signals in the layout of their table; the figures in ``extra`` are not rounded alike elsewhere."""
    return signal_rows(
        _trending_signals(spark, folder), m.supplier_instruments(spark, folder), filters.clock(m.AS_OF)
    ).drop("extra")


def market_summary(spark, folder):
    return rounded(
        plain(
            summary.market_summary(
                m.carried_indicators(spark, folder),
                None,
                m.supplier_instruments(spark, folder),
                all_data=True,
                counted=m.tick_count_frame(spark, folder),
            )
        ),
        rsi=6,
        tvi=4,
    )


def market_summary_export(spark, folder):
    return summary.exportable(market_summary(spark, folder))


# -- training data ---------------------------------------------------------------------


def _training(spark, folder):
    return features.training_set(
        m.carried_indicators(spark, folder), None, counted=m.tick_count_frame(spark, folder)
    )


ML_DIGITS = dict(rsi=6, tvi=4, pvi=6, pvt=6, price_change=8, volume_change=8, oi_change=8, rsi_change=6)


def ml_target(spark, folder):
    return _training(spark, folder).select("instrument_id", "time", "close", "future_price", "target")


def ml_training_set(spark, folder):
    """Infinite changes are kept in the set; a flag shows them, as they cannot be rounded."""
    made = _training(spark, folder)
    infinite = F.abs("oi_change") == F.lit(float("inf"))
    return rounded(
        made.withColumn("oi_infinite", infinite).withColumn(
            "oi_change", F.when(~infinite, F.col("oi_change"))
        ),
        **ML_DIGITS,
    )


def ml_features(spark, folder):
    return rounded(features.feature_matrix(_training(spark, folder)), **ML_DIGITS)


def ml_scaler(spark, folder):
    fitted = features.fit_scaler(features.feature_matrix(_training(spark, folder)))
    return rounded(fitted, mean=6, std=6)


def ml_scaler_train(spark, folder):
    """The scaler fitted on the train rows only."""
    matrix = features.feature_matrix(_training(spark, folder))
    return rounded(features.fit_scaler(features.fitting_rows(matrix, "train")), mean=6, std=6)


def ml_slice(spark, folder):
    """Training rows of the calls on one index; attributes that the set lacks are passed over."""
    named = joins.with_instruments(
        _training(spark, folder), m.supplier_instruments(spark, folder), "symbol", "option_type"
    )
    chosen = features.ml_slice(named, option_type="CE", strike_price=1)
    return chosen.select("instrument_id", "time", "symbol", "close", "target")


def latest_5000_per_instrument(spark, folder):
    return latest_candles(m.daily_candles(spark, folder), 5000)


def ml_scaled(spark, folder):
    matrix = features.feature_matrix(_training(spark, folder))
    return rounded(features.standardized(matrix), **{name: 6 for name in features.FEATURES})


def ml_split(spark, folder):
    matrix = features.feature_matrix(_training(spark, folder))
    return features.assign_split(matrix.select("instrument_id", "time", "target"))


# -- instruments -------------------------------------------------------------------------


def best_instrument(spark, folder):
    return instruments.best_instrument(
        m.supplier_instruments(spark, folder),
        m.daily_candles(spark, folder),
        m.daily_indicators(spark, folder),
    )


def preferred_instrument(spark, folder):
    return instruments.preferred_instrument(m.supplier_instruments(spark, folder))


def first_instrument(spark, folder):
    return instruments.first_instrument(m.supplier_instruments(spark, folder))


def underlying_list(spark, folder):
    return instruments.underlyings(m.supplier_instruments(spark, folder))


def contract_catalog(spark, folder):
    return plain(instruments.contract_catalog(m.supplier_instruments(spark, folder)))


def expiries(spark, folder):
    return plain(instruments.expiries(m.supplier_instruments(spark, folder), "NIFTY"))


def strikes(spark, folder):
    return plain(instruments.strikes(m.supplier_instruments(spark, folder), "BANKNIFTY", date(2024, 3, 28)))


def contract_slice(spark, folder):
    return instruments.contract_slice(
        m.supplier_instruments(spark, folder), "BANKNIFTY", date(2024, 3, 28), 20050, "PE"
    ).select("instrument_id", "symbol")


def _tickers(spark, folder):
    """Vendor tickers of every kind, well-formed or not, made from the parts."""
    key, size = F.col("p_partkey"), F.col("p_size")
    exchange = F.when(size % 3 == 0, "NSE").when(size % 3 == 1, "BSE").otherwise("MCX")
    day = F.concat((size % 31 + 1).cast("string"), F.lit("MAR2024"))
    strike = F.when(key % 11 == 0, F.lit("n/a")).otherwise((key * 50).cast("string"))
    brand = F.upper(F.regexp_replace("p_brand", "#", ""))
    return m.table(spark, folder, "part").select(
        "p_partkey",
        F.when(
            key % 5 == 0,
            F.concat_ws("_", exchange, F.lit("OPTIDX"), brand, day, strike, F.lit("CE")),
        )
        .when(key % 5 == 1, F.concat_ws("_", exchange, F.lit("FUTIDX"), brand, day))
        .when(key % 5 == 2, F.concat_ws("_", exchange, F.lit("INDICES"), brand))
        .when(key % 5 == 3, F.concat_ws("_", exchange, F.lit("EQ"), brand, key.cast("string")))
        .otherwise(F.concat_ws("_", exchange, brand))
        .alias("ticker"),
    )


def ticker_parse(spark, folder):
    return plain(_tickers(spark, folder).withColumns(ticker_fields(F.col("ticker"))))


def symbol_regex_parse(spark, folder):
    return plain(m.supplier_symbols(spark, folder).withColumns(contract_fields(F.col("symbol"))))


def segment_filter(spark, folder):
    return instruments.relevant_tickers(_tickers(spark, folder), ["p_partkey"])


def segment_tickers(spark, folder):
    return _tickers(spark, folder).where(in_segment(F.col("ticker")))


def option_chain_expand(spark, folder):
    requests = m.table(spark, folder, "part").select(
        F.concat(F.upper(F.substring("p_name", 1, 3)), F.col("p_partkey")).alias("symbol"),
        F.lit("28MAR2024").alias("expiry"),
        (F.col("p_partkey") * 50).alias("low"),
        (F.col("p_partkey") * 50 + F.col("p_size") * 10).alias("high"),
    )
    return instruments.option_chain(requests)


def date_normalize(spark, folder):
    """Order dates written in the accepted spellings and in one that is not."""
    day, way = F.col("o_orderdate"), F.col("o_orderkey") % 5
    spelled = (
        F.when(way == 0, F.date_format(day, "ddMMMyyyy"))
        .when(way == 1, F.date_format(day, "dd-MMM-yyyy"))
        .when(way == 2, F.upper(F.date_format(day, "d-MMM-yyyy")))
        .when(way == 3, F.date_format(F.add_months(day, 96), "dd-MMM-yy"))
        .otherwise(F.date_format(day, "yyyy/MMM/dd"))
    )
    return m.table(spark, folder, "orders").select(
        "o_orderkey", spelled.alias("written"), normalized_day(spelled).alias("normalized")
    )


def _customer_instruments(spark, folder):
    """Customers as the instruments known so far."""
    return m.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("instrument_id"),
        F.concat(F.lit("NSE_EQ_"), F.col("c_custkey")).alias("symbol"),
        F.lit("index").alias("instrument_type"),
        F.lit(None).cast("string").alias("option_type"),
        F.lit(None).cast("decimal(18,4)").alias("strike_price"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def _order_tickers(spark, folder):
    """One ticker per order: known symbols for small keys, unseen ones beyond."""
    return m.table(spark, folder, "orders").select(
        F.concat(F.lit("NSE_EQ_"), F.col("o_custkey") * 2).alias("ticker")
    )


def instrument_upsert(spark, folder):
    return plain(instruments.upsert_instruments(
        _order_tickers(spark, folder), _customer_instruments(spark, folder), m.AS_OF
    ))


def instrument_get_or_create(spark, folder):
    return plain(instruments.get_or_create(
        _order_tickers(spark, folder).withColumnRenamed("ticker", "symbol"),
        _customer_instruments(spark, folder),
        m.AS_OF,
    ))


# -- ticks ---------------------------------------------------------------------------------


def _json_envelopes(spark, folder):
    """Events as JSON ticks: several time keys, some unreadable, some fields absent or bad."""
    way = F.col("event_id") % 6
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    price = F.col("value").cast("string")

    def quoted(key, value):
        return F.concat(F.lit(f'"{key}":"'), value, F.lit('"'))

    def bare(key, value):
        return F.concat(F.lit(f'"{key}":'), value)

    prices = F.concat_ws(",", *[bare(k, price) for k in ("open", "high", "low", "close")])
    k = F.get_json_object("props", "$.k")
    time, close = quoted("time", iso), bare("close", price)
    members = (
        F.when(way == 0, F.array(time, prices, quoted("volume", F.concat(k, F.lit(".7")))))
        .when(
            way == 1,
            F.array(
                quoted("time", F.lit("2020-01-01")),
                quoted("dt", F.concat(iso, F.lit("+05:30"))),
                prices,
                bare("oi", k),
            ),
        )
        .when(way == 2, F.array(time, quoted("dt", F.lit("soon")), prices))
        .when(way == 3, F.array(prices, bare("volume", k), quoted("oi", F.lit("9.9"))))
        .when(way == 4, F.array(quoted("timestamp", F.lit("2024-02-03 04:05:06")), close))
        .otherwise(F.array(time, quoted("open", F.lit("cheap")), close))
    )
    body = F.concat_ws(",", members)
    return m.table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        F.concat("event_type", F.lit(".x.JSON")).alias("channel"),
        F.concat(F.lit("{"), body, F.lit("}")).alias("data"),
        F.col("ts").alias("timestamp"),
    )


def json_tick_decode(spark, folder):
    return decode_ticks(_json_envelopes(spark, folder))


def channel_log_ticks(spark, folder):
    """The same ticks written as channel logs and taken from these by a stream, in slices."""
    root = f"{folders.shared(spark)}/channel-log-{uuid4().hex}"
    line = F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    _json_envelopes(spark, folder).select(line).write.text(f"{root}/log")
    ticks = decode_ticks(channel_log.envelopes(channel_log.log_lines(spark, f"{root}/log", slice_bytes=1 << 20)))
    sink = ticks.writeStream.format("parquet").option("path", f"{root}/ticks").option("checkpointLocation", f"{root}/state")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(ticks.schema).parquet(f"{root}/ticks")


def _csv_envelopes(spark, folder):
    """Events as positional ticks: unpadded clocks, absent interest, short and broken rows."""
    way = F.col("event_id") % 7
    price = F.col("value").cast("string")
    k = F.get_json_object("props", "$.k")
    clock = (F.hour("ts") * 100 + F.minute("ts")).cast("string")
    fields = F.concat_ws(
        ",",
        F.lit("x"),
        F.lit("y"),
        F.date_format("ts", "yyyyMMdd"),
        F.when(way == 3, F.lit("99x")).otherwise(clock),
        price,
        price,
        F.when(way == 4, F.lit("?")).otherwise(price),
        price,
        F.concat(k, F.lit(".9")),
    )
    return m.table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        F.concat("event_type", F.lit(".JSON")).alias("channel"),
        F.when(way == 0, F.concat(fields, F.lit(",")))
        .when(way == 1, fields)
        .otherwise(F.concat(fields, F.lit(","), k, F.lit(",tail")))
        .alias("data"),
        F.col("ts").alias("timestamp"),
    )


def csv_tick_decode(spark, folder):
    return accepted(decode_ticks(_csv_envelopes(spark, folder)))


def tick_quarantine(spark, folder):
    return rejected(decode_ticks(_csv_envelopes(spark, folder))).select("seq", "symbol", "reject_reason")


# -- writes, as the table they leave ------------------------------------------------------------


def _order_rows(spark, folder, standing: bool):
    """All orders as rows keyed by (month, customer): finished ones stand, the others come in."""
    finished = F.col("o_orderstatus") == "F"
    return (
        m.table(spark, folder, "orders")
        .where(finished if standing else ~finished)
        .select(
            F.date_trunc("MONTH", "o_orderdate").cast("timestamp_ntz").alias("time"),
            F.col("o_custkey").alias("instrument_id"),
            F.col("o_totalprice").alias("close"),
            F.col("o_orderkey").alias("seq"),
        )
    )


def _standing(spark, folder):
    return merge.last_version(_order_rows(spark, folder, True), merge.CANDLE_KEY, ("seq",))


def _incoming(spark, folder):
    return _order_rows(spark, folder, False)


def upsert_last_wins(spark, folder):
    return merge.upserted(
        _standing(spark, folder), _incoming(spark, folder), merge.CANDLE_KEY, ("seq",)
    )


def insert_ignore(spark, folder):
    standing = _standing(spark, folder)
    return standing.unionByName(
        merge.inserted(standing, _incoming(spark, folder), merge.CANDLE_KEY, ("seq",))
    )


def union_by_name(spark, folder):
    """Two tables of different columns under each other, absent columns null."""
    left = m.table(spark, folder, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.lit("customer").alias("__source_file"),
    )
    right = m.table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.lit("supplier").alias("__source_file"),
    )
    return left.unionByName(right, allowMissingColumns=True)


# -- files ------------------------------------------------------------------------------------


def _parsed(spark, folder):
    lines = m.candle_file_lines(spark, folder)
    return files.parse_candles(files.named_fields(files.with_headers(lines), files.CANDLE_FILE))


def historical_parse(spark, folder):
    """Candle files whose columns stand in different orders, one of them lacking a column."""
    return _parsed(spark, folder).drop("source_block")


def historical_file_counts(spark, folder):
    return files.file_counts(_parsed(spark, folder))


def historical_import_counts(spark, folder):
    return files.import_counts(_parsed(spark, folder))


def historical_whole_files(spark, folder):
    """Rows of files that hold no unusable row, were there a file for each supplier and day."""
    parsed = _parsed(spark, folder)
    by_day = parsed.withColumn("source_file", F.concat_ws("/", "symbol", F.to_date("time")))
    return files.whole_files(by_day).select("symbol", "time", "open", "close", "source_row")


def combine_by_header(spark, folder):
    """The files under each other by column name, but for the output's own file."""
    rows = files.combined_rows(m.candle_file_lines(spark, folder), "file_1.csv")
    names = ("Ticker", "Open", "Close", "Volume", "OI")
    return rows.select(
        *[F.col("row")[n].alias(n) for n in names], F.col("source_file").alias("__source_file"), "source_row"
    )


def ticker_list(spark, folder):
    lines = m.table(spark, folder, "part").select(
        F.concat(F.lit(" T"), "p_partkey", F.lit(", ,"), F.upper("p_type"), F.lit(",")).alias("value"),
        F.lit("tickers.txt").alias("source_file"),
        F.lit(0).alias("source_block"),
        F.col("p_partkey").alias("source_row"),
    )
    return files.split_tickers(lines).select("source_row", "source_column", "ticker")


def request_list(spark, folder):
    key = F.col("p_partkey")
    rows = m.table(spark, folder, "part").select(
        F.concat_ws(
            ",", (key * 50 + F.col("p_size") * 10).cast("string"), F.lit("28-Mar-2024"),
            F.concat(F.lit("S"), key), F.lit("01-Mar-24"), F.lit("28MAR2024"), (key * 50).cast("string"),
        ).alias("value"),
        key.alias("source_row"),
    )
    head = spark.createDataFrame([("High,Expiry,Symbol,StartDate,EndDate,Low", -1)], "value string, source_row long")
    lines = head.unionByName(rows).select(
        "value", "source_row", F.lit("in.csv").alias("source_path"), F.lit("in.csv").alias("source_file"),
        F.lit(0).cast("long").alias("source_block"),
    )
    return files.parse_requests(files.named_fields(files.with_headers(lines), files.REQUEST_FILE))


# -- data quality ------------------------------------------------------------------------------


def _tables(spark, folder):
    """All five tables: suppliers and their days, and events as the quick candles."""
    daily = m.daily_candles(spark, folder)
    quick = candles(m.event_ticks(spark, folder), 15, by=("user_id",)).withColumnRenamed(
        "user_id", "instrument_id"
    )
    signals = scalping_signals(
        daily,
        m.daily_indicators(spark, folder),
        m.supplier_instruments(spark, folder),
        limit=None,
        counted=m.tick_count_frame(spark, folder),
    )
    return {
        "instruments": m.supplier_instruments(spark, folder),
        "candle_data_1min": daily,
        "candle_data_15sec": quick,
        "technical_indicators": m.daily_indicators(spark, folder),
        "trading_signals": signal_rows(
            signals, m.supplier_instruments(spark, folder), filters.clock(m.AS_OF)
        ),
    }


def dq_counts(spark, folder):
    return quality.table_counts(_tables(spark, folder))


def dq_instrument_counts(spark, folder):
    return quality.instrument_counts(m.daily_candles(spark, folder))


def dq_timeframe_counts(spark, folder):
    return quality.timeframe_counts(m.daily_indicators(spark, folder))


def dq_completeness(spark, folder):
    return quality.completeness(m.daily_candles(spark, folder), m.daily_indicators(spark, folder))


def _timed(spark, folder):
    made = _tables(spark, folder)
    return {n: made[n] for n in ("candle_data_1min", "candle_data_15sec", "technical_indicators")}


def dq_freshness(spark, folder):
    return quality.freshness(_timed(spark, folder), m.AS_OF)


def dq_session_coverage(spark, folder):
    return quality.session_coverage(_timed(spark, folder))


def dq_partitions(spark, folder):
    return quality.time_ranges(_timed(spark, folder))


def dq_report(spark, folder):
    made = _tables(spark, folder)
    views = {"first_two_hours_data": filters.first_two_hours(made["candle_data_1min"])}
    return quality.report(made, views, m.AS_OF)


def dq_overall(spark, folder):
    return quality.overall(dq_report(spark, folder))


QUERIES: dict[str, Query] = {
    "obv": obv,
    "rsi_14": rsi_14,
    "tvi": tvi,
    "pvi": pvi,
    "pvt": pvt,
    "indicators_batch": indicators_batch,
    "indicators_trailing100": indicators_trailing100,
    "moving_average": moving_average_20,
    "moving_average_by_place": moving_average_by_place_,
    "candles_event_time": candles_event_time,
    "candles_1min": candles_1min,
    "candles_daily": candles_daily,
    "candles_arrival_order": candles_arrival_order,
    "session_hours": session_hours,
    "recency_filter": recency_filter,
    "retention": retention,
    "candle_range": candle_range,
    "enriched_candles": enriched_candles,
    "enriched_candles_plain": enriched_candles_plain,
    "latest_n": latest_n,
    "latest_n_symbol": latest_n_symbol,
    "latest_100_per_instrument": latest_100_per_instrument,
    "latest_5000_per_instrument": latest_5000_per_instrument,
    "unknown_symbols": unknown_symbols,
    "resolved_symbols": resolved_symbols,
    "scalping_signals": signals_all,
    "signals_latest": signals_latest,
    "signals_symbol": signals_symbol,
    "signal_counts": signal_type_counts,
    "signals_trending": signals_trending,
    "signal_counts_trending": signal_counts_trending,
    "signals_buy": signals_buy,
    "signals_sell": signals_sell,
    "signals_sink": signals_sink,
    "market_summary": market_summary,
    "market_summary_export": market_summary_export,
    "ml_target": ml_target,
    "ml_training_set": ml_training_set,
    "ml_features": ml_features,
    "ml_scaler": ml_scaler,
    "ml_scaler_train": ml_scaler_train,
    "ml_slice": ml_slice,
    "ml_scaled": ml_scaled,
    "ml_split": ml_split,
    "best_instrument": best_instrument,
    "preferred_instrument": preferred_instrument,
    "first_instrument": first_instrument,
    "underlying_list": underlying_list,
    "contract_catalog": contract_catalog,
    "expiries": expiries,
    "strikes": strikes,
    "contract_slice": contract_slice,
    "ticker_parse": ticker_parse,
    "symbol_regex_parse": symbol_regex_parse,
    "segment_filter": segment_filter,
    "segment_tickers": segment_tickers,
    "option_chain_expand": option_chain_expand,
    "date_normalize": date_normalize,
    "instrument_upsert": instrument_upsert,
    "instrument_get_or_create": instrument_get_or_create,
    "json_tick_decode": json_tick_decode,
    "channel_log_ticks": channel_log_ticks,
    "csv_tick_decode": csv_tick_decode,
    "tick_quarantine": tick_quarantine,
    "upsert_last_wins": upsert_last_wins,
    "insert_ignore": insert_ignore,
    "union_by_name": union_by_name,
    "historical_parse": historical_parse,
    "historical_file_counts": historical_file_counts,
    "historical_import_counts": historical_import_counts,
    "historical_whole_files": historical_whole_files,
    "combine_by_header": combine_by_header,
    "ticker_list": ticker_list,
    "request_list": request_list,
    "dq_counts": dq_counts,
    "dq_instrument_counts": dq_instrument_counts,
    "dq_timeframe_counts": dq_timeframe_counts,
    "dq_completeness": dq_completeness,
    "dq_freshness": dq_freshness,
    "dq_session_coverage": dq_session_coverage,
    "dq_partitions": dq_partitions,
    "dq_report": dq_report,
    "dq_overall": dq_overall,
}
