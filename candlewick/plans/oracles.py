"""Reference SQL for the named queries, for a single-node engine on the same tables."""

from __future__ import annotations

from candlewick.operators.features import FEATURES

CANDLE_TICKS = """
ticks AS (
  SELECT l_suppkey AS instrument_id, date_trunc('day', l_shipdate)::TIMESTAMP AS time,
         1000 + floor(l_extendedprice / 62.5) / 16 AS price, l_quantity::BIGINT AS volume,
         nullif(l_partkey % 100, 7) AS oi,
         (l_orderkey * 8 + l_linenumber) * 2097152 + l_partkey % 2097152 AS o
  FROM lineitem)"""

CANDLES = CANDLE_TICKS + """,
candles AS (
  SELECT time, instrument_id, arg_min(price, o) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, o) AS close, sum(volume)::BIGINT AS volume,
         arg_max_null(oi, o) AS open_interest
  FROM ticks GROUP BY time, instrument_id)"""


def indicator_steps(source: str, name: str) -> str:
    """CTEs ending in ``name``: the five indicators at every row of ``source``."""
    return f""",
{name}_a AS (
  SELECT *, close - lag(close) OVER w AS d, lag(close) OVER w AS pc, lag(volume) OVER w AS pv,
         row_number() OVER w AS rn,
         avg(close) OVER (w ROWS 9 PRECEDING) AS ca, avg(volume) OVER (w ROWS 9 PRECEDING) AS va
  FROM {source} WINDOW w AS (PARTITION BY instrument_id ORDER BY time)),
{name}_b AS (
  SELECT *, avg(greatest(coalesce(d, 0), 0)) OVER (w ROWS 13 PRECEDING) AS gain,
         avg(greatest(-coalesce(d, 0), 0)) OVER (w ROWS 13 PRECEDING) AS loss,
         CASE WHEN d > 0 THEN volume WHEN d < 0 THEN -volume ELSE 0 END AS obv_term,
         CASE WHEN rn >= 10 THEN (close - ca) * volume / nullif(va, 0) END AS tvi_term,
         d / nullif(pc, 0) * volume AS pvt_term,
         CASE WHEN volume > pv THEN coalesce(close / nullif(pc, 0), 1.0) ELSE 1.0 END AS pvi_factor
  FROM {name}_a WINDOW w AS (PARTITION BY instrument_id ORDER BY time)),
{name} AS (
  SELECT time, instrument_id, '1min' AS timeframe, rn,
         CASE WHEN tvi_term IS NOT NULL THEN sum(tvi_term) OVER w END AS tvi,
         (sum(obv_term) OVER w)::DOUBLE AS obv,
         CASE WHEN rn < 14 THEN NULL WHEN loss > 0 THEN 100 - 100 / (1 + gain / loss)
              WHEN gain > 0 THEN 100.0 END AS rsi,
         100 * product(pvi_factor) OVER w AS pvi,
         CASE WHEN pvt_term IS NOT NULL THEN sum(pvt_term) OVER w END AS pvt
  FROM {name}_b
  WINDOW w AS (PARTITION BY instrument_id ORDER BY time ROWS UNBOUNDED PRECEDING))"""


IND = indicator_steps("candles", "ind")

SHOWN = "round(tvi, 4) AS tvi, obv, round(rsi, 6) AS rsi, round(pvi, 6) AS pvi, round(pvt, 6) AS pvt"

SYMBOLS = """
symbols AS (
  SELECT s_suppkey AS instrument_id,
         CASE WHEN s_suppkey % 5 = 0 THEN s_name
              ELSE (CASE s_suppkey % 4 WHEN 0 THEN 'NIFTY' WHEN 1 THEN 'BANKNIFTY'
                                       WHEN 2 THEN 'FINNIFTY' ELSE 'ACME' END)
                   || '_' || (s_suppkey * 50 + 20000)::VARCHAR
                   || (CASE WHEN s_suppkey % 3 = 0 THEN 'CE' ELSE 'PE' END) || '-28MAR2024' END AS symbol
  FROM supplier)"""

INSTRUMENTS = SYMBOLS + """,
instruments AS (
  SELECT instrument_id, symbol,
         CASE WHEN contains(symbol, 'CE') OR contains(symbol, 'PE') THEN 'option' ELSE 'index' END
           AS instrument_type,
         CASE WHEN symbol LIKE '%-28MAR2024' THEN CASE WHEN instrument_id % 3 = 0 THEN 'CE' ELSE 'PE' END END
           AS option_type,
         CASE WHEN symbol LIKE '%-28MAR2024' THEN (instrument_id * 50 + 20000)::DOUBLE END
           AS strike_price,
         CASE WHEN symbol LIKE '%-28MAR2024' THEN '2024-03-28' END AS expiry_date
  FROM symbols)"""

ALL = "WITH" + CANDLES + IND + "," + INSTRUMENTS

EVENTS = """
ticks AS (
  SELECT *, shifted * 8 + shifted - event_id AS seq, nullif(volume, 13) AS oi
  FROM (SELECT event_id, user_id, event_type AS symbol, ts AS time, value AS price,
               CAST(props->>'$.k' AS BIGINT) AS volume,
               event_id + (event_id * 7) % 5 AS shifted FROM events))"""


def event_candles(seconds: int, by: str) -> str:
    return f"""SELECT {by}, time_bucket(INTERVAL '{seconds} seconds', time) AS time,
       arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, seq) AS close, sum(volume)::BIGINT AS volume,
       arg_max_null(oi, seq) AS open_interest
FROM ticks GROUP BY 1, 2"""


def one_indicator(name: str, digits: int | None) -> str:
    shown = f"round({name}, {digits}) AS {name}" if digits else name
    return f"WITH{CANDLES}{IND} SELECT time, instrument_id, {shown} FROM ind"


ENRICHED = """SELECT c.time, symbol, instrument_type, option_type, strike_price, open, high, low, close,
       volume, open_interest, """ + SHOWN + """
FROM candles c JOIN instruments i USING (instrument_id)
LEFT JOIN ind t ON c.time = t.time AND c.instrument_id = t.instrument_id AND t.timeframe = '1min'"""

SIGNALS = ALL + """,
framed AS (
  SELECT c.time, c.instrument_id, close, volume, rsi, obv, tvi,
         lag(obv) OVER w AS obv0, lag(rsi) OVER w AS rsi0,
         avg(close) OVER (w ROWS 4 PRECEDING) AS ma5, avg(close) OVER (w ROWS 19 PRECEDING) AS ma20,
         avg(volume) OVER (w ROWS 19 PRECEDING) AS avg_vol20
  FROM candles c LEFT JOIN ind t ON c.time = t.time AND c.instrument_id = t.instrument_id
  WINDOW w AS (PARTITION BY c.instrument_id ORDER BY c.time)),
signals AS (
  SELECT time, symbol,
         CASE WHEN rsi < 30 AND obv > obv0 AND close > ma5 AND volume > 1.5 * avg_vol20 THEN 'buy'
              WHEN rsi > 70 AND obv < obv0 AND close < ma5 AND volume > 1.5 * avg_vol20 THEN 'sell'
              WHEN close > ma20 AND rsi > rsi0 THEN 'trend_up'
              WHEN close < ma20 AND rsi < rsi0 THEN 'trend_down' ELSE 'hold' END AS signal_type,
         close, round(rsi, 6) AS rsi, obv, round(tvi, 4) AS tvi, volume, ma5, ma20, avg_vol20
  FROM framed JOIN instruments USING (instrument_id))
"""

TRENDING = CANDLES.replace("\ncandles AS", "\ndaily AS") + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY time) % 40 AS place FROM daily),
candles AS (
  SELECT time, instrument_id, open, high, low,
         2000.0::DOUBLE + sum(CASE WHEN place < 16 THEN -1 WHEN place = 16 THEN 4 WHEN place < 32 THEN 1
                                   WHEN place = 32 THEN -4 ELSE 0 END)
           OVER (PARTITION BY instrument_id ORDER BY time)::DOUBLE AS close,
         CASE WHEN place IN (16, 32) THEN volume * 20 ELSE volume END AS volume, open_interest
  FROM placed)"""

TRENDING_SIGNALS = SIGNALS.replace(CANDLES, TRENDING)

FILE_ROWS = """
WITH cells AS (
  SELECT 'S' || l_suppkey AS ticker, l_suppkey % 4 AS f, l_partkey AS p,
         date_trunc('day', l_shipdate)::TIMESTAMP
           + to_minutes(9 * 60 + 15 + (l_partkey % 45)) AS time,
         (l_partkey % 1000) AS o, l_quantity::BIGINT AS q,
         (l_orderkey * 8 + l_linenumber) * 2097152 + l_partkey % 2097152 + 1 AS source_row
  FROM lineitem),
parsed AS (
  SELECT ticker AS symbol, time, CASE WHEN f < 3 THEN o::DOUBLE END AS open, (o + 2)::DOUBLE AS high,
         (o - 1)::DOUBLE AS low, (o + 1)::DOUBLE AS close, CASE WHEN p % 50 <> 0 THEN q END AS volume,
         CASE WHEN p % 7 <> 0 THEN p % 100 END AS open_interest,
         CASE WHEN f = 3 THEN 'no column Open' WHEN p % 50 = 0 THEN 'unreadable number' END AS reject_reason,
         'file_' || f || '.csv' AS source_file, source_row
  FROM cells)
"""

FILE_COUNTS = FILE_ROWS + """, counts AS (
  SELECT source_file, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted,
         count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected FROM parsed GROUP BY source_file)
"""

SUMMARY = ALL + """,
compared AS (
  SELECT *, lead(close) OVER (PARTITION BY instrument_id ORDER BY time) AS other FROM candles),
summary AS (
  SELECT symbol, instrument_type, option_type, strike_price, close AS latest_price, c.time AS latest_time,
         -- halves away from zero, exactly: prices are whole sixteenths
         sign(close - other) * ((20000 * abs(close - other) * 16)::BIGINT + (other * 16)::BIGINT)
           // (2 * (other * 16)::BIGINT) / 100.0 AS price_change_pct, volume, open_interest,
         round(rsi, 6) AS rsi, round(tvi, 4) AS tvi, obv,
         CASE WHEN rsi > 70 THEN 'Overbought' WHEN rsi < 30 THEN 'Oversold' ELSE 'Neutral' END AS rsi_signal
  FROM compared c JOIN instruments USING (instrument_id)
  LEFT JOIN ind t ON c.time = t.time AND c.instrument_id = t.instrument_id
  WHERE other IS NOT NULL)
"""

TRAINING = "WITH" + CANDLES + IND + """,
joined AS (
  SELECT c.*, tvi, obv, rsi, pvi, pvt FROM candles c
  JOIN ind t ON c.time = t.time AND c.instrument_id = t.instrument_id),
framed AS (
  SELECT *, lead(close, 4) OVER w AS future_price, lag(close) OVER w AS pc, lag(volume) OVER w AS pv,
         last_value(open_interest IGNORE NULLS)
           OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS poi,
         lag(rsi) OVER w AS prsi, row_number() OVER w AS rn,
         avg(close) OVER (w ROWS 4 PRECEDING) AS a5, avg(close) OVER (w ROWS 19 PRECEDING) AS a20
  FROM joined WINDOW w AS (PARTITION BY instrument_id ORDER BY time)),
training AS (
  SELECT instrument_id, time, open, high, low, close, volume, open_interest, tvi, obv, rsi, pvi, pvt,
         future_price, (future_price > close)::INTEGER AS target, close / nullif(pc, 0) - 1 AS price_change,
         volume::DOUBLE / nullif(pv, 0) - 1 AS volume_change,
         open_interest::DOUBLE / nullif(poi, 0) - 1 AS finite_oi_change,
         poi = 0 AND open_interest <> 0 AS oi_infinite,
         a5 AS ma5, a20 AS ma20, rsi - prsi AS rsi_change
  FROM framed
  WHERE rn >= 20 AND future_price IS NOT NULL AND open_interest IS NOT NULL AND poi IS NOT NULL
    AND NOT (poi = 0 AND open_interest = 0)
    AND tvi IS NOT NULL AND rsi IS NOT NULL AND prsi IS NOT NULL AND pvt IS NOT NULL)"""

MATRIX = TRAINING + """,
matrix AS (
  SELECT instrument_id, time, target, """ + ", ".join(
    f"least(greatest({'finite_oi_change' if f == 'oi_change' else f}::DOUBLE, -1e10), 1e10) AS {f}"
    for f in FEATURES
) + """
  FROM training WHERE NOT oi_infinite)"""

ML_DIGITS = {
    "rsi": 6, "tvi": 4, "pvi": 6, "pvt": 6, "price_change": 8, "volume_change": 8, "oi_change": 8,
    "rsi_change": 6,
}


def rounded_features() -> str:
    return ", ".join(f"round({f}, {ML_DIGITS[f]}) AS {f}" if f in ML_DIGITS else f for f in FEATURES)


SCALER = " UNION ALL ".join(
    f"SELECT instrument_id, '{f}' AS feature, round(avg({f}), 6) AS mean, round(stddev_pop({f}), 6) AS std"
    " FROM matrix GROUP BY instrument_id"
    for f in FEATURES
)

SCALED = "SELECT instrument_id, time, target, " + ", ".join(
    f"round(({f} - avg({f}) OVER w) / (CASE WHEN stddev_pop({f}) OVER w = 0 THEN 1 "
    f"ELSE stddev_pop({f}) OVER w END), 6) AS {f}"
    for f in FEATURES
) + " FROM matrix WINDOW w AS (PARTITION BY instrument_id)"

TICKERS = """
tickers AS (
  SELECT p_partkey, exchange, brand, day, strike, kind,
         CASE kind WHEN 0 THEN exchange || '_OPTIDX_' || brand || '_' || day || '_' || strike || '_CE'
                   WHEN 1 THEN exchange || '_FUTIDX_' || brand || '_' || day
                   WHEN 2 THEN exchange || '_INDICES_' || brand
                   WHEN 3 THEN exchange || '_EQ_' || brand || '_' || p_partkey::VARCHAR
                   ELSE exchange || '_' || brand END AS ticker
  FROM (SELECT p_partkey, p_partkey % 5 AS kind,
               CASE p_size % 3 WHEN 0 THEN 'NSE' WHEN 1 THEN 'BSE' ELSE 'MCX' END AS exchange,
               (p_size % 31 + 1)::VARCHAR || 'MAR2024' AS day,
               CASE WHEN p_partkey % 11 = 0 THEN 'n/a' ELSE (p_partkey * 50)::VARCHAR END AS strike,
               upper(replace(p_brand, '#', '')) AS brand, p_size FROM part))"""

CUSTOMER_INSTRUMENTS = """
known AS (
  SELECT c_custkey AS instrument_id, 'NSE_EQ_' || c_custkey::VARCHAR AS symbol, 'index' AS instrument_type,
         NULL::VARCHAR AS option_type, NULL::DOUBLE AS strike_price, NULL::VARCHAR AS expiry_date,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer),
named AS (SELECT DISTINCT 'NSE_EQ_' || (o_custkey * 2)::VARCHAR AS symbol FROM orders),
fresh AS (
  SELECT (SELECT max(instrument_id) FROM known) + row_number() OVER (ORDER BY md5(symbol)) AS instrument_id,
         symbol
  FROM named WHERE symbol NOT IN (SELECT symbol FROM known))"""

ENVELOPES = """
ev AS (
  SELECT event_id AS seq, event_type, ts, value, CAST(props->>'$.k' AS BIGINT) AS k,
         date_trunc('second', ts) AS whole FROM events)"""

KEYED_ORDERS = """
rows AS (
  SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS time, o_custkey AS instrument_id,
         o_totalprice AS close, o_orderkey AS seq, o_orderstatus = 'F' AS finished FROM orders),
standing AS (
  SELECT time, instrument_id, arg_max(close, seq) AS close, max(seq) AS seq
  FROM rows WHERE finished GROUP BY 1, 2)"""

QUALITY = "WITH" + CANDLES + IND + ",\n" + EVENTS.strip().replace("ticks AS", "eticks AS") + """,
quick AS (
  SELECT time_bucket(INTERVAL '15 seconds', time) AS time, user_id AS instrument_id
  FROM eticks GROUP BY 1, 2)"""

TIMED = ("candle_data_1min", "candles"), ("candle_data_15sec", "quick"), ("technical_indicators", "ind")


def over_tables(template: str) -> str:
    return " UNION ALL ".join(template.format(name=name, cte=cte) for name, cte in TIMED)


REPORT = QUALITY + """,
old AS (
  SELECT 'candle_data_1min' AS t, count(*) FILTER (time < TIMESTAMP '2024-01-24') AS n FROM candles
  UNION ALL SELECT 'candle_data_15sec', count(*) FILTER (time < TIMESTAMP '2024-01-24') FROM quick
  UNION ALL SELECT 'technical_indicators', count(*) FILTER (time < TIMESTAMP '2024-01-24') FROM ind
  UNION ALL SELECT 'trading_signals', count(*) FILTER (time < TIMESTAMP '2024-01-24') FROM candles),
counts AS (
  SELECT 'instruments' AS t, count(*) AS n FROM supplier
  UNION ALL SELECT 'candle_data_1min', count(*) FROM candles
  UNION ALL SELECT 'candle_data_15sec', count(*) FROM quick
  UNION ALL SELECT 'technical_indicators', count(*) FROM ind),
ages AS (
  SELECT 'candle_data_1min' AS t, max(time) AS latest FROM candles
  UNION ALL SELECT 'candle_data_15sec', max(time) FROM quick
  UNION ALL SELECT 'technical_indicators', max(time) FROM ind),
sample AS (SELECT time, instrument_id FROM candles ORDER BY time DESC, instrument_id LIMIT 100),
full_sample AS (
  SELECT count(*) AS n, count(tvi) > 0 AND count(obv) > 0 AND count(rsi) > 0 AND count(pvi) > 0
         AND count(pvt) > 0 AS complete
  FROM sample s LEFT JOIN ind t ON s.time = t.time AND s.instrument_id = t.instrument_id),
session AS (
  SELECT 'candle_data_15sec' AS t, count(*) FILTER (hour(time) BETWEEN 9 AND 10) AS n FROM quick
  UNION ALL SELECT 'technical_indicators', 0),
report AS (
  SELECT 'Database Schema' AS section, 'table ' || t AS check_name, 'PASSED' AS status, 'complete' AS detail
  FROM (VALUES ('instruments'), ('candle_data_1min'), ('candle_data_15sec'), ('technical_indicators'),
               ('trading_signals')) v(t)
  UNION ALL SELECT 'Scalping Strategy Data', 'view first_two_hours_data', 'PASSED', 'exists'
  UNION ALL SELECT 'Retention Policy', 'retention of ' || t,
                   CASE WHEN n = 0 THEN 'PASSED' ELSE 'WARNING' END, n || ' rows past retention' FROM old
  UNION ALL SELECT 'Data Flow', 'rows in ' || t, CASE WHEN n > 0 THEN 'PASSED' ELSE 'WARNING' END,
                   n || ' rows' FROM counts
  UNION ALL SELECT 'Technical Indicators', 'indicators present',
                   CASE WHEN complete THEN 'PASSED' ELSE 'WARNING' END, n || ' latest candles sampled'
            FROM full_sample
  UNION ALL SELECT 'Real-time Performance', 'latest in ' || t,
                   CASE WHEN latest IS NOT NULL THEN 'PASSED' ELSE 'WARNING' END,
                   coalesce(round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(latest)) / 60000000.0, 2)
                              ::DECIMAL(20,2)::VARCHAR || ' minutes old', 'no rows') FROM ages
  UNION ALL SELECT 'Scalping Strategy Data', 'session rows in ' || t,
                   CASE WHEN n > 0 THEN 'PASSED' ELSE 'WARNING' END, n || ' rows' FROM session)
"""

RESOLVE = """
WITH known AS (
  SELECT c_custkey AS instrument_id, 'user_' || (c_custkey * 2)::VARCHAR AS symbol FROM customer),
ticks AS (
  SELECT (event_id + (event_id * 7) % 5) * 8 + (event_id * 7) % 5 AS seq, ts AS time, value AS close,
         'user_' || user_id::VARCHAR AS symbol FROM events)
"""

PLAIN_TICKS = (
    "SELECT (event_id + (event_id * 7) % 5) * 8 + (event_id * 7) % 5 AS seq, event_type AS symbol, "
    "ts AS time, value AS close"
)

WANTED_SYMBOL = "'BANKNIFTY_20050PE-28MAR2024'"

JSON_TICKS = f"""WITH{ENVELOPES}
SELECT seq, event_type || '.x' AS symbol,
       CASE seq % 6 WHEN 0 THEN whole WHEN 1 THEN whole - INTERVAL 330 MINUTE WHEN 2 THEN ts WHEN 3 THEN ts
                    WHEN 4 THEN TIMESTAMP '2024-02-03 04:05:06' ELSE whole END AS time,
       CASE seq % 6 WHEN 4 THEN 0 WHEN 5 THEN NULL ELSE value END AS open,
       CASE WHEN seq % 6 IN (4, 5) THEN 0 ELSE value END AS high,
       CASE WHEN seq % 6 IN (4, 5) THEN 0 ELSE value END AS low,
       value AS close,
       CASE WHEN seq % 6 IN (0, 3) THEN k ELSE 0 END AS volume,
       CASE seq % 6 WHEN 1 THEN k WHEN 3 THEN 9 END AS open_interest,
       CASE WHEN seq % 6 = 5 THEN 'unreadable number' END AS reject_reason
FROM ev"""

ORACLES: dict[str, str] = {
    "obv": one_indicator("obv", None),
    "rsi_14": one_indicator("rsi", 6),
    "tvi": one_indicator("tvi", 4),
    "pvi": one_indicator("pvi", 6),
    "pvt": one_indicator("pvt", 6),
    "indicators_batch": f"WITH{CANDLES}{IND} SELECT time, instrument_id, timeframe, {SHOWN} FROM ind",
    "indicators_trailing100": f"""WITH{CANDLES},
newest AS (
  SELECT * FROM candles
  QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY time DESC) <= 100)"""
    + indicator_steps("newest", "ind")
    + f"""
SELECT time, instrument_id, timeframe, {SHOWN} FROM ind
QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY time DESC) = 1""",
    "moving_average": f"""WITH{CANDLES}
SELECT instrument_id, time,
       avg(close) OVER (PARTITION BY instrument_id ORDER BY time ROWS 19 PRECEDING) AS ma
FROM candles""",
    "moving_average_by_place": f"""WITH{CANDLES}
SELECT instrument_id, time, 5 AS window_rows, avg(close) OVER (w ROWS 4 PRECEDING) AS ma FROM candles
WINDOW w AS (PARTITION BY instrument_id ORDER BY time)
UNION ALL
SELECT instrument_id, time, 20 AS window_rows, avg(close) OVER (w ROWS 19 PRECEDING) AS ma FROM candles
WINDOW w AS (PARTITION BY instrument_id ORDER BY time)""",
    "candles_event_time": f"WITH{EVENTS} " + event_candles(15, "symbol"),
    "candles_1min": f"WITH{EVENTS} " + event_candles(60, "symbol"),
    "candles_daily": f"WITH{CANDLES} SELECT * FROM candles",
    "candles_arrival_order": f"""WITH{EVENTS},
bucketed AS (SELECT *, time_bucket(INTERVAL '15 seconds', time) AS b FROM ticks),
marked AS (
  SELECT *, max(b) OVER (PARTITION BY symbol ORDER BY seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM bucketed),
closing AS (SELECT *, coalesce(b > pm, false)::INTEGER AS closes FROM marked),
grouped AS (
  SELECT *, coalesce(sum(closes) OVER (PARTITION BY symbol ORDER BY seq
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM closing)
SELECT symbol, max(CASE WHEN closes = 1 THEN b END) AS time, arg_min(price, seq) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, seq) AS close, sum(volume)::BIGINT AS volume,
       arg_max_null(oi, seq) AS open_interest
FROM grouped GROUP BY symbol, g HAVING max(closes) = 1""",
    "session_hours": PLAIN_TICKS
    + ", CAST(props->>'$.k' AS BIGINT) AS volume FROM events WHERE hour(ts) BETWEEN 9 AND 10",
    "recency_filter": PLAIN_TICKS
    + " FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 30 MINUTE",
    "retention": PLAIN_TICKS + " FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY",
    "candle_range": f"""WITH{CANDLES} SELECT * FROM candles
WHERE instrument_id = 1 AND time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-06-30'""",
    "enriched_candles": f"{ALL} {ENRICHED}",
    "enriched_candles_plain": f"""WITH{CANDLES},{INSTRUMENTS}
SELECT time, symbol, instrument_type, option_type, strike_price, open, high, low, close, volume, open_interest
FROM candles JOIN instruments USING (instrument_id)""",
    "latest_n": f"{ALL} {ENRICHED} ORDER BY c.time DESC, symbol LIMIT 100",
    "latest_n_symbol": f"{ALL} {ENRICHED} WHERE symbol = {WANTED_SYMBOL} ORDER BY c.time DESC LIMIT 100",
    "latest_100_per_instrument": f"""WITH{CANDLES}
SELECT *, (row_number() OVER (PARTITION BY instrument_id ORDER BY time DESC))::INTEGER AS recency
FROM candles QUALIFY recency <= 100""",
    "latest_5000_per_instrument": f"WITH{CANDLES}"
    + """ SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY instrument_id ORDER BY time DESC))::INTEGER AS recency FROM candles)
WHERE recency <= 5000""",
    "unknown_symbols": RESOLVE
    + "SELECT symbol, seq, time, close FROM ticks WHERE symbol NOT IN (SELECT symbol FROM known)",
    "resolved_symbols": RESOLVE
    + "SELECT symbol, seq, time, close, instrument_id FROM ticks JOIN known USING (symbol)",
    "scalping_signals": SIGNALS + "SELECT * FROM signals",
    "signals_latest": SIGNALS + "SELECT * FROM signals ORDER BY time DESC, symbol LIMIT 100",
    "signals_symbol": SIGNALS + f"SELECT * FROM signals WHERE symbol = {WANTED_SYMBOL} ORDER BY time DESC LIMIT 200",
    "signal_counts": SIGNALS + "SELECT signal_type, count(*) AS signals FROM signals GROUP BY 1",
    "signals_trending": TRENDING_SIGNALS + "SELECT * FROM signals",
    "signal_counts_trending": TRENDING_SIGNALS + "SELECT signal_type, count(*) AS signals FROM signals GROUP BY 1",
    "signals_buy": TRENDING_SIGNALS + "SELECT * FROM signals WHERE signal_type = 'buy'",
    "signals_sell": TRENDING_SIGNALS + "SELECT * FROM signals WHERE signal_type = 'sell'",
    "signals_sink": TRENDING_SIGNALS
    + """SELECT time, instrument_id, signal_type, close AS signal_value, TIMESTAMP '2024-01-31 00:00:00' AS created_at
FROM signals JOIN instruments USING (symbol)""",
    "market_summary": SUMMARY + "SELECT * FROM summary",
    "market_summary_export": SUMMARY
    + "SELECT * FROM summary WHERE NOT (symbol IS NULL OR option_type IS NULL OR strike_price IS NULL "
    "OR price_change_pct IS NULL OR open_interest IS NULL OR rsi IS NULL OR tvi IS NULL OR obv IS NULL)",
    "ml_target": TRAINING + " SELECT instrument_id, time, close, future_price, target FROM training",
    "ml_training_set": TRAINING
    + """ SELECT instrument_id, time, open, high, low, close, volume, open_interest, round(tvi, 4) AS tvi, obv,
  round(rsi, 6) AS rsi, round(pvi, 6) AS pvi, round(pvt, 6) AS pvt, future_price, target,
  round(price_change, 8) AS price_change, round(volume_change, 8) AS volume_change,
  round(CASE WHEN NOT oi_infinite THEN finite_oi_change END, 8) AS oi_change, oi_infinite,
  ma5, ma20, round(rsi_change, 6) AS rsi_change FROM training""",
    "ml_features": MATRIX + f" SELECT instrument_id, time, target, {rounded_features()} FROM matrix",
    "ml_scaler": MATRIX + " " + SCALER,
    "ml_scaler_train": MATRIX
    + """, train AS (
  SELECT * FROM matrix
  WHERE ('0x' || substr(md5('42|' || instrument_id || '|' || epoch_us(time)), 1, 8))::BIGINT % 10 >= 2)
"""
    + SCALER.replace("FROM matrix", "FROM train"),
    "ml_slice": TRAINING
    + f""", {INSTRUMENTS.strip()}
SELECT instrument_id, time, symbol, close, target FROM training JOIN instruments USING (instrument_id)
WHERE option_type = 'CE'""",
    "ml_scaled": MATRIX + " " + SCALED,
    "ml_split": MATRIX
    + """ SELECT instrument_id, time, target,
  CASE WHEN ('0x' || substr(md5('42|' || instrument_id || '|' || epoch_us(time)), 1, 8))::BIGINT % 10 < 2
       THEN 'test' ELSE 'train' END AS split FROM matrix""",
    "best_instrument": ALL
    + """ SELECT instrument_id, symbol FROM instruments i
WHERE EXISTS (SELECT 1 FROM candles c WHERE c.instrument_id = i.instrument_id)
  AND EXISTS (SELECT 1 FROM ind t WHERE t.instrument_id = i.instrument_id AND t.timeframe = '1min')
ORDER BY CASE WHEN symbol LIKE 'NIFTY%' THEN 0 WHEN symbol LIKE 'BANKNIFTY%' THEN 1
              WHEN symbol LIKE '%NIFTY%' THEN 2 ELSE 3 END, instrument_id LIMIT 1""",
    "preferred_instrument": f"""WITH{SYMBOLS} SELECT instrument_id, symbol FROM symbols
ORDER BY CASE WHEN symbol LIKE 'NIFTY%' THEN 0 WHEN symbol LIKE 'BANKNIFTY%' THEN 1
              WHEN symbol LIKE '%NIFTY%' THEN 2 ELSE 3 END, instrument_id LIMIT 1""",
    "first_instrument": f"WITH{SYMBOLS} SELECT * FROM symbols ORDER BY instrument_id LIMIT 1",
    "underlying_list": f"""WITH{SYMBOLS} SELECT DISTINCT nullif(regexp_extract(symbol, '([A-Z]+)', 1), '') AS underlying
FROM symbols""",
    "contract_catalog": f"""WITH{INSTRUMENTS}
SELECT DISTINCT nullif(regexp_extract(symbol, '([A-Z]+)', 1), '') AS underlying, option_type, strike_price,
       expiry_date FROM instruments WHERE expiry_date IS NOT NULL""",
    "expiries": f"""WITH{INSTRUMENTS}
SELECT DISTINCT expiry_date FROM instruments WHERE symbol LIKE 'NIFTY%' AND expiry_date IS NOT NULL""",
    "strikes": f"""WITH{INSTRUMENTS}
SELECT DISTINCT strike_price FROM instruments
WHERE symbol LIKE 'BANKNIFTY%' AND expiry_date = '2024-03-28' AND strike_price IS NOT NULL""",
    "contract_slice": f"""WITH{INSTRUMENTS} SELECT instrument_id, symbol FROM instruments
WHERE symbol LIKE 'BANKNIFTY%' AND expiry_date = '2024-03-28' AND strike_price = 20050 AND option_type = 'PE'""",
    "ticker_parse": f"""WITH{TICKERS}
SELECT p_partkey, ticker,
       CASE kind WHEN 0 THEN 'option' WHEN 1 THEN 'future' WHEN 2 THEN 'index' WHEN 3 THEN 'stock' END
         AS instrument_type,
       CASE WHEN kind = 0 AND strike <> 'n/a' THEN 'CE' END AS option_type,
       CASE WHEN kind = 0 THEN TRY_CAST(strike AS DOUBLE) END AS strike_price,
       CASE WHEN kind = 1 OR (kind = 0 AND strike <> 'n/a')
            THEN strptime(day, '%d%b%Y')::DATE::VARCHAR END AS expiry_date
FROM tickers""",
    "symbol_regex_parse": f"WITH{INSTRUMENTS} SELECT * FROM instruments",
    "segment_filter": f"""WITH{TICKERS} SELECT p_partkey, ticker FROM tickers
WHERE exchange IN ('NSE', 'BSE') ORDER BY p_partkey LIMIT 50""",
    "segment_tickers": f"WITH{TICKERS} SELECT p_partkey, ticker FROM tickers WHERE exchange IN ('NSE', 'BSE')",
    "option_chain_expand": """SELECT symbol, '28MAR2024' AS expiry, strike, option_type,
       symbol || '28MAR2024' || strike::VARCHAR || option_type AS contract
FROM (SELECT upper(substr(p_name, 1, 3)) || p_partkey::VARCHAR AS symbol,
             unnest(generate_series(p_partkey * 50, p_partkey * 50 + p_size * 10, 50)) AS strike FROM part),
     (VALUES ('CE'), ('PE')) v(option_type)""",
    "date_normalize": """SELECT o_orderkey, written,
  CASE way WHEN 4 THEN upper(written)
           WHEN 3 THEN upper(strftime(o_orderdate + INTERVAL 96 MONTH, '%d%b%Y'))
           ELSE upper(strftime(o_orderdate, '%d%b%Y')) END AS normalized
FROM (SELECT o_orderkey, o_orderdate, o_orderkey % 5 AS way,
        CASE o_orderkey % 5
          WHEN 0 THEN strftime(o_orderdate, '%d%b%Y')
          WHEN 1 THEN strftime(o_orderdate, '%d-%b-%Y')
          WHEN 2 THEN upper(strftime(o_orderdate, '%-d-%b-%Y'))
          WHEN 3 THEN strftime(o_orderdate + INTERVAL 96 MONTH, '%d-%b-%y')
          ELSE strftime(o_orderdate, '%Y/%b/%d') END AS written FROM orders)""",
    "instrument_upsert": f"""WITH{CUSTOMER_INSTRUMENTS}
SELECT instrument_id, symbol, CASE WHEN symbol IN (SELECT symbol FROM named) THEN 'stock' ELSE instrument_type END
         AS instrument_type, option_type, strike_price, expiry_date,
       CASE WHEN symbol IN (SELECT symbol FROM named) THEN TIMESTAMP '2024-01-31' ELSE updated_at END AS updated_at
FROM known
UNION ALL SELECT instrument_id, symbol, 'stock', NULL, NULL, NULL, TIMESTAMP '2024-01-31' FROM fresh""",
    "instrument_get_or_create": f"""WITH{CUSTOMER_INSTRUMENTS} SELECT * FROM known
UNION ALL SELECT instrument_id, symbol, 'index', NULL, NULL, NULL, TIMESTAMP '2024-01-31' FROM fresh""",
    "json_tick_decode": JSON_TICKS,
    "channel_log_ticks": JSON_TICKS,
    "csv_tick_decode": f"""WITH{ENVELOPES}
SELECT seq, event_type AS symbol, date_trunc('minute', ts) AS time, value AS open, value AS high, value AS low,
       value AS close, k AS volume, CASE WHEN seq % 7 = 0 THEN NULL ELSE k END AS open_interest
FROM ev WHERE seq % 7 NOT IN (1, 3, 4)""",
    "tick_quarantine": f"""WITH{ENVELOPES}
SELECT seq, event_type AS symbol, CASE seq % 7 WHEN 1 THEN 'too few fields' WHEN 3 THEN 'unreadable time'
       ELSE 'unreadable number' END AS reject_reason FROM ev WHERE seq % 7 IN (1, 3, 4)""",
    "upsert_last_wins": f"""WITH{KEYED_ORDERS},
incoming AS (
  SELECT time, instrument_id, arg_max(close, seq) AS close, max(seq) AS seq
  FROM rows WHERE NOT finished GROUP BY 1, 2)
SELECT time, instrument_id, coalesce(i.close, s.close) AS close, coalesce(i.seq, s.seq) AS seq
FROM standing s FULL JOIN incoming i USING (time, instrument_id)""",
    "insert_ignore": f"""WITH{KEYED_ORDERS},
incoming AS (
  SELECT time, instrument_id, arg_min(close, seq) AS close, min(seq) AS seq
  FROM rows WHERE NOT finished GROUP BY 1, 2)
SELECT time, instrument_id, CASE WHEN s.seq IS NULL THEN i.close ELSE s.close END AS close,
       coalesce(s.seq, i.seq) AS seq
FROM standing s FULL JOIN incoming i USING (time, instrument_id)""",
    "union_by_name": """SELECT c_name AS name, c_acctbal AS balance, 'customer' AS __source_file, NULL::INTEGER AS nation
FROM customer UNION ALL SELECT s_name, NULL, 'supplier', s_nationkey FROM supplier""",
    "historical_parse": FILE_ROWS + "SELECT * FROM parsed",
    "historical_file_counts": FILE_COUNTS + "SELECT * FROM counts",
    "historical_import_counts": FILE_COUNTS
    + "SELECT count(*) FILTER (WHERE rejected = 0) AS imported, count(*) FILTER (WHERE rejected > 0) AS failed FROM counts",
    "historical_whole_files": FILE_ROWS
    + """SELECT symbol, time, open, close, source_row FROM parsed WHERE (symbol, time::DATE) NOT IN (
  SELECT (symbol, time::DATE) FROM parsed WHERE reject_reason IS NOT NULL)""",
    "combine_by_header": FILE_ROWS
    + """SELECT ticker AS "Ticker", CASE WHEN f < 3 THEN o::VARCHAR END AS "Open", (o + 1)::VARCHAR AS "Close",
       CASE WHEN p % 50 = 0 THEN 'oops' ELSE q::VARCHAR END AS "Volume",
       CASE WHEN p % 7 <> 0 THEN (p % 100)::VARCHAR END AS "OI", 'file_' || f || '.csv' AS __source_file, source_row
FROM cells WHERE f <> 1""",
    "ticker_list": """SELECT p_partkey AS source_row, 0 AS source_column, 'T' || p_partkey AS ticker FROM part
UNION ALL SELECT p_partkey, 2, upper(p_type) FROM part""",
    "request_list": """SELECT 'S' || p_partkey AS symbol, '01MAR2024' AS start_date, '28MAR2024' AS end_date,
       '28MAR2024' AS expiry, p_partkey * 50 AS low, p_partkey * 50 + p_size * 10 AS high FROM part""",
    "dq_counts": QUALITY
    + """ SELECT 'instruments' AS table_name, count(*) AS row_count FROM supplier UNION ALL
SELECT 'trading_signals', count(*) FROM candles UNION ALL """
    + over_tables("SELECT '{name}', count(*) FROM {cte}"),
    "dq_instrument_counts": f"WITH{CANDLES} SELECT instrument_id, count(*) AS row_count FROM candles GROUP BY 1",
    "dq_timeframe_counts": f"WITH{CANDLES}{IND} SELECT timeframe, count(*) AS row_count FROM ind GROUP BY 1",
    "dq_completeness": f"""WITH{CANDLES}{IND},
sample AS (SELECT time, instrument_id FROM candles ORDER BY time DESC, instrument_id LIMIT 100)
SELECT *, has_tvi AND has_obv AND has_rsi AND has_pvi AND has_pvt AS complete FROM (
  SELECT count(*) AS sampled, count(tvi) > 0 AS has_tvi, count(obv) > 0 AS has_obv, count(rsi) > 0 AS has_rsi,
         count(pvi) > 0 AS has_pvi, count(pvt) > 0 AS has_pvt
  FROM sample s LEFT JOIN ind t ON s.time = t.time AND s.instrument_id = t.instrument_id)""",
    "dq_freshness": QUALITY
    + " "
    + over_tables(
        "SELECT '{name}' AS table_name, max(time) AS latest_time, "
        "round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(time))) / 60000000.0, 4) AS age_minutes FROM {cte}"
    ),
    "dq_session_coverage": QUALITY
    + " "
    + over_tables(
        "SELECT '{name}' AS table_name, count(*) FILTER (hour(time) BETWEEN 9 AND 10) AS session_rows FROM {cte}"
    ),
    "dq_partitions": QUALITY
    + " SELECT * FROM ("
    + over_tables(
        "SELECT '{name}' AS table_name, "
        "make_timestamp(epoch_us(time) // 604800000000 * 604800000000) AS range_start, "
        "min(time) AS first_time, max(time) AS last_time, count(*) AS row_count FROM {cte} GROUP BY 1, 2"
    )
    + ") ORDER BY table_name, range_start DESC LIMIT 10",
    "dq_report": REPORT + 'SELECT section, check_name AS "check", status, detail FROM report',
    "dq_overall": REPORT
    + "SELECT CASE WHEN bool_and(status <> 'FAILED') THEN 'PASSED' ELSE 'FAILED' END AS status FROM report",
}
