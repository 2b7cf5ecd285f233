"""SQL with the meaning of each contract query, for DuckDB over the same tables.

The statements are written from the definitions, in another shape than the Spark
queries where there is a choice: first and last candles from ordered lists, surrogate
keys by DENSE_RANK over the rows themselves, calendars by recursion-free series.
"""

from __future__ import annotations

_CANDLES = """
trades AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'poloniex' END AS exchange,
         CASE event_type WHEN 'click' THEN 'BTC' WHEN 'view' THEN 'ETH' WHEN 'purchase' THEN 'SOL'
                         WHEN 'signup' THEN 'ADA' WHEN 'error' THEN 'LINK' ELSE upper(event_type) END AS asset,
         date_trunc('hour', ts) AS hour, ts, event_id, value
  FROM events WHERE event_type IS NOT NULL),
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY exchange, asset, hour ORDER BY ts, event_id) AS up,
            ROW_NUMBER() OVER (PARTITION BY exchange, asset, hour ORDER BY ts DESC, event_id DESC) AS down
  FROM trades),
candles AS (
  SELECT exchange, asset, hour,
         CAST(MAX(CASE WHEN up = 1 THEN value END) AS DECIMAL(18,8)) AS open,
         CAST(MAX(value) AS DECIMAL(18,8)) AS high,
         CAST(MIN(value) AS DECIMAL(18,8)) AS low,
         CAST(MAX(CASE WHEN down = 1 THEN value END) AS DECIMAL(18,8)) AS close,
         CAST(SUM(CAST(value AS DECIMAL(18,8))) AS DECIMAL(18,8)) AS volume,
         CAST(COUNT(*) AS BIGINT) AS trade_count
  FROM numbered GROUP BY exchange, asset, hour),
bronze AS (
  SELECT exchange,
         CASE exchange WHEN 'binance' THEN asset || 'USDT' ELSE asset || '_USDT' END AS symbol,
         CASE exchange WHEN 'binance' THEN '1h' ELSE 'HOUR_1' END AS "interval",
         CAST(open AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low,
         CAST(close AS VARCHAR) AS close, CAST(volume AS VARCHAR) AS volume, trade_count,
         epoch_ms(hour) AS open_time_ms, epoch_ms(hour) + 3599999 AS close_time_ms,
         CAST(CAST(hour AS DATE) + 1 AS TIMESTAMP) AS ingested_at, CAST(hour AS DATE) AS rate_date
  FROM candles)"""

_SILVER = _CANDLES + """,
silver AS (
  SELECT exchange, asset || '_USDT' AS symbol,
         CASE exchange WHEN 'binance' THEN '1h' ELSE 'HOUR_1' END AS "interval",
         trade_count, open, high, low, close, volume,
         hour + INTERVAL 3599 SECOND AS close_time, hour AS open_time,
         CAST(hour AS DATE) AS rate_date, CAST(CAST(hour AS DATE) + 1 AS TIMESTAMP) AS ingested_at
  FROM candles)"""

_HOURLY = _SILVER + """,
hourly AS (
  SELECT CAST(DENSE_RANK() OVER (ORDER BY symbol) AS INTEGER) AS symbol_id,
         CAST(DENSE_RANK() OVER (ORDER BY exchange) AS INTEGER) AS exchange_id,
         symbol AS symbol_name, exchange AS exchange_name,
         open_time AS datetime_id, open AS open_price, high AS high_price, low AS low_price,
         close AS close_price, volume, trade_count,
         (close - open) / NULLIF(open, 0) * 100 AS variation_1h_pct, close_time, ingested_at
  FROM silver)"""

_DAILY = _HOURLY + """,
days AS (
  SELECT symbol_id, exchange_id, symbol_name, exchange_name, CAST(datetime_id AS DATE) AS date_id,
         list(open_price ORDER BY datetime_id)[1] AS open_price, list(close_price ORDER BY datetime_id)[-1] AS close_price,
         list(close_time ORDER BY datetime_id)[-1] AS close_time,
         MAX(high_price) AS high_price, MIN(low_price) AS low_price,
         CAST(SUM(volume) AS DECIMAL(28,8)) AS volume, CAST(SUM(trade_count) AS BIGINT) AS trade_count,
         MAX(ingested_at) AS ingested_at
  FROM hourly GROUP BY symbol_id, exchange_id, symbol_name, exchange_name, CAST(datetime_id AS DATE)),
daily AS (
  SELECT *, (close_price - open_price) / NULLIF(open_price, 0) * 100 AS variation_daily_pct,
         LAG(close_price) OVER series AS prev_close, LAG(date_id) OVER series AS prev_date
  FROM days WINDOW series AS (PARTITION BY exchange_id, symbol_id ORDER BY date_id))"""

_BOUNDS = """,
bounds AS (SELECT MIN(rate_date) AS first_day, MAX(rate_date) AS last_day,
                  MIN(open_time) AS first_hour, date_trunc('hour', MAX(close_time)) AS last_hour FROM silver),
calendar AS (SELECT CAST(d AS DATE) AS day
             FROM bounds, generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)),
hours AS (SELECT h AS hour FROM bounds, generate_series(first_hour, last_hour, INTERVAL 1 HOUR) AS g(h))"""

_THINNED = """,
thinned AS (
  SELECT * FROM silver
  WHERE NOT (symbol = 'BTC_USDT' AND day(rate_date) % 5 = 0) AND NOT (symbol = 'ETH_USDT' AND day(rate_date) < 4))"""

_COMPLETE = _THINNED + """,
complete AS (
  SELECT s.exchange, s.symbol, c.day AS rate_date, CAST(COUNT(x.open_time) AS BIGINT) AS hours,
         CAST(24 AS INTEGER) AS expected_hours, CAST(24 - COUNT(x.open_time) AS BIGINT) AS missing_hours
  FROM (SELECT exchange, symbol, MIN(rate_date) AS listed FROM thinned GROUP BY ALL) s
  JOIN calendar c ON c.day BETWEEN s.listed AND (SELECT MAX(rate_date) FROM thinned)
  LEFT JOIN thinned x ON x.exchange = s.exchange AND x.symbol = s.symbol AND x.rate_date = c.day
  GROUP BY s.exchange, s.symbol, c.day)"""

_BRONZE_COLUMNS = """close, close_time_ms, high, "interval", low, open, open_time_ms, symbol,
       trade_count, volume, ingested_at, rate_date"""

_FAULTY = _CANDLES + """,
faulty AS (
  SELECT exchange,
         CASE WHEN hr = 7 THEN replace(symbol, 'USDT', 'EUR') ELSE symbol END AS symbol,
         CASE WHEN hr = 13 THEN 'n/a' ELSE open END AS open,
         CASE WHEN hr = 3 THEN low WHEN hr = 5 THEN '12345678901.5' ELSE high END AS high,
         CASE WHEN hr = 3 THEN high ELSE low END AS low,
         close, CASE WHEN hr = 6 THEN NULL ELSE volume END AS volume,
         open_time_ms, CASE WHEN hr = 4 THEN open_time_ms - 1 ELSE close_time_ms END AS close_time_ms
  FROM (SELECT *, EXTRACT(hour FROM make_timestamp(open_time_ms * 1000)) AS hr FROM bronze)),
judged AS (
  SELECT *, exchange = 'binance' AND symbol LIKE '%EUR' AS unmatched,
         TRY_CAST(open AS DECIMAL(18,8)) AS o, TRY_CAST(high AS DECIMAL(18,8)) AS h,
         TRY_CAST(low AS DECIMAL(18,8)) AS l, TRY_CAST(close AS DECIMAL(18,8)) AS c,
         TRY_CAST(volume AS DECIMAL(18,8)) AS v
  FROM faulty),
flagged AS (
  SELECT *, unmatched OR (open IS NOT NULL AND o IS NULL) OR (high IS NOT NULL AND h IS NULL)
            OR (low IS NOT NULL AND l IS NULL) OR (close IS NOT NULL AND c IS NULL)
            OR (volume IS NOT NULL AND v IS NULL) AS bad
  FROM judged)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _rules(table: str, tests: list[tuple[str, str, str]]) -> str:
    """One line per rule: name, severity, rows, rows that fail the test."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, '{severity}' AS severity, CAST(COUNT(*) AS BIGINT) AS total_rows, "
        f"CAST(COUNT(*) FILTER (WHERE {test}) AS BIGINT) AS violations FROM {table}"
        for name, severity, test in tests
    )


_PRICES = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
_LOAD_TESTS = [
    ("rejected", "report", "bad"),
    ("unmatched_symbol", "report", "unmatched"),
    *[(f"malformed_{f}", "report", f"{f} IS NOT NULL AND {a} IS NULL") for f, a in _PRICES.items()],
    ("null_symbol", "report", "NOT bad AND symbol IS NULL"),
    *[(f"null_{f}", "report", f"NOT bad AND {f} IS NULL") for f in _PRICES],
    ("invalid_ohlc", "gate", "NOT bad AND (h < l OR h < o OR h < c OR l > o OR l > c)"),
    ("invalid_time", "gate", "NOT bad AND close_time_ms // 1000 <= open_time_ms // 1000"),
    ("off_grid_time", "report", "NOT bad AND open_time_ms % 3600000 <> 0"),
]
_REQUIRED = ["symbol", "open_time_ms", "close_time_ms", "open", "high", "low", "close", "volume"]

_DAY_COLUMNS = """year(d) AS "year", quarter(d) AS "quarter", month(d) AS "month", day(d) AS "day",
       strftime(d, '%Y-%m') AS year_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       dayname(d) AS day_of_week_name, dayofweek(d) IN (0, 6) AS is_weekend"""
_INT_PARTS = ["year", "quarter", "month", "day"]
for _part in _INT_PARTS:
    _DAY_COLUMNS = _DAY_COLUMNS.replace(f'{_part}(d) AS "{_part}"', f'CAST({_part}(d) AS INTEGER) AS "{_part}"')

_FACT_PRICES = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in ("open_price", "high_price", "low_price", "close_price", "volume")
)
_DAILY_COLUMNS = f"""symbol_id, exchange_id, date_id, {_FACT_PRICES}, trade_count,
       CAST(ROUND(variation_daily_pct, 6) AS DOUBLE) AS variation_daily_pct,
       CAST(ROUND((close_price - prev_close) / NULLIF(prev_close, 0) * 100, 6) AS DOUBLE) AS variation_prev_day_pct,
       close_time, ingested_at"""

_FIRST, _LAST = ("(SELECT CAST(MIN(ts) AS DATE) FROM events)", "(SELECT CAST(MAX(ts) AS DATE) FROM events)")
_PERIOD = f"date_id BETWEEN {_FIRST} + 5 AND {_LAST} - 5"
_FEW_DAYS = f"rate_date BETWEEN {_FIRST} + 9 AND {_FIRST} + 11"
_ENDS = _DAILY + f""",
ends AS (
  SELECT exchange_name, symbol_name, exchange_id, symbol_id,
         MAX(CASE WHEN n = 1 THEN close_price END) AS first_price,
         MAX(CASE WHEN m = 1 THEN close_price END) AS last_price
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY exchange_id, symbol_id ORDER BY date_id) AS n,
                  ROW_NUMBER() OVER (PARTITION BY exchange_id, symbol_id ORDER BY date_id DESC) AS m
        FROM daily WHERE {_PERIOD})
  GROUP BY ALL),
returns AS (SELECT *, (last_price - first_price) / NULLIF(first_price, 0) * 100 AS return_pct FROM ends)"""

_PERIODS = f""",
periods AS (
  SELECT 'within' AS period, {_FIRST} + 5 AS a, {_LAST} - 5 AS b
  UNION ALL SELECT 'around', {_FIRST} - 20, {_LAST} + 45
  UNION ALL SELECT 'from first', {_FIRST}, {_LAST} + 2
  UNION ALL SELECT 'one day', {_FIRST} + 7, {_FIRST} + 7)"""

ORACLES: dict[str, str] = {
    "bronze_parse_binance": _with(_CANDLES, f"SELECT {_BRONZE_COLUMNS} FROM bronze WHERE exchange = 'binance'"),
    "bronze_parse_poloniex": _with(_CANDLES, f"SELECT {_BRONZE_COLUMNS} FROM bronze WHERE exchange = 'poloniex'"),
    "bronze_wide_poloniex": _with(_CANDLES, """
SELECT symbol, low, high, open, close, volume, trade_count, "interval", open_time_ms, close_time_ms,
       trade_count || '.4' AS quote_asset_volume, trade_count || '.6' AS taker_buy_quote_volume,
       trade_count || '.7' AS taker_buy_base_volume,
       make_timestamp(open_time_ms * 1000) AS open_time, make_timestamp(close_time_ms * 1000) AS close_time,
       ingested_at AS landed_at
FROM bronze WHERE exchange = 'poloniex'"""),
    "bronze_day_slice": _with(_CANDLES, f"""
SELECT {_BRONZE_COLUMNS} FROM bronze
WHERE exchange = 'binance' AND {_FEW_DAYS}"""),
    "bronze_symbol_subset": _with(_CANDLES, f"""
SELECT {_BRONZE_COLUMNS} FROM bronze
WHERE exchange = 'poloniex' AND {_FEW_DAYS}
  AND symbol IN ('BTC_USDT', 'ETH_USDT')"""),
    "bronze_profile_by_symbol": _with(_CANDLES, """
SELECT symbol, CAST(COUNT(*) AS BIGINT) AS "rows", MIN(rate_date) AS min_date, MAX(rate_date) AS max_date
FROM bronze GROUP BY symbol"""),
    "bronze_range_profile": _with(_CANDLES, """
SELECT MIN(rate_date) AS min_date, MAX(rate_date) AS max_date, CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(COUNT(DISTINCT rate_date) AS BIGINT) AS distinct_dates,
       CAST(COUNT(DISTINCT symbol) AS BIGINT) AS distinct_symbols FROM bronze"""),
    "bronze_required_fields": _with(_CANDLES + """,
holes AS (
  SELECT """ + ", ".join(f"CASE WHEN hr <> {at} THEN {f} END AS {f}" for at, f in enumerate(_REQUIRED)) + """
  FROM (SELECT *, EXTRACT(hour FROM make_timestamp(open_time_ms * 1000)) AS hr FROM bronze))""", _rules(
        "holes", [(f"missing_{f}", "report", f"{f} IS NULL") for f in _REQUIRED])),
    "bronze_rejected": _with(_CANDLES, """
SELECT exchange, CASE day(ingested_at) WHEN 4 THEN 'missing_payload' WHEN 5 THEN 'empty_payload' ELSE 'unreadable_payload' END AS reason,
       CAST(COUNT(DISTINCT (symbol, ingested_at)) AS BIGINT) AS items
FROM bronze WHERE day(ingested_at) IN (4, 5, 6) GROUP BY ALL
UNION ALL
SELECT exchange, CASE day(ingested_at) WHEN 7 THEN 'unreadable_open_time' ELSE 'kept' END, CAST(COUNT(*) AS BIGINT)
FROM bronze WHERE day(ingested_at) NOT IN (4, 5, 6) GROUP BY ALL"""),
    "bronze_partition_inventory": "SELECT DISTINCT CAST(ts AS DATE) AS rate_date FROM events",
    "bronze_missing_days": """
SELECT CAST(d AS DATE) AS rate_date
FROM (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
     generate_series(CAST(lo - 2 AS TIMESTAMP), CAST(hi + 2 AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)""",
    "empty_load_stops": _with(_CANDLES, """
SELECT day, COUNT(c.hour) = 0 AS stopped, CAST(COUNT(c.hour) AS BIGINT) AS "rows"
FROM (SELECT unnest([MIN(CAST(ts AS DATE)) - 2, MIN(CAST(ts AS DATE)), MAX(CAST(ts AS DATE)), MAX(CAST(ts AS DATE)) + 2]) AS day FROM events)
LEFT JOIN candles c ON CAST(c.hour AS DATE) = day GROUP BY day"""),
    "load_of_yesterday": _with(_CANDLES, f"""
SELECT symbol, open_time_ms, open, close, volume, trade_count FROM bronze
WHERE exchange = 'binance' AND rate_date = {_LAST}"""),
    "missing_table_warns": _with(_CANDLES, """
SELECT 'after' AS state, TRUE AS found, CAST(COUNT(*) AS BIGINT) AS "rows" FROM bronze
UNION ALL SELECT 'before', FALSE, 0"""),
    "partition_overwrite_idempotent": _with(_CANDLES, """
SELECT rate_date, CAST(COUNT(*) AS BIGINT) AS "rows", CAST(SUM(trade_count) AS BIGINT) AS trades
FROM bronze GROUP BY rate_date"""),
    "backfill_equals_daily_loads": _with(
        _CANDLES, f"SELECT {_BRONZE_COLUMNS} FROM bronze WHERE exchange = 'binance'"),
    "bucketed_merge": _with(_CANDLES, f"""
SELECT rate_date, symbol, open_time_ms, open, close, volume,
       trade_count + CASE WHEN symbol = 'BTCUSDT' AND rate_date = {_LAST} THEN 1 ELSE 0 END AS trade_count
FROM bronze WHERE exchange = 'binance'"""),

    "silver_hourly": _with(_SILVER, """
SELECT exchange, symbol, "interval", trade_count, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
       CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume,
       close_time, open_time, rate_date, ingested_at FROM silver"""),
    "silver_dedupe_latest": _with(_SILVER, """
SELECT exchange, symbol, "interval", trade_count + CASE exchange WHEN 'binance' THEN 1 ELSE 0 END AS trade_count,
       CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
       CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume, close_time, open_time, rate_date,
       ingested_at + CASE exchange WHEN 'binance' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS ingested_at
FROM silver"""),
    "silver_quality": _with(_FAULTY, _rules("flagged", _LOAD_TESTS)),
    "silver_rejected": _with(_FAULTY, """
SELECT exchange, symbol, open, high, open_time_ms,
       concat_ws(',', CASE WHEN unmatched THEN 'unmatched_symbol' END,
                 CASE WHEN open IS NOT NULL AND o IS NULL THEN 'malformed_open' END,
                 CASE WHEN high IS NOT NULL AND h IS NULL THEN 'malformed_high' END) AS problems
FROM flagged WHERE bad"""),
    "silver_profile": _with(_SILVER, """
SELECT symbol, exchange, CAST(COUNT(*) AS BIGINT) AS "rows", MIN(rate_date) AS min_date, MAX(rate_date) AS max_date
FROM silver GROUP BY symbol, exchange"""),

    "dim_date": _with(_SILVER + _BOUNDS, f"""
SELECT d AS date_id, d AS date, strftime(d, '%d/%m/%Y') AS date_label, {_DAY_COLUMNS}
FROM (SELECT day AS d FROM calendar)"""),
    "dim_datetime": _with(_SILVER + _BOUNDS, f"""
SELECT d AS datetime_id, CAST(d AS DATE) AS date_id, d AS datetime, strftime(d, '%d/%m/%Y %H:00') AS datetime_label,
       {_DAY_COLUMNS}, CAST(hour(d) AS INTEGER) AS "hour",
       CASE WHEN hour(d) < 6 THEN 'Dawn' WHEN hour(d) < 12 THEN 'Morning'
            WHEN hour(d) < 18 THEN 'Afternoon' ELSE 'Night' END AS hour_period
FROM (SELECT hour AS d FROM hours)"""),
    "dim_calendar_fixed_range": """
SELECT CAST(d AS DATE) AS date_id, strftime(d, '%Y-%m') AS year_month, dayofweek(d) IN (0, 6) AS is_weekend, CAST(24 AS BIGINT) AS hours
FROM (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
     generate_series(CAST(lo - 31 AS TIMESTAMP), CAST(hi + 31 AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)""",
    "dim_exchange": _with(_HOURLY, "SELECT DISTINCT exchange_id, exchange_name FROM hourly"),
    "dim_symbol": _with(_HOURLY, "SELECT DISTINCT symbol_id, symbol_name FROM hourly"),
    "dim_symbol_preview": _with(_HOURLY, "SELECT DISTINCT symbol_id, symbol_name FROM hourly"),
    "dim_exchange_list": _with(_SILVER, """
SELECT CAST(COUNT(*) AS BIGINT) AS total, string_agg(exchange, ',' ORDER BY exchange) AS names
FROM (SELECT DISTINCT exchange FROM silver)"""),
    "dim_completeness": _with(_SILVER + _BOUNDS, """
SELECT 'dim_date' AS dimension, CAST(COUNT(*) AS BIGINT) AS total_records, CAST(MIN(day) AS VARCHAR) AS min_value,
       CAST(MAX(day) AS VARCHAR) AS max_value, CAST(datediff('day', MIN(day), MAX(day)) + 1 AS BIGINT) AS expected_records
FROM calendar
UNION ALL
SELECT 'dim_datetime', COUNT(*), CAST(MIN(hour) AS VARCHAR), CAST(MAX(hour) AS VARCHAR),
       datediff('hour', MIN(hour), MAX(hour)) + 1 FROM hours
UNION ALL
SELECT 'Silver reference', COUNT(DISTINCT rate_date), CAST(MIN(rate_date) AS VARCHAR), CAST(MAX(rate_date) AS VARCHAR),
       COUNT(DISTINCT rate_date) FROM silver"""),
    "calendar_flags": _with(_SILVER + _BOUNDS, """
SELECT day AS date_id, day(day) = 1 AS is_month_start, last_day(day) = day AS is_month_end,
       monthname(day) AS month_name, CAST(weekofyear(day) AS INTEGER) AS week_of_year FROM calendar"""),
    "business_hours": _with(_SILVER + _BOUNDS, """
SELECT hour AS datetime_id, CAST(hour(hour) AS INTEGER) AS "hour",
       hour(hour) >= 9 AND hour(hour) < 18 AS is_business_hour FROM hours"""),
    "dim_attributes": _with(_SILVER, """
SELECT exchange AS exchange_name, exchange IN ('binance', 'poloniex') AS is_active, symbol AS symbol_name,
       CASE symbol WHEN 'BTC_USDT' THEN 'Bitcoin' WHEN 'ETH_USDT' THEN 'Ethereum' WHEN 'SOL_USDT' THEN 'Solana'
                   WHEN 'ADA_USDT' THEN 'Cardano' WHEN 'LINK_USDT' THEN 'Chainlink' END AS asset_name,
       CASE symbol WHEN 'BTC_USDT' THEN 'Layer 1' WHEN 'LINK_USDT' THEN 'Oracle'
                   ELSE 'Smart Contract Platform' END AS category,
       CAST(COUNT(*) AS BIGINT) AS row_count
FROM silver GROUP BY exchange, symbol"""),

    "fact_market_hourly": _with(_HOURLY, f"""
SELECT symbol_id, exchange_id, datetime_id, {_FACT_PRICES}, trade_count,
       CAST(ROUND(variation_1h_pct, 6) AS DOUBLE) AS variation_1h_pct, close_time, ingested_at FROM hourly"""),
    "fact_hourly_quality": _with(_HOURLY + """,
faulty AS (
  SELECT CASE WHEN h <> 0 THEN open_price END AS open_price,
         CASE WHEN h = 6 THEN low_price - 1 WHEN h <> 1 THEN high_price END AS high_price,
         CASE WHEN h = 7 THEN high_price + 1 WHEN h <> 2 THEN low_price END AS low_price,
         CASE WHEN h <> 3 THEN close_price END AS close_price,
         CASE WHEN h = 5 THEN 0 WHEN h <> 4 THEN volume END AS volume
  FROM (SELECT *, hour(datetime_id) AS h FROM hourly))""", """
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(COUNT(*) - COUNT(open_price) AS BIGINT) AS null_open, CAST(COUNT(*) - COUNT(high_price) AS BIGINT) AS null_high,
       CAST(COUNT(*) - COUNT(low_price) AS BIGINT) AS null_low, CAST(COUNT(*) - COUNT(close_price) AS BIGINT) AS null_close,
       CAST(COUNT(*) FILTER (WHERE volume IS NULL OR volume <= 0) AS BIGINT) AS invalid_volume,
       CAST(COUNT(*) FILTER (WHERE high_price < low_price) AS BIGINT) AS invalid_high_low,
       CAST(COUNT(*) FILTER (WHERE high_price < open_price) AS BIGINT) AS invalid_high_open,
       CAST(COUNT(*) FILTER (WHERE high_price < close_price) AS BIGINT) AS invalid_high_close,
       CAST(COUNT(*) FILTER (WHERE low_price > open_price) AS BIGINT) AS invalid_low_open,
       CAST(COUNT(*) FILTER (WHERE low_price > close_price) AS BIGINT) AS invalid_low_close
FROM faulty"""),
    "fact_hourly_summary": _with(_HOURLY, """
SELECT CAST(COUNT(*) AS BIGINT) AS total_records, CAST(COUNT(DISTINCT exchange_id) AS BIGINT) AS distinct_exchanges,
       CAST(COUNT(DISTINCT symbol_id) AS BIGINT) AS distinct_symbols,
       CAST(COUNT(DISTINCT datetime_id) AS BIGINT) AS distinct_datetimes,
       MIN(close_time) AS min_datetime, MAX(close_time) AS max_datetime,
       CAST(ROUND(AVG(variation_1h_pct), 2) AS DOUBLE) AS avg_variation_pct FROM hourly"""),
    "fact_market_daily": _with(_DAILY, f"SELECT {_DAILY_COLUMNS} FROM daily"),
    "fact_daily_summary": _with(_DAILY, """
SELECT CAST(COUNT(*) AS BIGINT) AS total_records, CAST(COUNT(DISTINCT exchange_id) AS BIGINT) AS distinct_exchanges,
       CAST(COUNT(DISTINCT symbol_id) AS BIGINT) AS distinct_symbols,
       CAST(COUNT(DISTINCT date_id) AS BIGINT) AS distinct_dates, MIN(date_id) AS min_date, MAX(date_id) AS max_date,
       CAST(ROUND(AVG(variation_daily_pct), 2) AS DOUBLE) AS avg_variation_daily,
       CAST(ROUND(AVG((close_price - prev_close) / NULLIF(prev_close, 0) * 100), 2) AS DOUBLE) AS avg_variation_prev_day
FROM daily"""),
    "daily_prev_gap": _with(_DAILY, """
SELECT exchange_id, symbol_id, date_id,
       CAST(datediff('day', LAG(date_id) OVER (PARTITION BY exchange_id, symbol_id ORDER BY date_id), date_id) AS INTEGER) AS prev_date_gap_days
FROM daily WHERE day(date_id) % 5 <> 0"""),
    "hourly_prev_change": _with(_HOURLY, """
SELECT exchange_id, symbol_id, datetime_id, CAST(before AS DOUBLE) AS prev_close_price,
       CAST(ROUND((close_price - before) / NULLIF(before, 0) * 100, 6) AS DOUBLE) AS variation_prev_hour_pct,
       CAST(datediff('hour', hour_before, datetime_id) AS BIGINT) AS prev_gap_hours
FROM (SELECT *, LAG(close_price) OVER series AS before, LAG(datetime_id) OVER series AS hour_before
      FROM hourly WHERE hour(datetime_id) % 7 <> 0
      WINDOW series AS (PARTITION BY exchange_id, symbol_id ORDER BY datetime_id))"""),
    **{name: _with(_DAILY, f"SELECT {_DAILY_COLUMNS} FROM daily") for name in (
        "warehouse_refresh", "refresh_subset", "refresh_with_corrections", "refresh_after_break")},
    "refresh_new_pairs": _with(_DAILY + """,
known AS (
  SELECT DISTINCT symbol FROM silver WHERE rate_date = (SELECT CAST(MIN(ts) AS DATE) FROM events)
    AND (symbol = 'ETH_USDT' OR (symbol = 'SOL_USDT' AND exchange = 'binance'))),
keyed AS (
  SELECT * REPLACE (CAST(DENSE_RANK() OVER (ORDER BY symbol_name NOT IN (FROM known), symbol_name) AS INTEGER) AS symbol_id)
  FROM daily)""", f"SELECT {_DAILY_COLUMNS} FROM keyed"),
    "refresh_levels": _with(_DAILY + """,
lines AS (
  SELECT 'hourly' AS level, COUNT(*) AS n, COUNT(DISTINCT exchange_id) AS e, COUNT(DISTINCT symbol_id) AS s, COUNT(*) AS p FROM hourly
  UNION ALL SELECT 'daily', COUNT(*), COUNT(DISTINCT exchange_id), COUNT(DISTINCT symbol_id), COUNT(*) FROM daily
  UNION ALL SELECT 'monthly trades', SUM(trade_count), COUNT(DISTINCT exchange_id), COUNT(DISTINCT symbol_id), NULL FROM hourly)""", """
SELECT level, CAST(n AS BIGINT) AS total_records, CAST(e AS BIGINT) AS distinct_exchanges, CAST(s AS BIGINT) AS distinct_symbols,
       CAST(p AS BIGINT) AS processed_rows FROM lines"""),
    "refresh_checks": _with(_CANDLES + """,
held AS (
  SELECT exchange, asset, hour, CAST(hour AS DATE) AS day, high, low, close,
         CASE WHEN EXTRACT(hour FROM hour) <> 9 THEN open END AS open,
         CASE WHEN EXTRACT(hour FROM hour) <> 6 THEN volume END AS volume
  FROM candles WHERE NOT (exchange = 'binance' AND day(hour) = 11)
    AND NOT (exchange = 'poloniex' AND asset = 'BTC' AND EXTRACT(hour FROM hour) = 3)),
asked AS (SELECT CAST(MIN(ts) AS DATE) AS a, CAST(MAX(ts) AS DATE) AS b FROM events),
series AS (SELECT exchange, asset, MIN(day) AS listed, COUNT(DISTINCT day) AS days, COUNT(*) AS hours FROM held GROUP BY ALL),
span AS (SELECT MAX(day) - MIN(day) + 1 AS days, datediff('hour', MIN(hour), MAX(hour)) + 1 AS hours, COUNT(*) AS n,
                COUNT(DISTINCT (exchange, asset, day)) AS daily FROM held),
lines AS (
  SELECT 'missing_' || f AS rule, 'bronze_' || exchange AS subject, 'report' AS severity, COUNT(*) AS total_rows,
         COUNT(*) FILTER (WHERE (f = 'open' AND open IS NULL) OR (f = 'volume' AND volume IS NULL)) AS violations
  FROM held, (SELECT unnest(['""" + "', '".join(_REQUIRED) + """']) AS f) GROUP BY ALL
  UNION ALL
  SELECT 'missing_day', 'bronze_' || exchange, 'report', ANY_VALUE(b - a + 1), ANY_VALUE(b - a + 1) - COUNT(DISTINCT day)
  FROM held, asked GROUP BY exchange
  UNION ALL
  SELECT f, 'fact_market_hourly', 'report', COUNT(*), COUNT(*) FILTER (WHERE CASE f
           WHEN 'null_open' THEN open IS NULL WHEN 'null_high' THEN high IS NULL WHEN 'null_low' THEN low IS NULL
           WHEN 'null_close' THEN close IS NULL WHEN 'invalid_volume' THEN volume IS NULL OR volume <= 0
           WHEN 'invalid_high_low' THEN high < low WHEN 'invalid_high_open' THEN high < open
           WHEN 'invalid_high_close' THEN high < close WHEN 'invalid_low_open' THEN low > open ELSE low > close END)
  FROM held, (SELECT unnest(['null_open', 'null_high', 'null_low', 'null_close', 'invalid_volume', 'invalid_high_low',
                             'invalid_high_open', 'invalid_high_close', 'invalid_low_open', 'invalid_low_close']) AS f)
  GROUP BY ALL
  UNION ALL
  SELECT 'duplicate_key', t, 'gate', CASE t WHEN 'fact_market_daily' THEN daily ELSE n END,
         CASE WHEN t = 'fact_market_daily' THEN 0 ELSE n - (SELECT COUNT(DISTINCT (exchange, asset, hour)) FROM held) END
  FROM span, (SELECT unnest(['silver_hourly', 'fact_market_hourly', 'fact_market_daily']) AS t)
  UNION ALL
  SELECT 'orphan', t, 'report', n, 0 FROM span, (SELECT unnest(['dim_exchange', 'dim_symbol', 'dim_datetime']) AS t)
  UNION ALL
  SELECT 'series_gap', 'silver_hourly', 'report', SUM(span.days), SUM(span.days - series.days) FROM series, span
  UNION ALL
  SELECT 'missing_hour', 'silver_hourly', 'report', SUM(24 * (b - greatest(a, listed) + 1)),
         SUM(24 * (b - greatest(a, listed) + 1) - hours) FROM series, asked
  UNION ALL
  SELECT 'missing_member', 'dim_date', 'report', days, 0 FROM span
  UNION ALL
  SELECT 'missing_member', 'dim_datetime', 'report', hours, 0 FROM span
  UNION ALL
  SELECT 'daily_not_sum_of_hours', 'fact_market_daily', 'report', daily, 0 FROM span)""", """
SELECT rule, subject, severity, CAST(total_rows AS BIGINT) AS total_rows, CAST(violations AS BIGINT) AS violations,
       a AS first_day, b AS last_day FROM lines, asked"""),

    "fk_orphans": _with(_SILVER, """
SELECT 'dim_exchange' AS dimension, CAST(COUNT(DISTINCT exchange) AS BIGINT) AS orphan_values, CAST(COUNT(*) AS BIGINT) AS orphan_rows
FROM silver WHERE exchange NOT IN (SELECT exchange FROM silver WHERE exchange <> 'poloniex')
UNION ALL
SELECT 'dim_symbol', COUNT(DISTINCT symbol), COUNT(*) FROM silver
WHERE symbol NOT IN (SELECT symbol FROM silver WHERE symbol <> 'LINK_USDT')
UNION ALL
SELECT 'dim_datetime', COUNT(DISTINCT open_time), COUNT(*) FROM silver
WHERE open_time NOT IN (SELECT open_time FROM silver WHERE hour(open_time) <> 3)"""),
    "key_duplicates": _with(_DAILY + """,
counted AS (
  SELECT 'silver_twice' AS table_name, COUNT(*) AS n
  FROM (FROM silver UNION ALL FROM silver WHERE exchange = 'binance') GROUP BY exchange, symbol, open_time
  UNION ALL SELECT 'fact_market_hourly', COUNT(*) FROM hourly GROUP BY exchange_id, symbol_id, datetime_id
  UNION ALL SELECT 'fact_market_daily', COUNT(*) FROM daily GROUP BY exchange_id, symbol_id, date_id)""", """
SELECT table_name, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_keys, CAST(SUM(n - 1) AS BIGINT) AS surplus_rows
FROM counted GROUP BY table_name"""),
    "date_gaps": _with(_SILVER + _BOUNDS + _THINNED, """
SELECT exchange, symbol, CAST(ANY_VALUE(n) AS BIGINT) AS calendar_days,
       CAST(ANY_VALUE(n) - COUNT(DISTINCT rate_date) AS BIGINT) AS missing_days
FROM thinned, (SELECT COUNT(*) AS n FROM calendar) GROUP BY exchange, symbol"""),
    "gap_intervals": _with(_SILVER + _BOUNDS + _THINNED + """,
absent AS (
  SELECT s.exchange, s.symbol, c.day,
         c.day - CAST(ROW_NUMBER() OVER (PARTITION BY s.exchange, s.symbol ORDER BY c.day) AS INTEGER) AS island
  FROM (SELECT DISTINCT exchange, symbol FROM thinned) s CROSS JOIN calendar c
  WHERE NOT EXISTS (SELECT 1 FROM thinned t WHERE t.exchange = s.exchange AND t.symbol = s.symbol AND t.rate_date = c.day))""", """
SELECT exchange, symbol, MIN(day) AS first_missing, MAX(day) AS last_missing, CAST(COUNT(*) AS INTEGER) AS missing_days
FROM absent GROUP BY exchange, symbol, island"""),
    "hour_completeness": _with(_SILVER + _BOUNDS + _COMPLETE, "SELECT * FROM complete"),
    "hour_completeness_summary": _with(_SILVER + _BOUNDS + _COMPLETE, """
SELECT exchange, symbol, CAST(COUNT(*) AS BIGINT) AS days, CAST(COUNT(*) FILTER (WHERE hours = 24) AS BIGINT) AS complete_days,
       CAST(24 * COUNT(*) - SUM(hours) AS BIGINT) AS missing_hours
FROM complete GROUP BY exchange, symbol"""),
    "daily_equals_hourly": _with(_DAILY + """,
altered AS (
  SELECT symbol_id, exchange_id, date_id, trade_count, CASE WHEN day(date_id) = 10 THEN volume + 1 ELSE volume END AS volume
  FROM daily WHERE day(date_id) <> 11)""", """
SELECT CAST(COUNT(*) AS BIGINT) AS compared_keys,
       CAST(COUNT(*) FILTER (WHERE h.v IS DISTINCT FROM d.volume OR h.t IS DISTINCT FROM d.trade_count) AS BIGINT) AS mismatched_keys
FROM altered d FULL JOIN (SELECT symbol_id, exchange_id, CAST(datetime_id AS DATE) AS date_id, SUM(volume) AS v, SUM(trade_count) AS t
                          FROM hourly GROUP BY ALL) h
  ON h.symbol_id = d.symbol_id AND h.exchange_id = d.exchange_id AND h.date_id = d.date_id"""),

    "current_price": _with(_DAILY, """
SELECT exchange_name, symbol_name, CAST(close_price AS DOUBLE) AS current_price, date_id AS price_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY exchange_id, symbol_id ORDER BY date_id DESC) AS n FROM daily) WHERE n = 1"""),
    "accumulated_return": _with(_ENDS, """
SELECT exchange_name, symbol_name, CAST(first_price AS DOUBLE) AS first_price, CAST(last_price AS DOUBLE) AS last_price,
       CAST(ROUND(return_pct, 6) AS DOUBLE) AS return_pct FROM returns"""),
    "index_base_100": _with(_DAILY, f"""
SELECT exchange_name, symbol_name, date_id, CAST(close_price AS DOUBLE) AS close_price, CAST(base AS DOUBLE) AS base_price,
       CAST(ROUND(close_price / NULLIF(base, 0) * 100, 6) AS DOUBLE) AS index_100
FROM (SELECT *, FIRST_VALUE(close_price) OVER (PARTITION BY exchange_id, symbol_id ORDER BY date_id) AS base
      FROM daily WHERE {_PERIOD})"""),
    "volume_traded": _with(_DAILY, f"""
SELECT exchange_name, symbol_name, CAST(SUM(volume) AS DOUBLE) AS volume, CAST(SUM(trade_count) AS BIGINT) AS trade_count
FROM daily WHERE {_PERIOD} GROUP BY exchange_name, symbol_name"""),
    "return_over_periods": _with(_DAILY + _PERIODS, """
SELECT period, exchange_name, symbol_name, CAST(first_price AS DOUBLE) AS first_price, CAST(last_price AS DOUBLE) AS last_price,
       CAST(ROUND((last_price - first_price) / NULLIF(first_price, 0) * 100, 6) AS DOUBLE) AS return_pct
FROM (SELECT period, exchange_name, symbol_name, list(close_price ORDER BY date_id)[1] AS first_price, list(close_price ORDER BY date_id)[-1] AS last_price
      FROM daily JOIN periods ON date_id BETWEEN a AND b GROUP BY ALL)"""),
    "volume_over_periods": _with(_DAILY + _PERIODS, """
SELECT period, exchange_name, symbol_name, CAST(SUM(volume) AS DOUBLE) AS volume, CAST(SUM(trade_count) AS BIGINT) AS trade_count
FROM daily JOIN periods ON date_id BETWEEN a AND b GROUP BY ALL"""),
    "index_of_last_days": _with(_DAILY, f"""
SELECT exchange_name, symbol_name, date_id, CAST(close_price AS DOUBLE) AS close_price, CAST(base AS DOUBLE) AS base_price,
       CAST(ROUND(close_price / NULLIF(base, 0) * 100, 6) AS DOUBLE) AS index_100
FROM (SELECT *, FIRST_VALUE(close_price) OVER (PARTITION BY exchange_id, symbol_id ORDER BY date_id) AS base FROM daily)
WHERE date_id >= {_LAST} - 4"""),
    "rank_by_return": _with(_ENDS, """
SELECT CAST(RANK() OVER (ORDER BY return_pct DESC NULLS LAST) AS INTEGER) AS return_rank, exchange_name, symbol_name,
       CAST(ROUND(return_pct, 6) AS DOUBLE) AS return_pct FROM returns"""),
    "rank_by_active_days": _with(_SILVER, """
SELECT exchange, symbol, days, CAST(RANK() OVER (ORDER BY days DESC NULLS LAST) AS INTEGER) AS days_rank
FROM (SELECT exchange, symbol, CASE WHEN symbol <> 'LINK_USDT' THEN CAST(COUNT(DISTINCT rate_date) AS BIGINT) END AS days
      FROM silver GROUP BY exchange, symbol)"""),
    "rank_by_trades": _with(_DAILY, """
SELECT exchange_id, symbol_id, date_id, trades, CAST(RANK() OVER (ORDER BY trades DESC NULLS LAST) AS INTEGER) AS trades_rank
FROM (SELECT *, CASE WHEN day(date_id) % 10 <> 0 THEN trade_count END AS trades FROM daily)"""),
    "data_available_until": "SELECT MAX(CAST(ts AS DATE)) AS available_until FROM events",
    "cross_exchange_price": _with(_DAILY, f"""
SELECT date_id AS date, symbol_name, exchange_name, CAST(close_price AS DOUBLE) AS close_price, CAST(volume AS DOUBLE) AS volume
FROM daily WHERE symbol_name = 'BTC_USDT' AND {_PERIOD}"""),
    "top_volatile_days": _with(_DAILY, f"""
SELECT date_id AS date, symbol_name, exchange_name,
       CAST(ROUND((high_price - low_price) / NULLIF(open_price, 0) * 100, 6) AS DOUBLE) AS volatility_pct,
       CAST(volume AS DOUBLE) AS volume
FROM daily WHERE {_PERIOD}
ORDER BY (high_price - low_price) / NULLIF(open_price, 0) DESC NULLS LAST, date_id, symbol_name, exchange_name LIMIT 5"""),
}

ORACLES |= {
    "altered_days": _with(_DAILY, f"""
SELECT d.symbol_id, d.exchange_id, d.date_id, CAST(d.volume AS DOUBLE) AS hours_volume, d.trade_count AS hours_trades,
       CASE WHEN date_id = {_FIRST} + 4 THEN CAST(d.volume AS DOUBLE) END AS day_volume,
       CASE WHEN date_id = {_FIRST} + 4 THEN d.trade_count + 1 END AS day_trades
FROM daily d WHERE symbol_id = 1 AND exchange_id = 1 AND date_id IN ({_FIRST} + 4, {_FIRST} + 12)"""),
    "sql_daily_variation": _with(_DAILY, f"""
SELECT exchange_name, symbol_name, date_id, CAST(ROUND(variation_daily_pct, 6) AS DOUBLE) AS variation_daily_pct,
       CAST(ROUND((close_price - prev_close) / NULLIF(prev_close, 0) * 100, 6) AS DOUBLE) AS variation_prev_day_pct
FROM daily WHERE {_PERIOD}"""),
    # The same metrics, as SQL and from the days of the largest peaks.
    "top_volatile_by_peaks": ORACLES["top_volatile_days"],
    **{f"sql_{name}": ORACLES[name] for name in (
        "current_price", "accumulated_return", "index_base_100", "volume_traded", "rank_by_return",
        "data_available_until", "cross_exchange_price", "top_volatile_days")},
}

# The same results from the small levels above the facts.
ORACLES |= {
    "hourly_summary_of_cells": ORACLES["fact_hourly_summary"],
    "daily_summary_of_cells": ORACLES["fact_daily_summary"],
    "range_profile_of_days": ORACLES["bronze_range_profile"].replace("FROM bronze", "FROM (SELECT rate_date, substr(asset || '_USDT', 1) AS symbol FROM (SELECT *, CAST(hour AS DATE) AS rate_date FROM candles))"),
}
