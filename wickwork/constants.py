"""Fixed values that decide results: feed formats, table layouts, labels.

Nothing here is logic. Each value must stay as it is, because stored tables
and landed payloads depend on it.
"""

from __future__ import annotations

# --- fixed values: exchanges and their feeds --------------------------------
BINANCE = "binance"
POLONIEX = "poloniex"

# Pairs that the daily load asks for, in each exchange's own spelling.
BINANCE_SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "ADAUSDT", "LINKUSDT"]
POLONIEX_SYMBOLS = ["BTC_USDT", "ETH_USDT", "SOL_USDT", "ADA_USDT", "LINK_USDT"]

BINANCE_INTERVAL = "1h"
POLONIEX_INTERVAL = "HOUR_1"

# A binance pair is BASE followed by one of four quote currencies.
BINANCE_PAIR = r"^([A-Z]+)(USDT|USDC|BTC|ETH)$"

# Position of each kept field in one candle array of the payload.
BINANCE_POSITIONS = {
    "open_time_ms": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "close_time_ms": 6,
    "trade_count": 8,
}
POLONIEX_POSITIONS = {
    "low": 0,
    "high": 1,
    "open": 2,
    "close": 3,
    "volume": 5,
    "trade_count": 8,
    "interval": 11,
    "open_time_ms": 12,
    "close_time_ms": 13,
}
# Extra fields of the wide poloniex row.
POLONIEX_WIDE_POSITIONS = {
    "quote_asset_volume": 4,
    "taker_buy_quote_volume": 6,
    "taker_buy_base_volume": 7,
}

# --- fixed values: table layouts --------------------------------------------
PRICE_TYPE = "decimal(18,8)"
PRICE_FIELDS = ["open", "high", "low", "close", "volume"]

BRONZE_COLUMNS = [
    "close", "close_time_ms", "high", "interval", "low", "open", "open_time_ms",
    "symbol", "trade_count", "volume", "ingested_at", "rate_date",
]
SILVER_COLUMNS = [
    "exchange", "symbol", "interval", "trade_count", "open", "high", "low", "close",
    "volume", "close_time", "open_time", "rate_date", "ingested_at",
]
HOURLY_COLUMNS = [
    "symbol_id", "exchange_id", "datetime_id", "open_price", "high_price", "low_price",
    "close_price", "volume", "trade_count", "variation_1h_pct", "close_time", "ingested_at",
]
DAILY_COLUMNS = [
    "symbol_id", "exchange_id", "date_id", "open_price", "high_price", "low_price",
    "close_price", "volume", "trade_count", "variation_daily_pct",
    "variation_prev_day_pct", "close_time", "ingested_at",
]

# --- fixed values: calendar labels ------------------------------------------
DATE_LABEL = "dd/MM/yyyy"
HOUR_LABEL = "dd/MM/yyyy HH:00"
MONTH_LABEL = "yyyy-MM"
WEEKEND_DAYS = [1, 7]  # Sunday and Saturday, as dayofweek() counts them

# Part of the day by the last hour it includes.
HOUR_PERIODS = [(5, "Dawn"), (11, "Morning"), (17, "Afternoon"), (23, "Night")]

BUSINESS_HOURS = (9, 17)  # 9h up to, but not including, 18h

# --- fixed values: planned attributes of the dimensions ---------------------
ASSETS = [
    ("BTC", "Bitcoin", "Layer 1"),
    ("ETH", "Ethereum", "Smart Contract Platform"),
    ("SOL", "Solana", "Smart Contract Platform"),
    ("ADA", "Cardano", "Smart Contract Platform"),
    ("LINK", "Chainlink", "Oracle"),
]
ACTIVE_EXCHANGES = [BINANCE, POLONIEX]
