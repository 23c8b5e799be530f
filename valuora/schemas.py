"""Declared schemas of the model tables (no inference scans).

Column names follow the vendor files on read (``RAW_*``) and are normalised to
snake_case at the source boundary; the display names come back only at sinks.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Daily price file as staged by the vendor download (one CSV per symbol).
RAW_PRICE = (T.StructType()
             .add("Date", T.DateType(), True)
             .add("Ticker", T.StringType(), True)
             .add("Open", T.DoubleType(), True)
             .add("High", T.DoubleType(), True)
             .add("Low", T.DoubleType(), True)
             .add("Close", T.DoubleType(), True)
             .add("Adj Close", T.DoubleType(), True)
             .add("Volume", T.DoubleType(), True))

PRICE_RENAMES = {"Date": "date", "Ticker": "ticker", "Open": "open", "High": "high",
                 "Low": "low", "Close": "close", "Adj Close": "adj_close", "Volume": "volume"}

# The price table of the model: the same columns under their model names.
PRICE = T.StructType([T.StructField(PRICE_RENAMES[f.name], f.dataType, True) for f in RAW_PRICE.fields])

# Pipe-separated symbol directory.
RAW_SYMBOL_DIRECTORY = (T.StructType()
                        .add("Nasdaq Traded", T.StringType())
                        .add("Symbol", T.StringType())
                        .add("Security Name", T.StringType())
                        .add("Listing Exchange", T.StringType())
                        .add("Market Category", T.StringType())
                        .add("ETF", T.StringType())
                        .add("Round Lot Size", T.DoubleType())
                        .add("Test Issue", T.StringType())
                        .add("Financial Status", T.StringType())
                        .add("CQS Symbol", T.StringType())
                        .add("NASDAQ Symbol", T.StringType())
                        .add("NextShares", T.StringType()))

RAW_COMPANY_INFO = (T.StructType()
                    .add("ticker", T.StringType())
                    .add("company name", T.StringType())
                    .add("short name", T.StringType())
                    .add("industry", T.StringType())
                    .add("description", T.StringType())
                    .add("website", T.StringType())
                    .add("logo", T.StringType())
                    .add("ceo", T.StringType())
                    .add("exchange", T.StringType())
                    .add("market cap", T.DoubleType())
                    .add("sector", T.StringType())
                    .add("tag 1", T.StringType())
                    .add("tag 2", T.StringType())
                    .add("tag 3", T.StringType()))

RAW_PEERS = T.StructType().add("ticker", T.StringType()).add("peer_string", T.StringType())

RAW_DATA_DICTIONARY = (T.StructType()
                       .add("table", T.StringType())
                       .add("column", T.StringType())
                       .add("dtype", T.StringType())
                       .add("source", T.StringType())
                       .add("description", T.StringType()))

# Keys shared by the three annual statements.
STATEMENT_KEYS = ["ticker", "simfin_id", "currency", "fiscal_year"]

# Result columns of the growth and screener tables, in output order.
GROWTH_KPIS = ["roic", "revenue", "eps", "bvps", "fcf"]
SCREENER_COLUMNS = ["ticker", "last_date", "last_low_price", "price_future",
                    "sticker_price", "mos"]


def snake(name: str) -> str:
    """'Adj Close' -> 'adj_close', 'Shares (Basic)' -> 'shares_basic'."""
    out = []
    for ch in name.strip().lower():
        out.append(ch if ch.isalnum() else "_")
    s = "".join(out)
    while "__" in s:
        s = s.replace("__", "_")
    return s.strip("_")


# Types of the model columns that file sources may deliver as text (CSV).
MODEL_TYPES = {
    "fiscal_year": "int", "simfin_id": "bigint", "industry_id": "int",
    "report_date": "date", "report_date_is": "date", "report_date_cf": "date",
    "date": "date", "market_cap": "double",
    "shares_basic": "double", "shares_diluted": "double", "revenue": "double",
    "net_income": "double", "total_equity": "double", "total_liab_equity": "double",
    "net_cash_ops": "double", "net_cash_inv": "double", "dividends_paid": "double",
    "open": "double", "high": "double", "low": "double", "close": "double",
    "adj_close": "double", "volume": "double",
}
