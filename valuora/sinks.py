"""Sinks: result tables, dated snapshots, CSV exports, per-symbol files, profiles.

Result tables are written as
Parquet folders (gzip when asked, like the reference's ``.parquet.gzip``);
dated snapshots use a ``snapshot_date`` partition with dynamic overwrite, so
re-running a day replaces only that day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from valuora.sources import folders

# Display names of the reference tables, applied only at the sink.
DISPLAY_NAMES = {
    "ticker": "Ticker", "date": "Date", "open": "Open", "high": "High", "low": "Low",
    "close": "Close", "adj_close": "Adj Close", "volume": "Volume",
    "fiscal_year": "Fiscal Year", "simfin_id": "SimFinId", "currency": "Currency",
    "revenue": "Revenue", "net_income": "Net Income", "shares_basic": "Shares (Basic)",
    "total_equity": "Total Equity", "total_liab_equity": "Total Liabilities & Equity",
    "net_cash_ops": "Net Cash from Operating Activities",
    "net_cash_inv": "Net Cash from Investing Activities", "dividends_paid": "Dividends Paid",
    "dividends_paid_clean": "Dividends Paid_clean",
    "market_id": "MarketId", "industry_id": "IndustryId",
}


def display(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    names = names or DISPLAY_NAMES
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def write_table(df: DataFrame, path: str, compression: str = "gzip",
                partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_results(tables: dict[str, DataFrame], base: str, compression: str = "gzip") -> None:
    """One Parquet folder per result table (company_info, fundamental, growth, screener)."""
    for name, df in tables.items():
        write_table(df, f"{base.rstrip('/')}/{name}", compression)


def write_snapshot(df: DataFrame, base: str, table: str, date: _dt.date | str) -> None:
    """Append/replace the ``snapshot_date=<date>`` partition of ``base/table``."""
    d = date if isinstance(date, _dt.date) else _dt.date.fromisoformat(str(date))
    (df.withColumn("snapshot_date", F.lit(d))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("snapshot_date")
       .parquet(f"{base.rstrip('/')}/{table}"))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header (the spreadsheet export), one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


MAX_ROWS_PER_FILE = 5_000_000   # price rows: ~128 MB of Parquet


def write_price_table(price: DataFrame, path: str) -> None:
    """The price table layout for scale: one folder per trading ``date``, rows
    clustered by ticker inside.

    ``month(date) = 12`` (annual price) is then a partition filter, and the
    join back on (ticker, date = last_date) gets dynamic partition pruning:
    only the folders of the latest dates are read. The write is range
    partitioned on (date, ticker), so a day holding a third of all rows is
    still split over several tasks; AQE sizes the tasks from what was shuffled
    and a file takes ``MAX_ROWS_PER_FILE`` rows at most. Loading a day replaces
    only that day's folder.
    """
    # dynamic overwrite on the writer itself, whatever the session default is
    (price.repartitionByRange("date", "ticker").sortWithinPartitions("date", "ticker")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
       .partitionBy("date").parquet(path))


def by_symbol(df: DataFrame, *keys: str) -> DataFrameWriter:
    """A writer of one folder per value of the first key, rows ranged by all of them.

    What a file costs is opening it, not its bytes: the number of ranges is given,
    as Spark would otherwise join ranges of few bytes until one task opens every
    file. Each task moves its own files into place when it is done, instead of the
    driver moving all of them one after the other at the end.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
            .write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(keys[0]))


def write_per_key(df: DataFrame, path: str, *keys: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder of files (CSV with header, or lines of text) per value of the first key, rows ranged by all keys.

    ``overwrite`` replaces all that was in ``path``, ``replace`` the folders of values that
    are written, ``append`` none. On a local file system Python tasks open the files, elsewhere
    Spark's writer does.
    """
    cols = [c for c in df.columns if c != keys[0]]
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cols])) if fmt == "csv" else F.col(cols[0])
    if folders.write_by_key(df, path, keys[0], list(keys), line, {"csv": "csv", "text": "txt"}[fmt],
                            ",".join(cols) if fmt == "csv" else None, mode):
        return
    w = by_symbol(df, *keys).mode("append" if mode == "append" else "overwrite")
    w = w.option("partitionOverwriteMode", "static" if mode == "overwrite" else "dynamic")
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)


def write_per_symbol_csv(price: DataFrame, path: str) -> None:
    """One folder of CSV files per symbol (``Ticker=<sym>/``), the staged-file layout.

    Rows are ranged by (ticker, date): most symbols end up in one file, and one
    that holds a third of the rows is spread over several tasks.
    """
    by_value = price.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    write_per_key(price, path, "ticker", "date", mode="replace" if by_value else "overwrite")


def write_profile(profile: DataFrame, path: str) -> None:
    """The profile table (one row per column) as JSON lines."""
    profile.write.mode("overwrite").json(path)
