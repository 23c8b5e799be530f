"""Price-side operators: annual December price, latest price, price statistics."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def period_filter(df: DataFrame, start_year: int | None, end_year: int | None,
                  year_col: str = "fiscal_year") -> DataFrame:
    """Inclusive year range on an integer year column."""
    cond = F.lit(True)
    if start_year is not None:
        cond = cond & (F.col(year_col) >= start_year)
    if end_year is not None:
        cond = cond & (F.col(year_col) <= end_year)
    return df.where(cond)


def december_rows(price: DataFrame, start_year: int | None = None,
                  end_year: int | None = None) -> DataFrame:
    """December rows of the period, with ``year``.

    The year range is also written as a date range on the raw column so that
    it reaches the Parquet scan as a pushed filter (``year(date)`` and
    ``month(date)`` are not sargable).
    """
    df = price
    if start_year is not None:
        df = df.where(F.col("date") >= F.lit(_dt.date(start_year, 12, 1)))
    if end_year is not None:
        df = df.where(F.col("date") <= F.lit(_dt.date(end_year, 12, 31)))
    df = df.where(F.month("date") == 12).withColumn("year", F.year("date"))
    return period_filter(df, start_year, end_year, "year")


def annual_price(price: DataFrame, start_year: int | None = None,
                 end_year: int | None = None, how: str = "mean",
                 ordered: bool = False) -> DataFrame:
    """Annual price per (year, ticker) from December lows.

    ``how='mean'`` is the single-market definition (mean December low inside
    the period); ``how='min'`` is the multi-market one (lowest December low,
    usually without a period). Both are named ``mean_low_price`` like the
    reference tables. Hash aggregation with a map-side partial step, so a hot
    ticker is combined before the shuffle.
    """
    agg = {"mean": F.avg, "min": F.min}[how]
    out = (december_rows(price, start_year, end_year)
           .groupBy("year", "ticker")
           .agg(agg("low").alias("mean_low_price")))
    return out.orderBy("year", "ticker") if ordered else out


def latest_rows(df: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """All rows on each key's latest ``order`` value (ties kept).

    ``rank() = 1`` is planned with a partial WindowGroupLimit before the
    exchange: every map task keeps only its own latest rows per key, so a
    ticker holding a third of the table never reaches one reducer whole.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1).drop("_rk")


def latest_dates(price: DataFrame) -> DataFrame:
    """(ticker, last_date): hash aggregation with a map-side partial max, so a
    ticker holding a third of the rows is reduced to one row per task before
    the shuffle. Its tickers are also the set of priced tickers."""
    return price.groupBy("ticker").agg(F.max("date").alias("last_date"))


def at_dates(price: DataFrame, dates: DataFrame) -> DataFrame:
    """Price rows on each ticker's ``last_date`` (all rows of a tie), as an equi-join
    on (ticker, date). ``dates`` has one row per ticker; when it is a written
    table, its file size lets Spark stream the price table through a broadcast
    hash join if it is small, and otherwise join on (ticker, date), a key that
    spreads a hot ticker over its days. On a date-partitioned price table
    (``sinks.write_price_table``) Spark adds a dynamic partition pruning filter
    when the ``dates`` side carries a selective filter, so only the latest
    dates' partitions are read."""
    px = price.select("ticker", "date", "low")
    return (px.join(dates, (px.ticker == dates.ticker) & (px.date == dates.last_date), "inner")
              .drop(dates.ticker)
              .select("ticker", "last_date", F.col("low").alias("last_low_price"),
                      *[c for c in dates.columns if c not in ("ticker", "last_date")]))


def latest_price(price: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Low price on each ticker's latest date; several rows on that date are all kept.

    Without ``dates`` prices are read once: each task keeps its own latest rows of
    a ticker (``latest_rows``). With them, those dates' rows are picked by a join.
    """
    if dates is None:
        return latest_rows(price.select("ticker", "date", "low")).select(
            "ticker", F.col("date").alias("last_date"), F.col("low").alias("last_low_price"))
    return at_dates(price, dates)


def lowest_latest_price(price: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """(ticker, last_low_price): one row per ticker, the lowest low of its latest date."""
    return latest_price(price, dates).groupBy("ticker").agg(F.min("last_low_price").alias("last_low_price"))


def price_stats(price: DataFrame) -> DataFrame:
    """Row count, distinct tickers and date range in one scan (A5-A7)."""
    return price.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_distinct("ticker").alias("n_tickers"),
                     F.min("date").alias("min_date"),
                     F.max("date").alias("max_date"))


def distinct_tickers(df: DataFrame, col: str = "ticker") -> DataFrame:
    return df.select(F.col(col).alias("ticker")).where(F.col("ticker").isNotNull()).distinct()
