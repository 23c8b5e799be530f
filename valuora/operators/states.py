"""Mergeable price states: one pass over prices, updated by a day's files.

A state row per (ticker, calendar year) holds what the steps of a run aggregate
over the prices: how many rows there are and from when to when, and sum, count and
minimum of the December lows. Each is a number or a date, so the aggregate is a
hash aggregate in generated code, and each can be merged with another one, so

* a run reads the price table once for its annual prices, latest dates and
  freshness figures (a ticker holding a third of all rows is a row per year and
  task before the shuffle), and a second time only for the rows on those dates;
* a stored table of states takes a day's files in without the history behind it
  being read again (``merge_states``).

Defined results: rows without a date count in a state of the null year and have
no part in annual or latest prices; a null low counts as a row and adds nothing,
a NaN low makes its December's sum NaN, as it does an average's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.operators.prices import period_filter

KEYS = ["ticker", "year"]


def price_states(price: DataFrame) -> DataFrame:
    """(ticker, year, n_rows, first_date, last_date, dec_rows, dec_n, dec_sum, dec_min)."""
    december = F.month("date") == 12
    of_december = F.when(december, F.col("low"))
    return (price.withColumn("year", F.year("date")).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count(F.when(december, 1)).alias("dec_rows"), F.count(of_december).alias("dec_n"),
        F.sum(of_december).alias("dec_sum"), F.min(of_december).alias("dec_min")))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state per (ticker, year) of several tables of states."""
    rows = reduce(lambda a, b: a.unionByName(b), states)
    return (rows.groupBy(*KEYS).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.sum("dec_rows").alias("dec_rows"), F.sum("dec_n").alias("dec_n"), F.sum("dec_sum").alias("dec_sum"),
        F.min("dec_min").alias("dec_min")))


def annual_of(states: DataFrame, start_year: int | None = None, end_year: int | None = None, how: str = "mean") -> DataFrame:
    """The annual price per (year, ticker), as ``prices.annual_price`` gives it from price rows."""
    value = {"mean": F.col("dec_sum") / F.when(F.col("dec_n") > 0, F.col("dec_n")), "min": F.col("dec_min")}[how]
    return (period_filter(states.where(F.col("dec_rows") > 0), start_year, end_year, "year")
            .select("year", "ticker", value.alias("mean_low_price")))


def dates_of(states: DataFrame) -> DataFrame:
    """(ticker, last_date) of the priced tickers."""
    return states.groupBy("ticker").agg(F.max("last_date").alias("last_date"))


def price_figures(states: DataFrame) -> DataFrame:
    """Row count, tickers and date range of the prices behind the states, in one row."""
    return states.agg(F.sum("n_rows").alias("n_rows"), F.count_distinct("ticker").alias("n_symbols"),
                      F.min("first_date").alias("min_date"), F.max("last_date").alias("max_date"))
