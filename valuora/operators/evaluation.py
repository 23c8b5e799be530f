"""Evaluation helpers: cross-checks of computed tables against independent plans."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.functions.num import round_dp
from valuora.operators.prices import annual_price


def verify_december_mean(price: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Annual mean December low next to the same mean computed from a plain
    date-range filter (``to_date`` literals), per (year, ticker), at 6 dp.

    The two columns must agree for every row; any difference points at the
    period or month logic.
    """
    a = annual_price(price, start_year, end_year, how="mean")
    v = (price.where(F.col("date").between(F.lit(_dt.date(start_year, 12, 1)),
                                           F.lit(_dt.date(end_year, 12, 31)))
                     & (F.month("date") == 12))
         .groupBy("ticker", F.year("date").alias("year"))
         .agg(F.avg("low").alias("mean_by_range")))
    return (a.join(v, ["ticker", "year"])
            .select("year", "ticker", round_dp(F.col("mean_low_price"), 6).alias("mean_low_price"),
                    round_dp(F.col("mean_by_range"), 6).alias("mean_by_range")))
