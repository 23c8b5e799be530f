"""Screener: latest price at or below the margin of safety, and evaluation filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.operators.prices import at_dates, latest_dates
from valuora.session import cut_lineage
from valuora.schemas import SCREENER_COLUMNS

VALUATION_COLUMNS = ["ticker", "price_future", "sticker_price", "mos"]


def screener(price: DataFrame, growth: DataFrame, dates: DataFrame | None = None,
             materialize: bool = True) -> DataFrame:
    """Tickers whose latest low price is <= mos; ties on the latest date are all kept.

    ``dates`` (ticker, last_date) may be passed when the caller already
    aggregated it; otherwise prices are reduced to one row per ticker first.
    Only valued tickers (mos present) can pass, so the dates are narrowed to
    them; that per-ticker table is written once, and the join back to the price
    rows is planned from its measured size. ``materialize=False`` only builds
    the plan. The final ``na.drop`` also removes NaN, as in the reference.
    """
    valued = growth.select(*VALUATION_COLUMNS).where(F.col("mos").isNotNull())
    side = (latest_dates(price) if dates is None else dates).join(valued, "ticker", "inner")
    if materialize:
        side = cut_lineage(side, "valued")
    out = (at_dates(price, side)
           .where(F.col("last_low_price") <= F.col("mos"))
           .select(*SCREENER_COLUMNS))
    return out.na.drop()


def extreme_ratio(screen: DataFrame, ratio: float = 10.0) -> DataFrame:
    """Screener rows with mos / last_low_price > ratio (a zero price never qualifies)."""
    r = F.col("mos") / F.when(F.col("last_low_price") != 0, F.col("last_low_price"))
    return screen.where(r > ratio)


def mos_outliers(growth: DataFrame, low: float = 0.1, high: float = 1e10) -> DataFrame:
    """Growth rows whose mos is implausibly small or large."""
    return growth.where((F.col("mos") <= low) | (F.col("mos") >= high))
