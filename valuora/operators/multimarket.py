"""Multi-market valuation table (the variant with its own semantics).

Differences to the single-market pipeline, kept on purpose:
* no fiscal-year period filter and no company-symbol narrowing;
* the annual price is the *lowest* December low (still named mean_low_price);
* fundamentals and prices are restricted to their shared tickers;
* of several prices on a ticker's latest date the lowest counts, so a ticker
  has one row in the result;
* the result is the growth table with the latest price, four flags and the
  company/industry attributes instead of a filtered screener.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.functions.num import false_if_null, ieee_div, round2
from valuora.operators import fundamentals as FU
from valuora.operators import growth as G
from valuora.operators import prices as P
from valuora.operators import states as ST
from valuora.operators import valuation as V
from valuora.operators.quality import one_row_per_key
from valuora.session import cut_lineage, together

DEFAULT_EXCLUDED = ("it", "ca")
OUT_OF_BOUNDS_PCT = 3500


def kept_markets(markets: DataFrame, excluded) -> DataFrame:
    """Market ids minus the excluded ones (a NOT IN on a literal list, pushed to the scan)."""
    return markets.select("market_id").distinct().where(~F.col("market_id").isin(list(excluded)))


def kept_ticker_market(ticker_market: DataFrame, markets: DataFrame) -> DataFrame:
    """(ticker, market) of the kept markets."""
    return ticker_market.join(markets.select(F.col("market_id").alias("market")), "market",
                              "left_semi")


def tag_market(df: DataFrame, ticker_market: DataFrame, markets: DataFrame) -> DataFrame:
    """Attach the ``market`` of each ticker, keeping only kept markets.

    Equivalent to loading one source per market, adding ``lit(market)`` and
    appending; here the market comes from the data in one scan. A ticker listed
    in two kept markets would repeat its rows, so it fails the query.
    """
    tm = one_row_per_key(kept_ticker_market(ticker_market, markets).select("ticker", "market"),
                         ["ticker"], "ticker_market")
    return df.join(tm, "ticker", "inner")


def union_markets(frames: dict[str, DataFrame]) -> DataFrame:
    """Per-market frames tagged with ``lit(market)`` and appended by name.

    Columns missing in some frames are filled with NULL, like a name-aligned
    concat. For sources stored one folder per market.
    """
    out = None
    for m, df in frames.items():
        tagged = df.withColumn("market", F.lit(m))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def companies_with_industry(companies: DataFrame, industries: DataFrame) -> DataFrame:
    """companies LEFT JOIN industries on industry_id; a repeated industry fails the query."""
    return companies.join(one_row_per_key(industries, ["industry_id"], "industries"), "industry_id", "left")


def price_flags(growth: DataFrame, latest: DataFrame,
                limit_pct: float = OUT_OF_BOUNDS_PCT) -> DataFrame:
    """growth LEFT JOIN latest price (one row per ticker), then the four screening flags.

    mos_reached / out_off_bounds_value are False (not NULL) when an operand is missing.
    """
    g = growth.join(latest.select("ticker", "last_low_price"), "ticker", "left")
    mos, low = F.col("mos"), F.col("last_low_price")
    pct = F.lit(100.0) * round2(ieee_div(mos - low, low))
    return g.withColumns({"mos_reached": false_if_null(mos >= low),
                          "diff_price_mos": mos - low,
                          "diff_price_mos_percentage": pct,
                          "out_off_bounds_value": false_if_null(pct > limit_pct)})


def multi_market_inputs(model, excluded=DEFAULT_EXCLUDED,
                        materialize: bool = True) -> dict[str, DataFrame]:
    """Statements of the kept markets' priced tickers, and what the later steps read.

    Prices are never narrowed row by row: one read reduces them to a state per
    ticker and year, and the other tickers are dropped then. The growth table reads
    them a second time, for the rows on the latest dates.
    """
    cut = cut_lineage if materialize else (lambda df, name: df)
    markets = kept_markets(model.markets, excluded)

    def merged() -> DataFrame:
        if hasattr(model, "prepare"):
            model.prepare()
        tm = cut(model.ticker_market, "ticker_market")
        return cut(FU.combine_statements(*[tag_market(s, tm, markets) for s in
                                           (model.income, model.cashflow, model.balance)]), "mm_fundamental")

    if materialize and hasattr(model, "lows"):
        model.prepare(prices=True)
    lows = model.lows() if hasattr(model, "lows") else model.price
    steps = merged, lambda: cut(ST.price_states(lows), "mm_states")
    fund, states = together(*steps) if materialize else [s() for s in steps]
    states = FU.restrict(states, fund.select("ticker").distinct())
    fund = FU.restrict(fund, states.select("ticker").distinct())
    return {"markets": markets, "fundamental_raw": fund, "price": model.price, "lows": lows,
            "companies": kept_companies(model, excluded), "states": states}


def kept_companies(model, excluded=DEFAULT_EXCLUDED) -> DataFrame:
    """Companies of the kept markets with their industry, one row per ticker."""
    markets = kept_markets(model.markets, excluded)
    return one_row_per_key(companies_with_industry(
        model.companies.join(markets.select(F.col("market_id").alias("market")), "market",
                             "left_semi"),
        model.industries), ["ticker"], "companies")


def flagged(rates: DataFrame, price: DataFrame, states: DataFrame, companies: DataFrame, fp: int, exp_rr: float) -> DataFrame:
    """The growth table with valuation, lowest latest price, flags and company data."""
    g = V.sticker_price(rates, fp, exp_rr)
    latest = P.lowest_latest_price(price, ST.dates_of(states))
    return price_flags(g, latest).join(companies, "ticker", "left")


class MultiMarketResult:
    """Tables of a multi-market run, built on first access (``res["growth"]`` or
    ``res.growth``): a caller that needs the restricted inputs or the annual
    price does not pay for planning the growth table."""

    def __init__(self, inp: dict, fp: int, exp_rr: float, agg_func: str):
        self._inp, self._fp, self._exp_rr, self._agg = inp, fp, exp_rr, agg_func
        self.price, self.companies, self.markets = inp["price"], inp["companies"], inp["markets"]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def annual_price(self) -> DataFrame:
        return ST.annual_of(self._inp["states"], how="min")

    @cached_property
    def fundamental(self) -> DataFrame:
        return FU.add_annual_pe(FU.add_kpis(self._inp["fundamental_raw"]), self.annual_price)

    @property
    def fundamental_raw(self) -> DataFrame:
        return self._inp["fundamental_raw"]

    @cached_property
    def growth_rates(self) -> DataFrame:
        return G.growth_rates(self.fundamental, self._agg)

    @cached_property
    def growth(self) -> DataFrame:
        return flagged(self.growth_rates, self._inp["lows"], self._inp["states"], self.companies, self._fp, self._exp_rr)


def multi_market(model, excluded=DEFAULT_EXCLUDED, fp: int = V.DEFAULT_FP,
                 exp_rr: float = V.DEFAULT_EXP_RR, agg_func: str = "mean",
                 materialize: bool = True) -> MultiMarketResult:
    """fundamental, annual_price, growth (with flags and company data), price, companies,
    markets -- by key or attribute.

    ``materialize=False`` builds the plan without running anything (no lineage
    cut, so joins are planned from estimates).
    """
    return MultiMarketResult(multi_market_inputs(model, excluded, materialize), fp, exp_rr,
                             agg_func)


DASHBOARD_COLUMNS = ["market", "sector", "industry", "company_name", "ticker", "mos",
                     "last_low_price", "diff_price_mos", "diff_price_mos_percentage",
                     "mos_reached", "out_off_bounds_value"]


def dashboard_view(growth: DataFrame) -> DataFrame:
    return growth.select(*DASHBOARD_COLUMNS)
