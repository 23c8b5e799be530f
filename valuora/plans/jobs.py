"""Composite jobs: single-market processing, daily refresh, staging symbols, stored run."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.operators import company as C
from valuora.operators import fundamentals as FU
from valuora.operators import growth as G
from valuora.operators import prices as P
from valuora.operators import screen as S
from valuora.operators import states as ST
from valuora.operators import valuation as V
from valuora.schemas import STATEMENT_KEYS
from valuora.session import cut_lineage, together


def statement_keys(model, name: str) -> DataFrame:
    """The key columns of a statement, without its sums where the model can tell them apart."""
    return (model.statement_keys(name) if hasattr(model, "statement_keys")
            else getattr(model, name).select(*STATEMENT_KEYS))


def lows(model) -> DataFrame:
    """Ticker, date and low of the price rows, from what the model has written where it has."""
    return model.lows() if hasattr(model, "lows") else model.price.select("ticker", "date", "low")


def prepare_all(model, peers: bool = False) -> None:
    """What a run reads of statements and prices, written by models that derive both from the same tables."""
    if hasattr(model, "lows"):
        model.prepare(prices=True, peers=peers)


class SingleMarketResult:
    """The result tables of one single-market run, each built on first access.

    Prices are read twice: once for the states (a row per ticker and year that
    gives annual prices, latest dates and figures), and once for the rows on the
    latest dates that the screener lists. ``annual_price`` alone is one read of
    December rows and of the statements' keys.
    """

    def __init__(self, model, company: DataFrame, period, fp: int, exp_rr: float, agg_func: str, materialize: bool):
        self._model, self._company = model, company
        self._period, self._fp, self._exp_rr, self._agg = period, fp, exp_rr, agg_func
        self._cut = cut_lineage if materialize else (lambda df, name: df)
        self._materialize = materialize

    @cached_property
    def _inputs(self) -> tuple[DataFrame, DataFrame]:
        """(KPI fundamentals, price states): what a run makes of statements and prices, written once, side by side."""
        if self._materialize:
            prepare_all(self._model)
        kpi = lambda: self._cut(kpi_fundamentals(self._model, self._period, self._company), "fundamental")
        states = lambda: self._cut(ST.price_states(lows(self._model)), "price_states")
        return tuple(together(kpi, states) if self._materialize else (kpi(), states()))

    @property
    def fund_kpi(self) -> DataFrame:
        """KPI fundamentals before the narrowing to priced tickers."""
        return self._inputs[0]

    @property
    def states(self) -> DataFrame:
        """Price states of all tickers."""
        return self._inputs[1]

    @cached_property
    def tickers(self) -> DataFrame:
        """Tickers with fundamentals. As long as those are not written, from the statements' keys alone."""
        if "_inputs" in self.__dict__:
            return self.fund_kpi.select("ticker").distinct()
        keys = [P.period_filter(statement_keys(self._model, n), *self._period) for n in ("income", "cashflow", "balance")]
        both = keys[0].join(keys[1], STATEMENT_KEYS, "left_semi").join(keys[2], STATEMENT_KEYS, "left_semi")
        return FU.restrict(both.select("ticker").distinct(), self._company.select("ticker"))

    @cached_property
    def price(self) -> DataFrame:
        """All price rows of the tickers with fundamentals."""
        return FU.restrict(self._model.price, self.tickers)

    @cached_property
    def dates(self) -> DataFrame:
        """(ticker, last_date) of the priced tickers with fundamentals."""
        return FU.restrict(ST.dates_of(self.states), self.tickers)

    @cached_property
    def annual_price(self) -> DataFrame:
        if "_inputs" in self.__dict__:
            return FU.restrict(ST.annual_of(self.states, *self._period), self.tickers)
        return FU.restrict(P.annual_price(self._model.price, *self._period, how="mean"), self.tickers)

    @cached_property
    def fundamental(self) -> DataFrame:
        return priced_fundamentals(self.fund_kpi, self.states, self._period)

    @cached_property
    def growth(self) -> DataFrame:
        return valued_growth(self.fundamental, self._agg, self._fp, self._exp_rr)

    @cached_property
    def screener(self) -> DataFrame:
        return self.screener_of(self.growth)

    def screener_of(self, growth: DataFrame) -> DataFrame:
        """The screener from a growth table, such as the stored one."""
        return S.screener(self._model.price, growth, self.dates, self._materialize)

    @cached_property
    def company_info(self) -> DataFrame:
        if hasattr(self._model, "peers"):
            return C.company_with_peers(self._company, self._model.peers)
        return self._company


def priced_fundamentals(fund_kpi: DataFrame, states: DataFrame, period) -> DataFrame:
    """KPI fundamentals of the priced tickers with the annual price and P/E."""
    fund = FU.restrict(fund_kpi, states.select("ticker").distinct())
    return FU.add_annual_pe(fund, ST.annual_of(states, *period))


def valued_growth(fundamental: DataFrame, agg_func: str, fp: int, exp_rr: float) -> DataFrame:
    return V.sticker_price(G.growth_rates(fundamental, agg_func), fp, exp_rr)


def companies_for(model, symbols: DataFrame | None = None, market: str | None = None) -> DataFrame:
    """Company information of the wanted symbols, of one market if given."""
    company = C.company_info_for(model.company_info, symbols)
    if market is not None:
        in_market = model.ticker_market.where(F.col("market") == market).select("ticker")
        company = C.company_info_for(company, in_market)
    return company


def kpi_fundamentals(model, period: tuple[int | None, int | None], company: DataFrame) -> DataFrame:
    """Merged statements of the period with their KPIs.

    The company-symbol narrowing is one semi join on the merged statements
    (the inner joins already keep only tickers present in all three).
    """
    if hasattr(model, "prepare"):
        model.prepare()
    fund = FU.combine_statements(model.income, model.cashflow, model.balance)
    fund = P.period_filter(fund, period[0], period[1])
    return FU.add_kpis(FU.restrict(fund, company.select("ticker")))


def fundamentals_for(model, period: tuple[int | None, int | None],
                     symbols: DataFrame | None = None,
                     market: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(company_info, KPI fundamentals) of the single-market run, before price narrowing."""
    company = companies_for(model, symbols, market)
    return company, kpi_fundamentals(model, period, company)


def single_market(model, period: tuple[int | None, int | None], fp: int = V.DEFAULT_FP,
                  exp_rr: float = V.DEFAULT_EXP_RR, symbols: DataFrame | None = None,
                  agg_func: str = "mean", market: str | None = None,
                  materialize: bool = True) -> SingleMarketResult:
    """The processing pipeline of one market.

    Symbol narrowing is a chain of semi joins instead of driver-side lists:
    company tickers -> statements -> price states of those tickers ->
    fundamentals of priced tickers. Nothing is collected. With
    ``materialize=True`` (default) the small tables that several steps read
    (fundamentals, price states, valued tickers) are written once when they are
    first needed; ``materialize=False`` builds the same plan without running
    anything.
    """
    return SingleMarketResult(model, companies_for(model, symbols, market), period, fp, exp_rr, agg_func, materialize)


def daily_refresh(price_batch: DataFrame, growth: DataFrame) -> DataFrame:
    """Yesterday's valuation against today's price files: the screener on the batch.

    The batch is reduced to its latest date per ticker, narrowed to the valued
    tickers of the stored growth table and joined back.
    """
    return S.screener(price_batch, growth)


def staging_symbols(model) -> DataFrame:
    """The narrowed symbol list of the staging run: directory filter -> company info ->
    tickers present in all three statements."""
    universe = C.symbol_universe(model.symbol_directory)
    company = C.company_info_for(model.company_info, universe)
    stmt = FU.common_tickers(model.income, model.cashflow, model.balance)
    return company.select("ticker").join(stmt, "ticker", "left_semi").distinct()
