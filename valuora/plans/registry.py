"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every query reads the driver's tables (through the adapters) and returns a
DataFrame; small tables that several steps read are written on the way (see
``session.cut_lineage``). Computed columns carry the same alias in Spark and SQL. Doubles that
come out of an order-dependent floating aggregate (averages of prices, ratios
built on them) are reported rounded to 6 dp in both engines, and statistics or
``pow`` results of any magnitude at 12 significant digits, so both sides hash
the same value; everything else is reported exactly as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora.functions.num import round_dp
from valuora.operators import company as C
from valuora.operators import evaluation as E
from valuora.operators import filters as FL
from valuora.operators import fundamentals as FU
from valuora.operators import growth as G
from valuora.operators import multimarket as MM
from valuora.operators import prices as P
from valuora.operators import quality as Q
from valuora.operators import screen as S
from valuora.plans import oracle as O
from valuora.plans import jobs as PL
from valuora.plans import stored as SR
from valuora.plans.model import TestdataModel

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, O.sql(oracle) if oracle else None)
        return fn
    return deco


def r6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, round_dp(F.col(c), 6))
    return df


def sig12(df: DataFrame, *cols: str) -> DataFrame:
    """Report a double at 12 significant digits (any magnitude): values that
    differ only in the last bit -- e.g. ``pow`` of the JVM vs the C library --
    print and parse back to the same double."""
    for c in cols:
        x = F.col(c)
        df = df.withColumn(c, F.when(x.isNotNull(),
                                     F.format_string("%.12g", x).cast("double")))
    return df


def model(spark: SparkSession, sf_dir: str) -> TestdataModel:
    return TestdataModel(spark, sf_dir)


def _scratch(spark, name: str) -> str:
    """A new folder below this application's written tables (removed with them)."""
    import uuid
    from valuora.session import _tables_folder
    return f"{_tables_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored_run(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored single-market run on these tables.

    The first query of an application that asks runs the processing job; for later
    ones the run's manifest says that its tables are finished and of the same files.
    """
    import hashlib
    from valuora.session import _tables_folder
    base = f"{_tables_folder(spark)}/runs/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    SR.run_and_store(model(spark, sf_dir), f"{base}/single", O.PERIOD)
    return f"{base}/single"


def stored_multi(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored multi-market run on these tables, made as ``stored_run`` makes its own."""
    import hashlib
    from valuora.session import _tables_folder
    base = f"{_tables_folder(spark)}/runs/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    SR.store_multi(model(spark, sf_dir), f"{base}/multi", O.EXCLUDED_MARKETS)
    return f"{base}/multi"


def run_single(spark: SparkSession, sf_dir: str, agg_func: str = "mean") -> PL.SingleMarketResult:
    return PL.single_market(model(spark, sf_dir), O.PERIOD, agg_func=agg_func)


# ---------------------------------------------------------------- prices

@query("price_scan", """
SELECT date, ticker, open, high, low, close, adj_close, volume FROM price""")
def q_price_scan(spark, sf):
    return model(spark, sf).price


@query("price_stats", """
SELECT count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers,
       min(date) AS min_date, max(date) AS max_date FROM price""")
def q_price_stats(spark, sf):
    return P.price_stats(model(spark, sf).price)


@query("annual_price_mean", f"""
SELECT year, ticker, {O.r6('mean_low_price')} AS mean_low_price FROM annual_mean
ORDER BY year, ticker""")
def q_annual_price_mean(spark, sf):
    annual = run_single(spark, sf).annual_price
    return r6(annual, "mean_low_price").orderBy("year", "ticker")


@query("latest_price", """
SELECT ticker, date AS last_date, low AS last_low_price
FROM (SELECT ticker, date, low, rank() OVER (PARTITION BY ticker ORDER BY date DESC) AS rk
      FROM price) x WHERE rk = 1""")
def q_latest_price(spark, sf):
    return P.latest_price(model(spark, sf).price)


# ---------------------------------------------------------------- fundamentals

@query("fundamentals_combine", "SELECT * FROM fundamental_raw")
def q_fundamentals_combine(spark, sf):
    m = model(spark, sf)
    return FU.combine_statements(m.income, m.cashflow, m.balance)


def _kpis(spark, sf):
    return PL.fundamentals_for(model(spark, sf), O.PERIOD)[1]


@query("kpi_roic", "SELECT ticker, fiscal_year, dividends_paid_clean, roic FROM fundamental_kpi")
def q_kpi_roic(spark, sf):
    return _kpis(spark, sf).select("ticker", "fiscal_year", "dividends_paid_clean", "roic")


@query("kpi_eps", "SELECT ticker, fiscal_year, net_income, shares_basic, eps FROM fundamental_kpi")
def q_kpi_eps(spark, sf):
    return _kpis(spark, sf).select("ticker", "fiscal_year", "net_income", "shares_basic", "eps")


@query("kpi_bvps", "SELECT ticker, fiscal_year, total_equity, shares_basic, bvps FROM fundamental_kpi")
def q_kpi_bvps(spark, sf):
    return _kpis(spark, sf).select("ticker", "fiscal_year", "total_equity", "shares_basic", "bvps")


@query("kpi_fcf", "SELECT ticker, fiscal_year, net_cash_ops, net_cash_inv, fcf FROM fundamental_kpi")
def q_kpi_fcf(spark, sf):
    return _kpis(spark, sf).select("ticker", "fiscal_year", "net_cash_ops", "net_cash_inv", "fcf")


@query("top5_kpi", "SELECT * FROM fundamental_kpi")
def q_top5_kpi(spark, sf):
    return _kpis(spark, sf)


@query("annual_pe", f"""
SELECT * REPLACE ({O.r6('mean_low_price')} AS mean_low_price, {O.r6('pe')} AS pe)
FROM fundamental""")
def q_annual_pe(spark, sf):
    return r6(run_single(spark, sf).fundamental, "mean_low_price", "pe")


# ---------------------------------------------------------------- growth

@query("kpi_growth_yoy", f"""
SELECT * REPLACE ({O.r6('pe')} AS pe) FROM growth_rows""")
def q_kpi_growth_yoy(spark, sf):
    return r6(G.kpi_growth(run_single(spark, sf).fundamental), "pe")


@query("growth_summary", "SELECT * FROM growth_summary")
def q_growth_summary(spark, sf):
    return G.growth_summary(G.kpi_growth(run_single(spark, sf).fundamental), "mean")


@query("growth_rates_mean", "SELECT * FROM growth_mean")
def q_growth_rates_mean(spark, sf):
    return G.growth_rates(run_single(spark, sf).fundamental, "mean")


@query("growth_rates_median", "SELECT * FROM growth_median")
def q_growth_rates_median(spark, sf):
    return G.growth_rates(run_single(spark, sf).fundamental, "median")


@query("sticker_price", f"""
SELECT * REPLACE ({O.sig12('eps_future')} AS eps_future) FROM growth""")
def q_sticker_price(spark, sf):
    return sig12(run_single(spark, sf).growth, "eps_future")


# ---------------------------------------------------------------- screener

@query("screener", "SELECT * FROM screener")
def q_screener(spark, sf):
    return run_single(spark, sf).screener


@query("screener_single_market", "SELECT * FROM sm_screener")
def q_screener_single_market(spark, sf):
    """The single-market pipeline run for one market's tickers (a market parameter)."""
    return PL.single_market(model(spark, sf), O.PERIOD, market=O.SINGLE_MARKET).screener


@query("screener_median", "SELECT * FROM screener_median")
def q_screener_median(spark, sf):
    return run_single(spark, sf, "median").screener


# ---------------------------------------------------------------- sources / narrowing

@query("price_symbol_prune", "SELECT * FROM price_used")
def q_price_symbol_prune(spark, sf):
    return run_single(spark, sf).price


@query("distinct_tickers", "SELECT DISTINCT ticker FROM price")
def q_distinct_tickers(spark, sf):
    return P.distinct_tickers(model(spark, sf).price)


@query("symbol_universe", "SELECT ticker FROM symbol_universe")
def q_symbol_universe(spark, sf):
    return C.symbol_universe(model(spark, sf).symbol_directory)


@query("symbol_funnel", """
SELECT count(*) AS n_all,
       count(CASE WHEN test_issue = 'N' THEN 1 END) AS n_not_test,
       count(CASE WHEN test_issue = 'N' AND (financial_status IS NULL OR financial_status = 'N')
             THEN 1 END) AS n_not_bankrupt,
       count(CASE WHEN test_issue = 'N' AND (financial_status IS NULL OR financial_status = 'N')
                   AND etf = 'N' THEN 1 END) AS n_not_etf
FROM symbol_directory""")
def q_symbol_funnel(spark, sf):
    return C.symbol_funnel(model(spark, sf).symbol_directory)


@query("company_info_scan", "SELECT * FROM company_universe")
def q_company_info_scan(spark, sf):
    m = model(spark, sf)
    return C.company_info_for(m.company_info, C.symbol_universe(m.symbol_directory))


@query("company_single_market", """
SELECT DISTINCT ticker, company_name FROM companies WHERE market = 'EUROPE'""")
def q_company_single_market(spark, sf):
    m = model(spark, sf)
    return m.companies.where(F.col("market") == "EUROPE").select("ticker", "company_name").distinct()


@query("statement_scan", """
SELECT * FROM (SELECT 'income' AS statement, x.* FROM mm_income x WHERE market IN ('AMERICA', 'ASIA')
UNION ALL BY NAME SELECT 'cashflow' AS statement, x.* FROM mm_cashflow x WHERE market IN ('AMERICA', 'ASIA')
UNION ALL BY NAME SELECT 'balance' AS statement, x.* FROM mm_balance x WHERE market IN ('AMERICA', 'ASIA')) s""")
def q_statement_scan(spark, sf):
    """The three statements of all markets stored by statement, variant and market; two markets are read back."""
    from valuora.sources.files import read_statement
    out, columns = _stored_statements(spark, sf)
    return _statements(lambda n: read_statement(spark, out, n, "AMERICA").unionByName(read_statement(spark, out, n, "ASIA")), columns)


def _stored_statements(spark, sf) -> tuple[str, dict[str, list[str]]]:
    """The three statements of all markets, annual ones beside others, written by statement, variant and market."""
    m = model(spark, sf)
    out = _scratch(spark, "statements")
    tables = {"income": m.income, "cashflow": m.cashflow, "balance": m.balance}
    stored = None
    for n, s in tables.items():
        s = s.withColumn("statement", F.lit(n))
        both = s.withColumn("variant", F.lit("annual")).unionByName(
            s.withColumns({"variant": F.lit("restated"), "fiscal_year": F.col("fiscal_year") + 1000}))
        stored = both if stored is None else stored.unionByName(both, allowMissingColumns=True)
    stored.join(m.ticker_market, "ticker").write.partitionBy("statement", "variant", "market").parquet(out)
    return out, {n: s.columns for n, s in tables.items()}


def _statements(read, columns: dict[str, list[str]]) -> DataFrame:
    found = None
    for n, cols in columns.items():
        part = read(n).select(F.lit(n).alias("statement"), "market", *cols)
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found


@query("multi_market_statements", """
SELECT * FROM (SELECT 'income' AS statement, x.* FROM mm_income x
UNION ALL BY NAME SELECT 'cashflow' AS statement, x.* FROM mm_cashflow x
UNION ALL BY NAME SELECT 'balance' AS statement, x.* FROM mm_balance x) s""")
def q_multi_market_statements(spark, sf):
    """The stored statements of the kept markets: folders of other variants and of excluded markets are not read."""
    from valuora.sources.files import read_statement
    out, columns = _stored_statements(spark, sf)
    kept = MM.kept_markets(model(spark, sf).markets, O.EXCLUDED_MARKETS)
    return _statements(lambda n: read_statement(spark, out, n, markets=kept), columns)


@query("peer_string_agg", "SELECT ticker, peer_string FROM peers")
def q_peer_string_agg(spark, sf):
    return model(spark, sf).peers


def _peer_summary(df: DataFrame) -> DataFrame:
    pl = F.col("peer_list")
    return (df.withColumn("n_peers", F.when(pl.isNotNull(), F.size(pl)).cast("bigint"))
              .withColumn("first_peer", F.element_at(pl, 1))
              .withColumn("last_peer", F.element_at(pl, -1))
              .drop("peer_list"))


@query("peer_list", """
SELECT ticker, peer_string, len(string_split(peer_string, ',')) AS n_peers,
       string_split(peer_string, ',')[1] AS first_peer,
       string_split(peer_string, ',')[-1] AS last_peer
FROM peers WHERE ticker IN (SELECT ticker FROM company_universe)""")
def q_peer_list(spark, sf):
    m = model(spark, sf)
    symbols = C.company_info_for(m.company_info, C.symbol_universe(m.symbol_directory))
    return _peer_summary(C.with_peer_list(FU.restrict(m.peers, symbols.select("ticker"))))


@query("company_with_peers", """
SELECT c.*, p.peer_string, len(string_split(p.peer_string, ',')) AS n_peers,
       string_split(p.peer_string, ',')[1] AS first_peer,
       string_split(p.peer_string, ',')[-1] AS last_peer
FROM company_info c LEFT JOIN peers p ON c.ticker = p.ticker""")
def q_company_with_peers(spark, sf):
    m = model(spark, sf)
    return _peer_summary(C.company_with_peers(m.company_info, m.peers))


@query("common_tickers", "SELECT ticker FROM statement_tickers")
def q_common_tickers(spark, sf):
    m = model(spark, sf)
    return FU.common_tickers(m.income, m.cashflow, m.balance)


@query("staging_symbols", "SELECT ticker FROM staging_symbols")
def q_staging_symbols(spark, sf):
    return PL.staging_symbols(model(spark, sf))


RESUME_KEY = "700"


@query("staging_resume", f"""
SELECT * FROM (
  SELECT 'resume' AS reason, ticker FROM (SELECT DISTINCT ticker FROM price) s
  WHERE ticker >= '{RESUME_KEY}'
  UNION ALL
  SELECT 'missing' AS reason, ticker FROM staging_symbols
  WHERE ticker NOT IN (SELECT ticker FROM price)) x
ORDER BY reason, ticker""")
def q_staging_resume(spark, sf):
    m = model(spark, sf)
    staged = P.distinct_tickers(m.price)
    resume = staged.where(F.col("ticker") >= RESUME_KEY).select(F.lit("resume").alias("reason"), "ticker")
    missing = (PL.staging_symbols(m).join(staged, "ticker", "left_anti")
               .select(F.lit("missing").alias("reason"), "ticker"))
    return resume.unionByName(missing).orderBy("reason", "ticker")


@query("price_ingest_audit", """
SELECT ticker, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
FROM price GROUP BY ticker""")
def q_price_ingest_audit(spark, sf):
    from valuora.sources.files import ingest_audit
    return ingest_audit(model(spark, sf).price)


@query("stats_append", """
SELECT ticker, market_cap, sector, market, DATE '2021-06-01' AS download_date
FROM company_info WHERE market IN ('AMERICA', 'ASIA')
UNION ALL
SELECT ticker, market_cap, sector, market, DATE '2021-06-02' AS download_date
FROM company_info WHERE market NOT IN ('AMERICA', 'ASIA')""")
def q_stats_append(spark, sf):
    """Two downloads that together cover every market, appended with their dates."""
    import datetime as dt
    ci = model(spark, sf).company_info.select("ticker", "market_cap", "sector", "market")
    first = F.col("market").isin("AMERICA", "ASIA")
    b1 = ci.where(first).withColumn("download_date", F.lit(dt.date(2021, 6, 1)))
    b2 = ci.where(~first).withColumn("download_date", F.lit(dt.date(2021, 6, 2)))
    return b1.unionByName(b2, allowMissingColumns=True)


# ---------------------------------------------------------------- filters / evaluation

@query("filter_symbols", """
SELECT * FROM fundamental_kpi WHERE ticker IN (SELECT ticker FROM symbol_universe)""")
def q_filter_symbols(spark, sf):
    m = model(spark, sf)
    return FU.restrict(_kpis(spark, sf), C.symbol_universe(m.symbol_directory))


@query("filter_period", f"""
SELECT * FROM fundamental_raw WHERE fiscal_year BETWEEN {O.NARROW_PERIOD[0]} AND {O.NARROW_PERIOD[1]}""")
def q_filter_period(spark, sf):
    m = model(spark, sf)
    return P.period_filter(FU.combine_statements(m.income, m.cashflow, m.balance), *O.NARROW_PERIOD)


@query("last_n_years", f"""
SELECT * REPLACE ({O.r6('pe')} AS pe) FROM growth_rows
QUALIFY fiscal_year > max(fiscal_year) OVER (PARTITION BY ticker) - 3""")
def q_last_n_years(spark, sf):
    return r6(G.last_n_years(G.kpi_growth(run_single(spark, sf).fundamental), 3), "pe")


@query("current_year_kpi", """
SELECT ticker, revenue_gr AS revenue_gr_curr, eps AS eps_curr FROM growth_rows
QUALIFY fiscal_year = max(fiscal_year) OVER (PARTITION BY ticker)""")
def q_current_year_kpi(spark, sf):
    rows = G.current_year(G.kpi_growth(run_single(spark, sf).fundamental))
    return rows.select("ticker", F.col("revenue_gr").alias("revenue_gr_curr"),
                       F.col("eps").alias("eps_curr"))


@query("extreme_ratio", "SELECT * FROM extremes")
def q_extreme_ratio(spark, sf):
    return S.extreme_ratio(run_single(spark, sf).screener)


GROWTH_FIRST20 = ["ticker", "revenue_gr_curr", "eps_curr", "roic_gr_5yr", "revenue_gr_5yr",
                  "eps_gr_5yr", "bvps_gr_5yr", "fcf_gr_5yr", "pe_5yr", "yrs_in_5yr",
                  "rule1_gr_5yr", "pe_default_5yr", "roic_gr_10yr", "revenue_gr_10yr",
                  "eps_gr_10yr", "bvps_gr_10yr", "fcf_gr_10yr", "pe_10yr", "yrs_in_10yr",
                  "rule1_gr_10yr"]


@query("extreme_growth_detail", f"""
SELECT {', '.join(GROWTH_FIRST20)} FROM growth WHERE ticker IN (SELECT ticker FROM extremes)""")
def q_extreme_growth_detail(spark, sf):
    r = run_single(spark, sf)
    g = FU.restrict(r.growth, S.extreme_ratio(r.screener).select("ticker"))
    return g.select(*g.columns[:20])


@query("ticker_history", f"""
SELECT * REPLACE ({O.r6('mean_low_price')} AS mean_low_price, {O.r6('pe')} AS pe)
FROM fundamental WHERE ticker IN (SELECT ticker FROM extremes)
ORDER BY ticker, fiscal_year""")
def q_ticker_history(spark, sf):
    r = run_single(spark, sf)
    h = FU.restrict(r.fundamental, S.extreme_ratio(r.screener).select("ticker"))
    return r6(h, "mean_low_price", "pe").orderBy("ticker", "fiscal_year")


MOS_BOUNDS = (0.5, 1000.0)   # bounds that rows of the test data exceed on both sides


@query("mos_outliers", f"""
SELECT * REPLACE ({O.sig12('eps_future')} AS eps_future) FROM growth
WHERE mos <= {MOS_BOUNDS[0]} OR mos >= {MOS_BOUNDS[1]}""")
def q_mos_outliers(spark, sf):
    return sig12(S.mos_outliers(run_single(spark, sf).growth, *MOS_BOUNDS), "eps_future")


@query("preview_top", """
SELECT * FROM screener ORDER BY mos DESC, ticker, last_date, last_low_price LIMIT 5""")
def q_preview_top(spark, sf):
    return (run_single(spark, sf).screener
            .orderBy(F.col("mos").desc(), "ticker", "last_date", "last_low_price").limit(5))


@query("preview_tail", f"""
SELECT year, ticker, {O.r6('mean_low_price')} AS mean_low_price FROM annual_mean
ORDER BY year DESC, ticker DESC LIMIT 5""")
def q_preview_tail(spark, sf):
    """Last rows of the ordered annual price table (a tail is a descending head)."""
    a = run_single(spark, sf).annual_price
    return r6(a.orderBy(F.col("year").desc(), F.col("ticker").desc()).limit(5), "mean_low_price")


@query("verify_december_mean", f"""
SELECT a.year, a.ticker, {O.r6('a.mean_low_price')} AS mean_low_price,
       {O.r6('v.mean_by_range')} AS mean_by_range
FROM annual_mean a JOIN (
  SELECT ticker, CAST(year(date) AS INTEGER) AS year, avg(low) AS mean_by_range FROM price_used
  WHERE date BETWEEN DATE '{O.PERIOD[0]}-12-01' AND DATE '{O.PERIOD[1]}-12-31' AND month(date) = 12
  GROUP BY ticker, year(date)) v ON a.ticker = v.ticker AND a.year = v.year""")
def q_verify_december_mean(spark, sf):
    return E.verify_december_mean(run_single(spark, sf).price, *O.PERIOD)


# ---------------------------------------------------------------- enrichment

@query("growth_enriched", f"""
SELECT g.* REPLACE ({O.sig12('g.eps_future')} AS eps_future), c.company_name, c.industry, c.sector,
       c.market, c.market_cap
FROM growth g LEFT JOIN company_info c ON g.ticker = c.ticker""")
def q_growth_enriched(spark, sf):
    r = run_single(spark, sf)
    return C.enrich(sig12(r.growth, "eps_future"), model(spark, sf).company_info)


@query("screener_enriched", """
SELECT s.*, c.company_name, c.industry, c.sector, c.market, c.market_cap
FROM screener s LEFT JOIN company_info c ON s.ticker = c.ticker""")
def q_screener_enriched(spark, sf):
    return C.enrich(run_single(spark, sf).screener, model(spark, sf).company_info)


@query("fundamental_enriched", f"""
SELECT f.* REPLACE ({O.r6('f.mean_low_price')} AS mean_low_price, {O.r6('f.pe')} AS pe),
       c.company_name, c.industry, c.sector, c.market, c.market_cap
FROM fundamental f LEFT JOIN company_info c ON f.ticker = c.ticker""")
def q_fundamental_enriched(spark, sf):
    r = run_single(spark, sf)
    return C.enrich(r6(r.fundamental, "mean_low_price", "pe"), model(spark, sf).company_info)


# ---------------------------------------------------------------- data quality

@query("join_cardinality_check", """
SELECT 'income' AS check_name, concat_ws('|', ticker, CAST(simfin_id AS VARCHAR), currency,
       CAST(fiscal_year AS VARCHAR)) AS key, count(*) AS n
FROM income GROUP BY ticker, simfin_id, currency, fiscal_year HAVING count(*) > 1
UNION ALL
SELECT 'cashflow', concat_ws('|', ticker, CAST(simfin_id AS VARCHAR), currency,
       CAST(fiscal_year AS VARCHAR)), count(*)
FROM cashflow GROUP BY ticker, simfin_id, currency, fiscal_year HAVING count(*) > 1
UNION ALL
SELECT 'balance', concat_ws('|', ticker, CAST(simfin_id AS VARCHAR), currency,
       CAST(fiscal_year AS VARCHAR)), count(*)
FROM balance GROUP BY ticker, simfin_id, currency, fiscal_year HAVING count(*) > 1
UNION ALL
SELECT 'company_info', ticker, count(*) FROM company_info GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'peers', ticker, count(*) FROM peers GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'companies', ticker, count(*) FROM companies GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'industries', CAST(industry_id AS VARCHAR), count(*) FROM industries GROUP BY industry_id HAVING count(*) > 1
UNION ALL
SELECT 'ticker_market', ticker, count(*) FROM ticker_market GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'annual_price', concat_ws('|', CAST(year AS VARCHAR), ticker), count(*)
FROM annual_mean GROUP BY year, ticker HAVING count(*) > 1
UNION ALL
SELECT 'latest_price', ticker, count(*) FROM (
  SELECT ticker, rank() OVER (PARTITION BY ticker ORDER BY date DESC) AS rk FROM price) x
WHERE rk = 1 GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'price', concat_ws('|', CAST(date AS VARCHAR), ticker), count(*)
FROM price GROUP BY date, ticker HAVING count(*) > 1""")
def q_join_cardinality_check(spark, sf):
    m = model(spark, sf)
    from valuora.schemas import STATEMENT_KEYS as K
    return Q.cardinality_report({
        "income": (m.income, K), "cashflow": (m.cashflow, K), "balance": (m.balance, K),
        "company_info": (m.company_info, ["ticker"]), "peers": (m.peers, ["ticker"]),
        "companies": (m.companies, ["ticker"]), "industries": (m.industries, ["industry_id"]),
        "ticker_market": (m.ticker_market, ["ticker"]),
        "annual_price": (run_single(spark, sf).annual_price, ["year", "ticker"]),
        "latest_price": (P.latest_price(m.price), ["ticker"]),
        "price": (m.price, ["date", "ticker"])})


@query("dq_symbol_counts", """
SELECT 'price' AS table_name, count(DISTINCT ticker) AS n_symbols FROM price_used
UNION ALL SELECT 'company_info', count(DISTINCT ticker) FROM company_info
UNION ALL SELECT 'fundamental', count(DISTINCT ticker) FROM fundamental
UNION ALL SELECT 'growth', count(DISTINCT ticker) FROM growth
UNION ALL SELECT 'screener', count(DISTINCT ticker) FROM screener""")
def q_dq_symbol_counts(spark, sf):
    """Distinct tickers of the stored tables and of the prices behind them: figures of the stored run."""
    return SR.figures(spark, stored_run(spark, sf), ("price", *SR.RESULTS)).select("table_name", "n_symbols")


@query("dq_symbol_coverage", """
SELECT 'income' AS table_name, count(DISTINCT ticker) AS n_symbols FROM income
  WHERE ticker IN (SELECT ticker FROM symbol_universe)
UNION ALL SELECT 'cashflow', count(DISTINCT ticker) FROM cashflow
  WHERE ticker IN (SELECT ticker FROM symbol_universe)
UNION ALL SELECT 'balance', count(DISTINCT ticker) FROM balance
  WHERE ticker IN (SELECT ticker FROM symbol_universe)""")
def q_dq_symbol_coverage(spark, sf):
    m = model(spark, sf)
    return Q.coverage(C.symbol_universe(m.symbol_directory),
                      {"income": m.income, "cashflow": m.cashflow, "balance": m.balance})


@query("dq_freshness", """
SELECT 'price' AS table_name, min(date) AS min_date, max(date) AS max_date,
       NULL::INTEGER AS min_fiscal_year, NULL::INTEGER AS max_fiscal_year FROM price_used
UNION ALL
SELECT 'fundamental', NULL, NULL, min(fiscal_year), max(fiscal_year) FROM fundamental""")
def q_dq_freshness(spark, sf):
    """How fresh the stored run is: date range of its prices, fiscal years of its fundamentals."""
    return SR.figures(spark, stored_run(spark, sf), ("price", "fundamental")).select(
        "table_name", "min_date", "max_date", "min_fiscal_year", "max_fiscal_year")


# ---------------------------------------------------------------- profiling

DESCRIBE_PCTS = (0.03, 0.04, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99)


def _describe_sql(src: str, col: str, pcts) -> str:
    from valuora.operators.profile import pct_label
    stats = [("count", f"CAST(count({col}) AS DOUBLE)"), ("mean", f"avg({col})"),
             ("std", f"stddev_samp({col})"), ("min", f"min({col})")]
    stats += [(pct_label(p), f"quantile_cont({col}, {p!r})") for p in sorted(set(pcts) | {0.5})]
    stats.append(("max", f"max({col})"))
    parts = [f"SELECT {i} AS pos, '{n}' AS stat, {O.sig12('CAST(' + e + ' AS DOUBLE)')} AS value FROM {src}"
             for i, (n, e) in enumerate(stats)]
    return "\nUNION ALL\n".join(parts)


@query("describe_mos", _describe_sql("growth", "mos", DESCRIBE_PCTS))
def q_describe_mos(spark, sf):
    from valuora.operators.profile import describe
    return sig12(describe(run_single(spark, sf).growth, "mos", DESCRIBE_PCTS), "value")


SCREENER_DESCRIBE_PCTS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95)


@query("describe_screener_mos", _describe_sql("screener", "mos", SCREENER_DESCRIBE_PCTS))
def q_describe_screener_mos(spark, sf):
    from valuora.operators.profile import describe
    return sig12(describe(run_single(spark, sf).screener, "mos", SCREENER_DESCRIBE_PCTS), "value")


GROWTH_NUMERIC = (["revenue_gr_curr", "eps_curr"]
                  + [f"{k}_{n}yr" for n in (5, 10) for k in [*O.GR, "yrs_in", "rule1_gr", "pe_default"]]
                  + ["pe_future", "eps_future", "price_future", "sticker_price", "mos"])
STATEMENT_NUMERIC = ["simfin_id", "fiscal_year", "shares_basic_is", "revenue", "net_income", "shares_basic_cf",
                     "net_cash_ops", "net_cash_inv", "dividends_paid", "shares_basic", "total_equity",
                     "total_liab_equity"]
STATEMENT_TEXT = ["ticker", "currency", "fiscal_period_is", "report_date_is", "fiscal_period_cf", "report_date_cf",
                  "fiscal_period", "report_date"]


def _long(src: str, cols, kind: str) -> str:
    return "(" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS {kind}) AS value FROM {src}" for c in cols) + ")"


def _top_sql(long: str) -> str:
    return f"""(SELECT column_name, value AS top_value, freq AS top_freq FROM (
             SELECT column_name, value, count(*) AS freq,
                    row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS rn
             FROM {long} l2 WHERE value IS NOT NULL GROUP BY column_name, value) x WHERE rn = 1)"""


def _profile_sql(src: str, numeric, text) -> str:
    """One row per column: moments and quartiles of numeric ones, extremes as text of the others."""
    num, txt = _long(src, numeric, "DOUBLE"), _long(src, text, "VARCHAR")
    none = "NULL::DOUBLE"
    numbers = f"""
SELECT s.column_name, n, n_missing, {O.sig12('n_missing * 100.0 / n')} AS missing_pct, n_distinct, n_zeros,
       {O.sig12('min')} AS min, {O.sig12('max')} AS max, {O.sig12('mean')} AS mean, {O.sig12('std')} AS std,
       {O.sig12('p25')} AS p25, {O.sig12('p50')} AS p50, {O.sig12('p75')} AS p75, {O.sig12('t.top_value')} AS top_value,
       NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text, NULL::VARCHAR AS top_text, t.top_freq
FROM (SELECT column_name, count(*) AS n, count(*) - count(value) AS n_missing,
             count(DISTINCT value) AS n_distinct, count(CASE WHEN value = 0 THEN 1 END) AS n_zeros,
             min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_samp(value) AS std,
             quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
             quantile_cont(value, 0.75) AS p75
      FROM {num} l GROUP BY column_name) s
LEFT JOIN {_top_sql(num)} t ON s.column_name = t.column_name""" if numeric else ""
    words = f"""
SELECT s.column_name, n, n_missing, {O.sig12('n_missing * 100.0 / n')} AS missing_pct, n_distinct, NULL::BIGINT AS n_zeros,
       {none} AS min, {none} AS max, {none} AS mean, {none} AS std, {none} AS p25, {none} AS p50, {none} AS p75,
       {none} AS top_value, min_text, max_text, t.top_value AS top_text, t.top_freq
FROM (SELECT column_name, count(*) AS n, count(*) - count(value) AS n_missing, count(DISTINCT value) AS n_distinct,
             min(value) AS min_text, max(value) AS max_text
      FROM {txt} l GROUP BY column_name) s
LEFT JOIN {_top_sql(txt)} t ON s.column_name = t.column_name""" if text else ""
    return " UNION ALL ".join(x for x in (numbers, words) if x)


def _profile(df: DataFrame) -> DataFrame:
    from valuora.operators.profile import column_profile
    return sig12(column_profile(df), "missing_pct", "min", "max", "mean", "std", "p25", "p50", "p75", "top_value")


@query("column_profile", _profile_sql("(SELECT * REPLACE (" + O.sig12("eps_future") + " AS eps_future) FROM growth)",
                                      GROWTH_NUMERIC, ["ticker"]))
def q_column_profile(spark, sf):
    """Every column of the growth table."""
    return _profile(sig12(run_single(spark, sf).growth, "eps_future"))


@query("statement_profile", _profile_sql("fundamental_raw", STATEMENT_NUMERIC, STATEMENT_TEXT))
def q_statement_profile(spark, sf):
    """Every column of the merged statements."""
    m = model(spark, sf)
    return _profile(FU.combine_statements(m.income, m.cashflow, m.balance))


@query("company_profile", _profile_sql("company_info", ["market_cap"],
                                       ["ticker", "company_name", "industry", "sector", "market"]))
def q_company_profile(spark, sf):
    """Every column of the company information."""
    return _profile(model(spark, sf).company_info)


# ---------------------------------------------------------------- multi-market

def run_multi(spark, sf):
    return MM.multi_market(model(spark, sf), O.EXCLUDED_MARKETS)


@query("market_exclusion", "SELECT market_id FROM mm_markets")
def q_market_exclusion(spark, sf):
    return MM.kept_markets(model(spark, sf).markets, O.EXCLUDED_MARKETS)


@query("company_industry", "SELECT * FROM company_industry")
def q_company_industry(spark, sf):
    m = model(spark, sf)
    return MM.companies_with_industry(m.companies, m.industries)


@query("multi_market_union", """
SELECT ticker, simfin_id, company_name, industry_id, market FROM companies
WHERE market IN (SELECT market_id FROM mm_markets)""")
def q_multi_market_union(spark, sf):
    """One frame per kept market, tagged with its market and appended."""
    m = model(spark, sf)
    comp, tm = m.companies.drop("market"), m.ticker_market
    kept = [r.market_id for r in MM.kept_markets(m.markets, O.EXCLUDED_MARKETS).collect()]   # a market a row
    frames = {mk: comp.join(tm.where(F.col("market") == mk), "ticker", "left_semi") for mk in sorted(kept)}
    return MM.union_markets(frames)


@query("multi_market_prices", "SELECT * FROM mm_price")
def q_multi_market_prices(spark, sf):
    m = model(spark, sf)
    return MM.tag_market(m.price, m.ticker_market, MM.kept_markets(m.markets, O.EXCLUDED_MARKETS))


@query("mutual_semi", "SELECT * FROM mm_fundamental_raw")
def q_mutual_semi(spark, sf):
    return MM.multi_market_inputs(model(spark, sf), O.EXCLUDED_MARKETS)["fundamental_raw"]


@query("annual_price_min", "SELECT * FROM mm_annual_min")
def q_annual_price_min(spark, sf):
    return run_multi(spark, sf)["annual_price"]


@query("multi_market_growth", f"""
SELECT * REPLACE ({O.sig12('eps_future')} AS eps_future) FROM mm_growth""")
def q_multi_market_growth(spark, sf):
    return sig12(run_multi(spark, sf)["growth"], "eps_future")


@query("dashboard_view", """
SELECT market, sector, industry, company_name, ticker, mos, last_low_price, diff_price_mos,
       diff_price_mos_percentage, mos_reached, out_off_bounds_value FROM mm_growth""")
def q_dashboard_view(spark, sf):
    return MM.dashboard_view(run_multi(spark, sf)["growth"])


def _dash(spark, sf):
    return MM.dashboard_view(run_multi(spark, sf)["growth"])


@query("filter_categorical", """
SELECT * FROM (SELECT market, sector, industry, company_name, ticker, mos, last_low_price,
  diff_price_mos, diff_price_mos_percentage, mos_reached, out_off_bounds_value FROM mm_growth) d
WHERE market IN ('AMERICA', 'ASIA') AND mos_reached IN (true)""")
def q_filter_categorical(spark, sf):
    return FL.apply_filters(_dash(spark, sf), [("market", "categorical", ["AMERICA", "ASIA"]),
                                                ("mos_reached", "categorical", [True])])


@query("filter_numeric_range", """
SELECT * FROM (SELECT market, sector, industry, company_name, ticker, mos, last_low_price,
  diff_price_mos, diff_price_mos_percentage, mos_reached, out_off_bounds_value FROM mm_growth) d
WHERE mos BETWEEN 1.0 AND 100000.0""")
def q_filter_numeric_range(spark, sf):
    return FL.apply_filters(_dash(spark, sf), [("mos", "numeric", (1.0, 100000.0))])


@query("filter_date_range", """
SELECT * REPLACE (try_cast(CAST(report_date AS VARCHAR) AS TIMESTAMP) AS report_date)
FROM fundamental_raw
WHERE try_cast(CAST(report_date AS VARCHAR) AS TIMESTAMP)
      BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'""")
def q_filter_date_range(spark, sf):
    import datetime as dt
    m = model(spark, sf)
    fund = FU.combine_statements(m.income, m.cashflow, m.balance)
    # the dashboard sees text: coerce it to timezone-free timestamps first
    fund = FL.coerce_datetimes(fund.withColumn("report_date", F.col("report_date").cast("string")),
                               ["report_date"])
    return FL.apply_filters(fund, [("report_date", "date",
                                    (dt.datetime(1996, 1, 1), dt.datetime(1998, 12, 31)))])


@query("filter_auto", """
SELECT * FROM company_info WHERE market IN ('ASIA', 'EUROPE') AND market_cap BETWEEN 0.0 AND 5000.0
  AND regexp_matches(company_name, '[13579]$')""")
def q_filter_auto(spark, sf):
    """The kind of each filter is chosen from the column: few values, numbers, text."""
    return FL.auto_filters(model(spark, sf).company_info, {
        "market": ["ASIA", "EUROPE"], "market_cap": (0.0, 5000.0), "company_name": "[13579]$"})


@query("filter_text_regex", """
SELECT * FROM company_info WHERE regexp_matches(company_name, '#0000001[0-9]7')""")
def q_filter_text_regex(spark, sf):
    return FL.apply_filters(model(spark, sf).company_info,
                            [("company_name", "text", "#0000001[0-9]7")])


@query("dq_stage_shapes", """
SELECT 'fundamental_merged' AS stage, count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers
  FROM mm_fundamental_raw
UNION ALL SELECT 'after_annual_pe', count(*), count(DISTINCT ticker) FROM mm_fundamental
UNION ALL SELECT 'after_growth_rates', count(*), count(DISTINCT ticker) FROM mm_growth_mean
UNION ALL SELECT 'after_latest_price', count(*), count(DISTINCT ticker) FROM mm_growth""")
def q_dq_stage_shapes(spark, sf):
    """Rows and tickers after each step of the stored multi-market run, from the figures of their writing."""
    out = stored_multi(spark, sf)
    steps = ("fundamental_merged", "after_annual_pe", "after_growth_rates", "after_latest_price")
    return SR.figures(spark, out, steps).select(F.col("table_name").alias("stage"), "n_rows", F.col("n_symbols").alias("n_tickers"))


# ---------------------------------------------------------------- daily refresh

@query("daily_refresh", """
SELECT ticker, date AS last_date, low AS last_low_price, price_future, sticker_price, mos
FROM (SELECT d.ticker, d.date, d.low, g.price_future, g.sticker_price, g.mos,
             rank() OVER (PARTITION BY d.ticker ORDER BY d.date DESC) AS rk
      FROM daily_drop d JOIN (SELECT * FROM growth WHERE mos IS NOT NULL) g ON d.ticker = g.ticker) x
WHERE rk = 1 AND low <= mos""")
def q_daily_refresh(spark, sf):
    """Today's prices against the stored valuation: neither statements nor earlier prices are read."""
    growth = spark.read.parquet(f"{stored_run(spark, sf)}/growth")
    return PL.daily_refresh(model(spark, sf).daily_drop, growth)


HISTORY_END = "2000-11-01"   # a stored run knows the prices before; the rest comes in batches
DAY_BATCHES = 3


@query("daily_maintenance", """
SELECT 'fundamental' AS table_name, ticker, fiscal_year, NULL::DATE AS last_date,
       {mean} AS value, {pe} AS ratio FROM d_fundamental
UNION ALL
SELECT 'growth', ticker, NULL, NULL, mos, {gr} FROM d_growth
UNION ALL
SELECT 'screener', ticker, NULL, last_date, last_low_price, mos FROM d_screener""".format(
    mean=O.r6("mean_low_price"), pe=O.r6("pe"), gr="pe_5yr"))
def q_daily_maintenance(spark, sf):
    """A run over the earlier prices takes in the later ones and the day's drop, in batches whose
    rows are mixed over days and one of which comes twice: its fundamentals, growth and screener
    equal a run over all prices."""
    base = _scratch(spark, "maintained")
    m = model(spark, sf)
    SR.run_and_store(TestdataModel(spark, sf, until=HISTORY_END), base, O.PERIOD)
    prices = m.lows()
    late = prices.where(F.col("date") >= F.lit(HISTORY_END).cast("date")).unionByName(m.daily_drop.select(*prices.columns))
    part = F.pmod(F.xxhash64("ticker", "date"), F.lit(DAY_BATCHES))
    for k in (2, 0, 2, 1):
        SR.apply_day(spark, base, late.where(part == k), f"batch-{k}")
    t = {n: spark.read.parquet(p) for n, p in SR.current(spark, base).items()}
    none = F.lit(None)
    parts = [r6(t["fundamental"], "mean_low_price", "pe").select(
                 F.lit("fundamental").alias("table_name"), "ticker", "fiscal_year", none.cast("date").alias("last_date"),
                 F.col("mean_low_price").alias("value"), F.col("pe").alias("ratio")),
             t["growth"].select(F.lit("growth").alias("table_name"), "ticker", none.cast("int").alias("fiscal_year"),
                                none.cast("date").alias("last_date"), F.col("mos").alias("value"), F.col("pe_5yr").alias("ratio")),
             t["screener"].select(F.lit("screener").alias("table_name"), "ticker", none.cast("int").alias("fiscal_year"),
                                  "last_date", F.col("last_low_price").alias("value"), F.col("mos").alias("ratio"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_refresh", """
SELECT 'latest' AS table_name, ticker, date AS last_date, low AS last_low_price, NULL::DOUBLE AS mos
FROM event_valued WHERE rk = 1
UNION ALL
SELECT 'screener', ticker, date, low, mos FROM event_valued
WHERE rk = 1 AND low <= mos AND price_future IS NOT NULL AND sticker_price IS NOT NULL""")
def q_stream_refresh(spark, sf):
    """The events' daily prices as a stream of deliveries, one of them late and one repeated: its tables
    equal a batch over all of them."""
    from valuora.schemas import PRICE_RENAMES, RAW_PRICE
    from valuora.sources import adapters as A
    from valuora.streaming.refresh import read_version, start_refresh_stream
    growth = spark.read.parquet(f"{stored_run(spark, sf)}/growth")
    out = _scratch(spark, "stream")
    rows = A.event_prices(spark, sf).select(*[F.col(PRICE_RENAMES[c]).alias(c) for c in RAW_PRICE.fieldNames()])
    even, late = F.pmod(F.xxhash64("Ticker"), F.lit(2)) == 0, F.dayofmonth("Date") <= 15
    for part in (even & ~late, ~even & ~late, late, even & ~late):
        rows.where(part).write.mode("append").parquet(f"{out}/drop")
        start_refresh_stream(spark, f"{out}/drop", growth, f"{out}/latest", f"{out}/screener", f"{out}/checkpoint",
                             fmt="parquet").awaitTermination()
    latest = read_version(spark, f"{out}/latest").select(
        F.lit("latest").alias("table_name"), "ticker", F.col("date").alias("last_date"), F.col("low").alias("last_low_price"),
        F.lit(None).cast("double").alias("mos"))
    screen = read_version(spark, f"{out}/screener").select(F.lit("screener").alias("table_name"), *latest.columns[1:])
    return latest.unionByName(screen)


# ---------------------------------------------------------------- stored results

@query("result_readback", f"""
SELECT 'company_info' AS table_name, c.*, p.peer_string FROM company_info c LEFT JOIN peers p ON c.ticker = p.ticker
UNION ALL BY NAME SELECT 'fundamental' AS table_name, f.* REPLACE ({O.r6('mean_low_price')} AS mean_low_price,
  {O.r6('pe')} AS pe) FROM fundamental f
UNION ALL BY NAME SELECT 'growth' AS table_name, g.* REPLACE ({O.sig12('eps_future')} AS eps_future) FROM growth g
UNION ALL BY NAME SELECT 'screener' AS table_name, s.* FROM screener s""")
def q_result_readback(spark, sf):
    """The processing job writes its four result tables; all of them are read back."""
    from valuora.sources.files import read_result_tables
    t = read_result_tables(spark, stored_run(spark, sf))
    tables = {"company_info": t["company_info"].drop("peer_list"),
              "fundamental": r6(t["fundamental"], "mean_low_price", "pe"),
              "growth": sig12(t["growth"], "eps_future"), "screener": t["screener"]}
    found = None
    for name, df in tables.items():
        df = df.withColumn("table_name", F.lit(name))
        found = df if found is None else found.unionByName(df, allowMissingColumns=True)
    return found


@query("screener_csv", "SELECT * FROM screener")
def q_screener_csv(spark, sf):
    """The screener exported as CSV and read back with its declared types."""
    from valuora import sinks
    screen = run_single(spark, sf).screener
    out = _scratch(spark, "csv")
    sinks.export_csv(screen, out)
    return spark.read.option("header", True).schema(screen.schema).csv(out)


@query("company_profile_file", "SELECT column_name, n, n_missing, n_distinct, top_freq FROM ("
       + _profile_sql("company_info", ["market_cap"], ["ticker", "company_name", "industry", "sector", "market"]) + ") p")
def q_company_profile_file(spark, sf):
    """The profile file written and read back."""
    from valuora import sinks
    prof = _profile(model(spark, sf).company_info)
    out = _scratch(spark, "profile")
    sinks.write_profile(prof, out)
    return spark.read.schema(prof.schema).json(out).select("column_name", "n", "n_missing", "n_distinct", "top_freq")


@query("price_files", """
SELECT date, ticker, open, high, low, close, adj_close, volume FROM (
  SELECT date, ticker, low AS open, low AS high, low, low AS close, low AS adj_close, NULL::DOUBLE AS volume
  FROM daily_drop) d""")
def q_price_files(spark, sf):
    """Today's prices written as one folder of CSV files per symbol and read back."""
    from valuora import sinks
    from valuora.sources.files import read_per_symbol_csv
    out = _scratch(spark, "price-files")
    drop = model(spark, sf).daily_drop
    sinks.write_per_symbol_csv(drop, out)
    return read_per_symbol_csv(spark, out)


# what the run stores, by table: (columns, type as stored)
STORED_TYPES = {
    "company_info": [("ticker company_name industry sector market peer_string", "string"), ("market_cap", "double"),
                     ("peer_list", "array<string>")],
    "fundamental": [("ticker currency fiscal_period_is fiscal_period_cf fiscal_period", "string"), ("simfin_id", "bigint"),
                    ("fiscal_year", "int"), ("report_date_is report_date_cf report_date", "date"),
                    ("shares_basic_is revenue net_income shares_basic_cf net_cash_ops net_cash_inv dividends_paid "
                     "shares_basic total_equity total_liab_equity dividends_paid_clean roic eps bvps fcf mean_low_price pe",
                     "double")],
    "growth": [("ticker", "string"), ("yrs_in_5yr yrs_in_10yr", "bigint"),
               (" ".join(c for c in GROWTH_NUMERIC if not c.startswith("yrs_in")), "double")],
    "screener": [("ticker", "string"), ("last_date", "date"), ("last_low_price price_future sticker_price mos", "double")]}


def _drift_sql() -> str:
    from valuora.plans.dictionary import ENTRIES
    stored = [(t, c, kind) for t, groups in STORED_TYPES.items() for cols, kind in groups for c in cols.split()]
    source = {t: t for t in STORED_TYPES} | {"company_info": """(SELECT c.*, p.peer_string, string_split(p.peer_string, ',')
        AS peer_list FROM company_info c LEFT JOIN peers p ON c.ticker = p.ticker)"""}
    filled = " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{c}' AS c, '{kind}' AS stored, (SELECT count({c}) FROM {source[t]} x) AS n_filled"
        for t, c, kind in stored)
    entries = ", ".join(f"('{t}', '{c}', '{d}')" for t, c, d, _ in ENTRIES)
    return f"""
SELECT coalesce(d.t, s.t) AS "table", coalesce(d.c, s.c) AS "column", d.declared, s.stored, s.n_filled,
       CASE WHEN d.bad THEN 'malformed' WHEN s.c IS NULL THEN 'missing' WHEN d.c IS NULL THEN 'extra'
            WHEN (d.declared = 'object' AND s.stored IN ('string', 'array<string>'))
              OR (d.declared = 'int64' AND s.stored IN ('bigint', 'int')) OR (d.declared = 'float64' AND s.stored = 'double')
              OR (d.declared = 'datetime64[ns]' AND s.stored = 'date') THEN 'ok' ELSE 'changed_type' END AS status
FROM (SELECT t, CASE WHEN bad THEN c || ',' || declared ELSE c END AS c, CASE WHEN NOT bad THEN declared END AS declared, bad
      FROM (SELECT *, declared NOT IN ('object', 'int64', 'float64', 'datetime64[ns]') AS bad
            FROM (VALUES {entries}) e(t, c, declared)) e2) d
FULL JOIN ({filled}) s ON d.t = s.t AND d.c = s.c"""


@query("data_dictionary_check", _drift_sql())
def q_data_dictionary_check(spark, sf):
    """The declared dictionary, read from its file, against the four stored tables, read back; both ways."""
    from valuora.plans.dictionary import stored_dictionary
    from valuora.sources.files import read_result_tables
    tables = read_result_tables(spark, stored_run(spark, sf))
    return Q.schema_drift(stored_dictionary(spark, _scratch(spark, "dictionary")), tables)


@query("price_ingest_manifest", """
SELECT ticker, 'loaded' AS status, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
       ends_with(ticker, '7') AS replaced, min(low) AS lowest FROM raised_price GROUP BY ticker
UNION ALL
SELECT 'S' || CAST(s_suppkey AS VARCHAR), CASE WHEN s_acctbal < 0 THEN 'unreadable' ELSE 'empty' END, 0, NULL, NULL, false, NULL
FROM supplier""")
def q_price_ingest_manifest(spark, sf):
    """A delivery of per-symbol files, some empty or unreadable, ingested by manifest; then a second one in
    which the files of some symbols have changed, and only those are read and replaced."""
    from valuora.sources import adapters as A
    from valuora.sources import ingest as I
    out = _scratch(spark, "delivery")
    A.vendor_files(spark, sf, f"{out}/vendor")
    I.ingest(spark, f"{out}/vendor", f"{out}/price", I.FOLDER, buckets=8)
    A.vendor_files(spark, sf, f"{out}/vendor", raised="7")
    manifest = I.ingest(spark, f"{out}/vendor", f"{out}/price", I.FOLDER, buckets=8)
    symbols = manifest.groupBy("ticker").agg(
        F.max("status").alias("status"), F.sum("n_rows").alias("n_rows"), F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"), F.max("replaced").alias("replaced"))
    lows = I.read_ingested(spark, f"{out}/price").groupBy("ticker").agg(F.min("low").alias("lowest"))
    return symbols.join(lows, "ticker", "left")


SNAPSHOT_DATES = ("2023-03-10", "2023-03-11")


@query("snapshot_read", f"""
SELECT * REPLACE ({O.sig12('eps_future')} AS eps_future), DATE '{SNAPSHOT_DATES[-1]}' AS snapshot_date
FROM growth""")
def q_snapshot_read(spark, sf):
    """The growth table written as two dated snapshots; the latest one is read back."""
    from valuora import sinks
    from valuora.sources.files import read_snapshot
    out = _scratch(spark, "snapshots")
    growth = run_single(spark, sf).growth
    for d in SNAPSHOT_DATES:
        sinks.write_snapshot(growth, out, "growth", d)
    return sig12(read_snapshot(spark, out, "growth"), "eps_future")


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
