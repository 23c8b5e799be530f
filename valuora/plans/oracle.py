"""ANSI SQL (DuckDB dialect) mirror of the adapters and operators.

Each named CTE mirrors one Spark function; an oracle query is a final SELECT
over the CTEs it needs (dependencies are pulled in automatically). These
strings are the independent check of the Spark plans: they are written from
the operator semantics, not generated from the Spark code.
"""

from __future__ import annotations

import re

from valuora.operators.valuation import DEFAULT_EXP_RR, DEFAULT_FP

# Parameters of the registered queries (shared with valuora.plans.registry).
PERIOD = (1995, 2001)          # inclusive fiscal-year range of the single-market run
NARROW_PERIOD = (1996, 2000)   # a range that actually cuts years, for the filter queries
EXCLUDED_MARKETS = ("MIDDLE EAST",)
OUT_OF_BOUNDS_PCT = 3500
DISCOUNT = (1 + DEFAULT_EXP_RR) ** DEFAULT_FP

KPIS = ["roic", "revenue", "eps", "bvps", "fcf"]
GR = [f"{k}_gr" for k in KPIS] + ["pe"]


def nn(x: str) -> str:
    """NaN -> NULL."""
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def r6(x: str) -> str:
    return f"(round_even(({x}) * 1000000, 0) / 1000000)"


def sig12(x: str) -> str:
    """12 significant digits, printed and parsed back (matches the Spark report)."""
    return f"(CASE WHEN {x} IS NOT NULL THEN CAST(printf('%.12g', {x}) AS DOUBLE) END)"


def ci(x: str) -> str:
    """+/-inf and NaN -> NULL."""
    return f"(CASE WHEN abs({x}) = 'inf'::DOUBLE OR isnan({x}) THEN NULL ELSE {x} END)"


def ieee_div(n: str, d: str) -> str:
    return (f"(CASE WHEN ({n}) IS NULL OR ({d}) IS NULL THEN NULL WHEN ({d}) <> 0 THEN ({n}) / ({d}) "
            f"WHEN ({n}) > 0 THEN 'inf'::DOUBLE WHEN ({n}) < 0 THEN '-inf'::DOUBLE END)")


def pos(x: str) -> str:
    return f"(CASE WHEN {x} > 0 THEN {x} END)"


D = "DECIMAL(18,2)"

CTES: dict[str, str] = {}

CTES["price"] = """
SELECT CAST(l.l_shipdate AS DATE) AS date, CAST(o.o_custkey AS VARCHAR) AS ticker,
       l.l_extendedprice AS open, l.l_extendedprice AS high, l.l_extendedprice AS low,
       l.l_extendedprice AS close, l.l_extendedprice AS adj_close, l.l_quantity AS volume
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

CTES["income"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_custkey AS simfin_id, 'USD' AS currency,
       CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, 'FY' AS fiscal_period,
       max(CAST(o_orderdate AS DATE)) AS report_date,
       CAST(count(*) * 10 AS DOUBLE) AS shares_basic,
       CAST(sum(CAST(o_totalprice AS {D})) AS DOUBLE) AS revenue,
       CAST(sum(CAST(o_totalprice AS {D}) * CASE o_orderstatus WHEN 'P' THEN 2 WHEN 'F' THEN 1
                WHEN 'O' THEN -1 ELSE 0 END) AS DOUBLE) AS net_income
FROM orders GROUP BY o_custkey, year(o_orderdate)"""

CTES["balance"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS ticker, o_custkey AS simfin_id, 'USD' AS currency,
       CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, 'FY' AS fiscal_period,
       max(CAST(o_orderdate AS DATE)) AS report_date,
       CAST(sum(CASE WHEN o_orderpriority <> '1-URGENT' THEN 1 ELSE 0 END) * 10 AS DOUBLE) AS shares_basic,
       CAST(sum(CAST(o_totalprice AS {D}) * CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                THEN 2 ELSE 1 END) AS DOUBLE) AS total_equity,
       CAST(sum(CASE WHEN o_orderstatus <> 'O' THEN CAST(o_totalprice AS {D}) * 4
                ELSE CAST(0 AS {D}) END) AS DOUBLE) AS total_liab_equity
FROM orders GROUP BY o_custkey, year(o_orderdate)"""

CTES["cashflow"] = f"""
SELECT CAST(o.o_custkey AS VARCHAR) AS ticker, o.o_custkey AS simfin_id, 'USD' AS currency,
       CAST(year(o.o_orderdate) AS INTEGER) AS fiscal_year, 'FY' AS fiscal_period,
       max(CAST(o.o_orderdate AS DATE)) AS report_date,
       CAST(count(*) * 10 AS DOUBLE) AS shares_basic,
       CAST(sum(CAST(l.l_extendedprice AS {D})) AS DOUBLE) AS net_cash_ops,
       CAST(-sum(CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_extendedprice AS {D}) END) AS DOUBLE)
           AS net_cash_inv,
       CAST(-sum(CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS {D}) END) AS DOUBLE)
           AS dividends_paid
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, year(o.o_orderdate)"""

CTES["ticker_market"] = """
SELECT CAST(c.c_custkey AS VARCHAR) AS ticker, r.r_name AS market
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["company_info"] = """
SELECT CAST(c.c_custkey AS VARCHAR) AS ticker, c.c_name AS company_name, n.n_name AS industry,
       c.c_mktsegment AS sector, r.r_name AS market, c.c_acctbal AS market_cap
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["symbol_directory"] = """
SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS security_name,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Y' ELSE 'N' END AS etf,
       CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS test_issue,
       CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 AND c_custkey % 5 = 0 THEN 'D'
            ELSE 'N' END AS financial_status,
       CAST(c_custkey AS VARCHAR) AS nasdaq_symbol
FROM customer"""

CTES["peer_pairs"] = """
SELECT DISTINCT o.o_custkey AS ticker_key, l.l_suppkey AS peer_key
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

CTES["peers"] = """
SELECT CAST(ticker_key AS VARCHAR) AS ticker,
       string_agg(CAST(peer_key AS VARCHAR), ',' ORDER BY peer_key) AS peer_string
FROM peer_pairs GROUP BY ticker_key"""

CTES["fundamental_raw"] = """
SELECT i.ticker, i.simfin_id, i.currency, i.fiscal_year,
       i.fiscal_period AS fiscal_period_is, i.report_date AS report_date_is,
       i.shares_basic AS shares_basic_is, i.revenue, i.net_income,
       c.fiscal_period AS fiscal_period_cf, c.report_date AS report_date_cf,
       c.shares_basic AS shares_basic_cf, c.net_cash_ops, c.net_cash_inv, c.dividends_paid,
       b.fiscal_period, b.report_date, b.shares_basic, b.total_equity, b.total_liab_equity
FROM income i
JOIN cashflow c ON i.ticker = c.ticker AND i.simfin_id = c.simfin_id
                AND i.currency = c.currency AND i.fiscal_year = c.fiscal_year
JOIN balance b ON i.ticker = b.ticker AND i.simfin_id = b.simfin_id
                AND i.currency = b.currency AND i.fiscal_year = b.fiscal_year"""

CTES["fundamental_kpi"] = f"""
SELECT f.*, coalesce(dividends_paid, 0.0) AS dividends_paid_clean,
       (net_income + coalesce(dividends_paid, 0.0)) / nullif(total_liab_equity, 0) AS roic,
       {ieee_div('net_income', 'shares_basic')} AS eps,
       {ieee_div('total_equity', 'shares_basic')} AS bvps,
       net_cash_ops - net_cash_inv AS fcf
FROM fundamental_raw f
WHERE fiscal_year BETWEEN {PERIOD[0]} AND {PERIOD[1]}
  AND ticker IN (SELECT ticker FROM company_info)"""

# price narrowed to tickers with fundamentals (S2, as an exact semi join)
CTES["price_used"] = """
SELECT * FROM price WHERE ticker IN (SELECT ticker FROM fundamental_kpi)"""

CTES["fundamental_priced"] = """
SELECT * FROM fundamental_kpi WHERE ticker IN (SELECT ticker FROM price_used)"""

CTES["annual_mean"] = f"""
SELECT CAST(year(date) AS INTEGER) AS year, ticker, avg(low) AS mean_low_price
FROM price_used
WHERE month(date) = 12 AND year(date) BETWEEN {PERIOD[0]} AND {PERIOD[1]}
GROUP BY year(date), ticker"""

CTES["fundamental"] = """
SELECT f.*, a.mean_low_price, a.mean_low_price / nullif(f.eps, 0) AS pe
FROM fundamental_priced f
LEFT JOIN annual_mean a ON f.ticker = a.ticker AND f.fiscal_year = a.year"""


def _growth_rows_sql(src: str) -> str:
    filled = ",\n       ".join(
        f"last_value({k} IGNORE NULLS) OVER wu AS {k}_f, last_value({k} IGNORE NULLS) OVER wb AS {k}_p"
        for k in KPIS)
    gr = ",\n       ".join(nn(f"{k}_f / {k}_p - 1") + f" AS {k}_gr" for k in KPIS)
    zeroed = ", ".join(f"nullif({k}, 0) AS {k}" for k in KPIS)
    return f"""
SELECT ticker, fiscal_year, {', '.join(KPIS)},
       {gr}, pe
FROM (SELECT *, {filled}
      FROM (SELECT ticker, fiscal_year, {zeroed}, pe FROM {src}) z
      WINDOW wu AS (PARTITION BY ticker ORDER BY fiscal_year
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             wb AS (PARTITION BY ticker ORDER BY fiscal_year
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) g"""


def _summary_sql(src: str, agg: str) -> str:
    parts = ["max(CASE WHEN fiscal_year = max_fy THEN revenue_gr END) AS revenue_gr_curr",
             "max(CASE WHEN fiscal_year = max_fy THEN eps END) AS eps_curr"]
    for n in (5, 10):
        for c in GR:
            parts.append(f"{agg}(CASE WHEN fiscal_year > max_fy - {n} THEN {c} END) AS {c}_{n}yr")
        parts.append(f"count(CASE WHEN fiscal_year > max_fy - {n} THEN fiscal_year END) AS yrs_in_{n}yr")
    inner = ",\n       ".join(parts)
    outer = ["ticker", ci("revenue_gr_curr") + " AS revenue_gr_curr", ci("eps_curr") + " AS eps_curr"]
    for n in (5, 10):
        for c in GR:
            outer.append(ci(nn(r2(f"{c}_{n}yr"))) + f" AS {c}_{n}yr")
        outer.append(f"yrs_in_{n}yr")
        m = f"least({nn(r2(f'bvps_gr_{n}yr'))}, {nn(r2(f'eps_gr_{n}yr'))})"
        rule1 = pos(m)
        outer.append(ci(rule1) + f" AS rule1_gr_{n}yr")
        outer.append(ci(f"({rule1}) * 200") + f" AS pe_default_{n}yr")
    return f"""
SELECT {', '.join(outer)}
FROM (SELECT ticker,
       {inner}
      FROM (SELECT *, max(fiscal_year) OVER (PARTITION BY ticker) AS max_fy FROM {src}) s
      GROUP BY ticker) a"""


def _sticker_sql(src: str) -> str:
    pe_future = pos("(CASE WHEN pe_5yr IS NULL THEN NULL WHEN pe_default_5yr IS NULL THEN pe_5yr "
                    "ELSE least(pe_5yr, pe_default_5yr) END)")
    eps_future = pos(f"eps_curr * pow(1.0 + rule1_gr_5yr, {float(DEFAULT_FP)!r})")
    failed = ("(coalesce(roic_gr_5yr < 0, false) OR coalesce(fcf_gr_5yr < 0, false) "
              "OR coalesce(bvps_gr_5yr < 0, false))")
    return f"""
SELECT *, {r2('price_future / ' + repr(DISCOUNT))} AS sticker_price,
       {r2(r2('price_future / ' + repr(DISCOUNT)) + ' / 2')} AS mos
FROM (SELECT *, {r2(f'CASE WHEN NOT {failed} THEN pe_future * eps_future END')} AS price_future
      FROM (SELECT *, {pe_future} AS pe_future, {eps_future} AS eps_future FROM {src}) a) b"""


CTES["growth_rows"] = _growth_rows_sql("fundamental")
CTES["growth_summary"] = _summary_sql("growth_rows", "avg")
CTES["growth_summary_median"] = _summary_sql("growth_rows", "median")
CTES["growth_mean"] = "SELECT * FROM growth_summary WHERE yrs_in_5yr = 5"
CTES["growth_median"] = "SELECT * FROM growth_summary_median WHERE yrs_in_5yr = 5"
CTES["growth"] = _sticker_sql("growth_mean")
CTES["growth_med"] = _sticker_sql("growth_median")


def _screener_sql(price_src: str, growth_src: str) -> str:
    return f"""
SELECT ticker, date AS last_date, low AS last_low_price, price_future, sticker_price, mos
FROM (SELECT p.ticker, p.date, p.low, v.price_future, v.sticker_price, v.mos,
             rank() OVER (PARTITION BY p.ticker ORDER BY p.date DESC) AS rk
      FROM {price_src} p
      JOIN (SELECT ticker, price_future, sticker_price, mos FROM {growth_src}
            WHERE mos IS NOT NULL) v ON p.ticker = v.ticker) x
WHERE rk = 1 AND low <= mos AND date IS NOT NULL AND low IS NOT NULL
  AND price_future IS NOT NULL AND sticker_price IS NOT NULL"""


CTES["screener"] = _screener_sql("price_used", "growth")
CTES["screener_median"] = _screener_sql("price_used", "growth_med")


# ---------------------------------------------------------------- multi-market

CTES["companies"] = """
SELECT CAST(c.c_custkey AS VARCHAR) AS ticker, c.c_custkey AS simfin_id, c.c_name AS company_name,
       c.c_nationkey AS industry_id, t.market
FROM customer c JOIN ticker_market t ON CAST(c.c_custkey AS VARCHAR) = t.ticker"""

CTES["industries"] = """
SELECT n_nationkey AS industry_id, n_name AS industry,
       'SECTOR-' || CAST(n_regionkey AS VARCHAR) AS sector
FROM nation"""

CTES["company_industry"] = """
SELECT c.*, i.industry, i.sector FROM companies c
LEFT JOIN industries i ON c.industry_id = i.industry_id"""

_EXCL = ", ".join(f"'{m}'" for m in EXCLUDED_MARKETS)
CTES["mm_markets"] = f"""
SELECT DISTINCT r_name AS market_id FROM region WHERE r_name NOT IN ({_EXCL})"""

CTES["mm_tm"] = """
SELECT * FROM ticker_market WHERE market IN (SELECT market_id FROM mm_markets)"""

for _st in ("income", "cashflow", "balance", "price"):
    CTES[f"mm_{_st}"] = f"""
SELECT x.*, t.market FROM {_st} x JOIN mm_tm t ON x.ticker = t.ticker"""

CTES["mm_fundamental_all"] = """
SELECT i.ticker, i.simfin_id, i.currency, i.fiscal_year,
       i.fiscal_period AS fiscal_period_is, i.report_date AS report_date_is,
       i.shares_basic AS shares_basic_is, i.revenue, i.net_income, i.market AS market_is,
       c.fiscal_period AS fiscal_period_cf, c.report_date AS report_date_cf,
       c.shares_basic AS shares_basic_cf, c.net_cash_ops, c.net_cash_inv, c.dividends_paid,
       c.market AS market_cf,
       b.fiscal_period, b.report_date, b.shares_basic, b.total_equity, b.total_liab_equity, b.market
FROM mm_income i
JOIN mm_cashflow c ON i.ticker = c.ticker AND i.simfin_id = c.simfin_id
                   AND i.currency = c.currency AND i.fiscal_year = c.fiscal_year
JOIN mm_balance b ON i.ticker = b.ticker AND i.simfin_id = b.simfin_id
                  AND i.currency = b.currency AND i.fiscal_year = b.fiscal_year"""

CTES["mm_fundamental_raw"] = """
SELECT * FROM mm_fundamental_all WHERE ticker IN (SELECT ticker FROM mm_price)"""

CTES["mm_price_used"] = """
SELECT * FROM mm_price WHERE ticker IN (SELECT ticker FROM mm_fundamental_all)"""

CTES["mm_annual_min"] = """
SELECT CAST(year(date) AS INTEGER) AS year, ticker, min(low) AS mean_low_price
FROM mm_price_used WHERE month(date) = 12 GROUP BY year(date), ticker"""

CTES["mm_fundamental"] = f"""
SELECT f.*, coalesce(dividends_paid, 0.0) AS dividends_paid_clean,
       (net_income + coalesce(dividends_paid, 0.0)) / nullif(total_liab_equity, 0) AS roic,
       {ieee_div('net_income', 'shares_basic')} AS eps,
       {ieee_div('total_equity', 'shares_basic')} AS bvps,
       net_cash_ops - net_cash_inv AS fcf,
       a.mean_low_price,
       a.mean_low_price / nullif({ieee_div('net_income', 'shares_basic')}, 0) AS pe
FROM mm_fundamental_raw f
LEFT JOIN mm_annual_min a ON f.ticker = a.ticker AND f.fiscal_year = a.year"""

CTES["mm_growth_rows"] = _growth_rows_sql("mm_fundamental")
CTES["mm_growth_summary"] = _summary_sql("mm_growth_rows", "avg")
CTES["mm_growth_mean"] = "SELECT * FROM mm_growth_summary WHERE yrs_in_5yr = 5"
CTES["mm_growth_sticker"] = _sticker_sql("mm_growth_mean")

CTES["mm_latest"] = """
SELECT ticker, min(low) AS last_low_price
FROM (SELECT ticker, low, rank() OVER (PARTITION BY ticker ORDER BY date DESC) AS rk
      FROM mm_price_used) x WHERE rk = 1 GROUP BY ticker"""

CTES["mm_companies"] = """
SELECT * FROM company_industry WHERE market IN (SELECT market_id FROM mm_markets)"""

_PCT = "100.0 * " + r2(ieee_div("g.mos - l.last_low_price", "l.last_low_price"))
CTES["mm_growth"] = f"""
SELECT g.*, l.last_low_price,
       coalesce(g.mos >= l.last_low_price, false) AS mos_reached,
       g.mos - l.last_low_price AS diff_price_mos,
       {_PCT} AS diff_price_mos_percentage,
       coalesce({_PCT} > {OUT_OF_BOUNDS_PCT}, false) AS out_off_bounds_value,
       c.industry_id, c.simfin_id, c.company_name, c.market, c.industry, c.sector
FROM mm_growth_sticker g
LEFT JOIN mm_latest l ON g.ticker = l.ticker
LEFT JOIN mm_companies c ON g.ticker = c.ticker"""

# ---------------------------------------------------------------- company side

CTES["symbol_universe"] = """
SELECT nasdaq_symbol AS ticker FROM symbol_directory
WHERE test_issue = 'N' AND (financial_status IS NULL OR financial_status = 'N') AND etf = 'N'"""

CTES["company_universe"] = """
SELECT * FROM company_info WHERE ticker IN (SELECT ticker FROM symbol_universe)"""

CTES["statement_tickers"] = """
SELECT ticker FROM (SELECT DISTINCT ticker FROM income) i
WHERE ticker IN (SELECT ticker FROM cashflow) AND ticker IN (SELECT ticker FROM balance)"""

CTES["staging_symbols"] = """
SELECT DISTINCT ticker FROM company_universe
WHERE ticker IN (SELECT ticker FROM statement_tickers)"""

# ---------------------------------------------------------------- one market only

SINGLE_MARKET = "EUROPE"
CTES["sm_fundamental_kpi"] = f"""
SELECT * FROM fundamental_kpi
WHERE ticker IN (SELECT ticker FROM ticker_market WHERE market = '{SINGLE_MARKET}')"""
CTES["sm_price_used"] = """
SELECT * FROM price WHERE ticker IN (SELECT ticker FROM sm_fundamental_kpi)"""
CTES["sm_annual_mean"] = f"""
SELECT CAST(year(date) AS INTEGER) AS year, ticker, avg(low) AS mean_low_price
FROM sm_price_used
WHERE month(date) = 12 AND year(date) BETWEEN {PERIOD[0]} AND {PERIOD[1]}
GROUP BY year(date), ticker"""
CTES["sm_fundamental"] = """
SELECT f.*, a.mean_low_price, a.mean_low_price / nullif(f.eps, 0) AS pe
FROM (SELECT * FROM sm_fundamental_kpi WHERE ticker IN (SELECT ticker FROM sm_price_used)) f
LEFT JOIN sm_annual_mean a ON f.ticker = a.ticker AND f.fiscal_year = a.year"""
CTES["sm_growth_rows"] = _growth_rows_sql("sm_fundamental")
CTES["sm_growth_summary"] = _summary_sql("sm_growth_rows", "avg")
CTES["sm_growth_mean"] = "SELECT * FROM sm_growth_summary WHERE yrs_in_5yr = 5"
CTES["sm_growth"] = _sticker_sql("sm_growth_mean")
CTES["sm_screener"] = _screener_sql("sm_price_used", "sm_growth")

CTES["daily_drop"] = """
SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS ticker, value * 1000 AS low
FROM (SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, value DESC) AS rn
      FROM events) e WHERE rn = 1"""

# ---------------------------------------------------------------- a run over the prices and the day's drop

CTES["d_price"] = """
SELECT date, ticker, low FROM price UNION ALL SELECT date, ticker, low FROM daily_drop"""
CTES["d_price_used"] = """
SELECT * FROM d_price WHERE ticker IN (SELECT ticker FROM fundamental_kpi)"""
CTES["d_annual_mean"] = f"""
SELECT CAST(year(date) AS INTEGER) AS year, ticker, avg(low) AS mean_low_price
FROM d_price_used
WHERE month(date) = 12 AND year(date) BETWEEN {PERIOD[0]} AND {PERIOD[1]}
GROUP BY year(date), ticker"""
CTES["d_fundamental"] = """
SELECT f.*, a.mean_low_price, a.mean_low_price / nullif(f.eps, 0) AS pe
FROM (SELECT * FROM fundamental_kpi WHERE ticker IN (SELECT ticker FROM d_price_used)) f
LEFT JOIN d_annual_mean a ON f.ticker = a.ticker AND f.fiscal_year = a.year"""
CTES["d_growth_rows"] = _growth_rows_sql("d_fundamental")
CTES["d_growth_summary"] = _summary_sql("d_growth_rows", "avg")
CTES["d_growth_mean"] = "SELECT * FROM d_growth_summary WHERE yrs_in_5yr = 5"
CTES["d_growth"] = _sticker_sql("d_growth_mean")
CTES["d_screener"] = _screener_sql("d_price_used", "d_growth")

CTES["event_prices"] = """
SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, min(value) * 1000 AS low
FROM events GROUP BY 1, 2"""
CTES["event_valued"] = """
SELECT e.ticker, e.date, e.low, g.price_future, g.sticker_price, g.mos,
       rank() OVER (PARTITION BY e.ticker ORDER BY e.date DESC) AS rk
FROM event_prices e JOIN (SELECT * FROM growth WHERE mos IS NOT NULL) g ON e.ticker = g.ticker"""
CTES["raised_price"] = """
SELECT ticker, date, low + CASE WHEN ends_with(ticker, '7') THEN 1 ELSE 0 END AS low FROM price"""

CTES["extremes"] = """
SELECT * FROM screener WHERE mos / nullif(last_low_price, 0) > 10"""

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(name: str) -> list[str]:
    words = set(_NAME.findall(CTES[name]))
    return [d for d in CTES if d in words and d != name]


def sql(final: str) -> str:
    """WITH <every CTE the final SELECT needs, dependencies first> <final>."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for w in _NAME.findall(final):
        if w in CTES:
            visit(w)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    return f"WITH {body}\n{final}"
