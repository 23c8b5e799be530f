import datetime as dt

import pytest

from valuora.operators import fundamentals as FU
from valuora.operators import prices as P
from valuora.operators.screen import screener

PRICE = "date date, ticker string, low double"


def price(spark, rows):
    return spark.createDataFrame(rows, PRICE)


def d(s):
    return dt.date.fromisoformat(s)


def test_annual_price_mean_and_min(spark):
    px = price(spark, [(d("2019-12-02"), "A", 10.0), (d("2019-12-03"), "A", 20.0),
                       (d("2019-11-30"), "A", 1.0), (d("2020-12-01"), "A", 5.0),
                       (d("2018-12-01"), "A", 7.0)])
    mean = {(r.year, r.ticker): r.mean_low_price
            for r in P.annual_price(px, 2019, 2020, "mean").collect()}
    assert mean == {(2019, "A"): 15.0, (2020, "A"): 5.0}
    mn = {(r.year, r.ticker): r.mean_low_price for r in P.annual_price(px, how="min").collect()}
    assert mn == {(2018, "A"): 7.0, (2019, "A"): 10.0, (2020, "A"): 5.0}


def test_annual_price_pushes_date_range_to_scan(spark, tmp):
    px = price(spark, [(d("2019-12-02"), "A", 10.0)])
    px.write.parquet(f"{tmp}/p")
    plan = P.annual_price(spark.read.parquet(f"{tmp}/p"), 2019, 2020)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date,2019-12-01)" in plan


def test_latest_price_keeps_ties(spark):
    px = price(spark, [(d("2021-06-03"), "A", 3.0), (d("2021-06-04"), "A", 4.0),
                       (d("2021-06-04"), "A", 4.5), (d("2021-06-01"), "B", 9.0)])
    got = sorted((r.ticker, r.last_date.isoformat(), r.last_low_price)
                 for r in P.latest_price(px).collect())
    assert got == [("A", "2021-06-04", 4.0), ("A", "2021-06-04", 4.5), ("B", "2021-06-01", 9.0)]


def test_latest_price_is_aggregate_and_join_back(spark):
    px = price(spark, [(d("2021-06-03"), "A", 3.0)])
    assert "partial_max" in P.latest_dates(px)._jdf.queryExecution().executedPlan().toString()
    # the per-ticker dates are written; their file size lets Spark broadcast them: prices are not shuffled
    plan = P.latest_price(px)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "SortMergeJoin" not in plan
    # the window form (used on small batches) plans a partial group limit
    plan = P.latest_rows(px)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_screener_keeps_price_below_mos(spark):
    px = price(spark, [(d("2021-06-04"), "EA", 142.639999), (d("2021-06-04"), "ABMD", 284.26001),
                       (d("2021-06-04"), "RH", 602.219971), (d("2021-06-04"), "X", 50.0),
                       (d("2021-06-03"), "ABMD", 1.0)])
    growth = spark.createDataFrame(
        [("EA", 500.0, 473.74, 236.869963), ("ABMD", 3325.86, 822.10, 411.050684),
         ("RH", 9e5, 132680.32, 66340.161282), ("X", 10.0, 5.0, 2.5), ("N", None, None, None)],
        "ticker string, price_future double, sticker_price double, mos double")
    got = {r.ticker: r.last_low_price for r in screener(px, growth).collect()}
    assert got == {"EA": 142.639999, "ABMD": 284.26001, "RH": 602.219971}


def test_kpis_and_pe_golden(spark):
    df = spark.createDataFrame(
        [("FCPT", 2015, 5698883.0, 441642000.0, 6206375.0, 100.0, 1.0, 5.0, None),
         ("Z", 2015, 10.0, 5.0, 0.0, 0.0, 1.0, None, None),
         ("Q", 2015, 0.0, 5.0, 0.0, 8.0, 2.0, 1.0, -1.0)],
        "ticker string, fiscal_year int, net_income double, total_equity double, shares_basic double,"
        " total_liab_equity double, net_cash_ops double, net_cash_inv double, dividends_paid double")
    k = {r.ticker: r for r in FU.add_kpis(df).collect()}
    assert k["FCPT"].bvps == pytest.approx(71.159413, abs=1e-6)
    assert k["Z"].eps == float("inf") and k["Z"].roic is None and k["Z"].fcf is None
    assert k["Q"].eps is None and k["Q"].roic == pytest.approx(-1.0 / 8.0)
    annual = spark.createDataFrame([(2015, "FCPT", 21.840909), (2015, "Z", 3.0)],
                                   "year int, ticker string, mean_low_price double")
    fe = spark.createDataFrame([("FCPT", 2015, 0.918249), ("Z", 2015, float("inf")),
                                ("R", 2010, -0.348732), ("M", 2014, 0.005156)],
                               "ticker string, fiscal_year int, eps double")
    annual2 = annual.union(spark.createDataFrame([(2010, "R", 2.558636)], annual.schema))
    pe = {r.ticker: r.pe for r in FU.add_annual_pe(fe, annual2).collect()}
    # inputs are printed at 6 dp; dividing by eps < 1 amplifies that to ~3e-5
    assert pe["FCPT"] == pytest.approx(23.785379, abs=5e-5)
    assert pe["Z"] == 0.0
    assert pe["R"] == pytest.approx(-7.336963, abs=5e-5)
    assert pe["M"] is None            # no price in that year


def test_combine_statements_suffixes(spark):
    k = "ticker string, simfin_id long, currency string, fiscal_year int"
    inc = spark.createDataFrame([("A", 1, "USD", 2020, 5.0, 1.0)], f"{k}, shares_basic double, revenue double")
    cf = spark.createDataFrame([("A", 1, "USD", 2020, 6.0, 2.0)], f"{k}, shares_basic double, net_cash_ops double")
    bal = spark.createDataFrame([("A", 1, "USD", 2020, 7.0, 3.0), ("B", 2, "USD", 2020, 1.0, 1.0)],
                                f"{k}, shares_basic double, total_equity double")
    out = FU.combine_statements(inc, cf, bal)
    r = out.first()
    assert out.count() == 1
    assert (r.shares_basic_is, r.shares_basic_cf, r.shares_basic) == (5.0, 6.0, 7.0)


def test_kpis_golden_row_with_dividends(spark):
    # a printed 2016 row: TL&E 937,151,000; equity 470,117,000; shares 56,984,561;
    # dividends paid -121,604,000 (negative); eps 2.751780 -> net income ~156.81M
    ni = round(2.751780 * 56984561)
    df = spark.createDataFrame(
        [("FCPT", 2016, float(ni), 470117000.0, 56984561.0, 937151000.0, 1.0, 0.0, -121604000.0)],
        "ticker string, fiscal_year int, net_income double, total_equity double, shares_basic double,"
        " total_liab_equity double, net_cash_ops double, net_cash_inv double, dividends_paid double")
    r = FU.add_kpis(df).first()
    assert r.roic == pytest.approx(0.037566, abs=5e-7)
    assert r.eps == pytest.approx(2.751780, abs=5e-7)
    assert r.bvps == pytest.approx(8.249901, abs=5e-7)
    annual = spark.createDataFrame([(2016, "FCPT", 19.338095)],
                                   "year int, ticker string, mean_low_price double")
    assert FU.add_annual_pe(FU.add_kpis(df), annual).first().pe == pytest.approx(7.027485, abs=5e-6)
