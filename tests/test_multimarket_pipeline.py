
from pyspark.sql import functions as F

from valuora.operators.multimarket import kept_markets, price_flags
from valuora.plans.model import TestdataModel
from valuora.plans.oracle import PERIOD
from valuora.plans.jobs import single_market
from valuora.plans.stored import run_and_store


def test_price_flags_missing_operands_are_false(spark):
    growth = spark.createDataFrame([("A", 50.0), ("B", None), ("C", 400.0), ("D", 10.0)],
                                   "ticker string, mos double")
    latest = spark.createDataFrame([("A", 100.0), ("B", 5.0), ("C", 10.0)],
                                   "ticker string, last_low_price double")
    out = {r.ticker: r for r in price_flags(growth, latest).collect()}
    assert out["A"].mos_reached is False and out["A"].diff_price_mos == -50.0
    assert out["A"].diff_price_mos_percentage == -50.0
    assert out["B"].mos_reached is False and out["B"].out_off_bounds_value is False
    assert out["C"].mos_reached is True and out["C"].diff_price_mos_percentage == 3900.0
    assert out["C"].out_off_bounds_value is True
    assert out["D"].last_low_price is None and out["D"].mos_reached is False


def test_kept_markets(spark):
    m = spark.createDataFrame([("us",), ("it",), ("ca",), ("de",)], "market_id string")
    assert sorted(r.market_id for r in kept_markets(m, ("it", "ca")).collect()) == ["de", "us"]


def test_run_and_store_matches_lazy_pipeline(spark, tmp):
    sf = "/root/testdata/sf0.001"
    model = TestdataModel(spark, sf)
    paths = run_and_store(model, f"{tmp}/out", PERIOD)
    stored = {k: spark.read.parquet(v) for k, v in paths.items()}
    lazy = single_market(TestdataModel(spark, sf), PERIOD)
    assert sorted(stored["screener"].collect()) == sorted(lazy.screener.collect())
    assert stored["growth"].count() == lazy.growth.count()
    assert stored["fundamental"].count() == lazy.fundamental.count()
    assert "peer_list" in stored["company_info"].columns


def test_symbol_list_narrows_the_run(spark):
    sf = "/root/testdata/sf0.001"
    model = TestdataModel(spark, sf)
    some = model.company_info.select("ticker").where(F.col("ticker").rlike("^1"))
    r = single_market(model, PERIOD, symbols=some)
    tickers = {x.ticker for x in r.fundamental.select("ticker").distinct().collect()}
    assert tickers and all(t.startswith("1") for t in tickers)


def test_csv_export_is_written_by_many_tasks(spark, tmp):
    import os
    from valuora import sinks
    df = spark.createDataFrame([("A", "B,C"), ("B", None)], "ticker string, peer_string string").repartition(2)
    sinks.export_csv(df, f"{tmp}/peers")
    assert len([p for p in os.listdir(f"{tmp}/peers") if p.startswith("part-")]) >= 1
    back = spark.read.option("header", True).csv(f"{tmp}/peers").collect()
    assert sorted((r.ticker, r.peer_string) for r in back) == [("A", "B,C"), ("B", None)]


def test_describe_approx_path(spark):
    from valuora.operators.profile import describe
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    out = {r.stat: r.value for r in describe(df, "x", (0.1, 0.9), exact=False).collect()}
    assert out["count"] == 1000 and abs(out["50%"] - 500) <= 1 and out["max"] == 999


def test_lazy_plan_runs_nothing_until_asked(spark):
    sf = "/root/testdata/sf0.001"
    model = TestdataModel(spark, sf)
    for name in ("price", "income", "cashflow", "balance", "company_info", "peers"):
        getattr(model, name)   # opening a Parquet table reads its schema
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    r = single_market(model, PERIOD, materialize=False)
    plan = r.screener._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    assert sorted(r.screener.collect()) == sorted(single_market(model, PERIOD).screener.collect())


def test_multi_market_lazy_equals_materialized(spark):
    from valuora.operators.multimarket import multi_market
    model = TestdataModel(spark, "/root/testdata/sf0.001")
    a = multi_market(model, ("MIDDLE EAST",), materialize=False)["growth"].collect()
    b = multi_market(model, ("MIDDLE EAST",))["growth"].collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(a, key=key) == sorted(b, key=key)


def _market_fixture(spark, twice):
    """Toy statements of one ticker; ``twice`` lists it in two markets."""
    class Model:
        markets = spark.createDataFrame([("us",), ("de",)], "market_id string")
        ticker_market = spark.createDataFrame([("A", "us")] + ([("A", "de")] if twice else []), "ticker string, market string")
    k = [("A", 1, "USD", 2020)]
    keys = "ticker string, simfin_id long, currency string, fiscal_year int"
    Model.income = spark.createDataFrame([(*x, 5.0) for x in k], keys + ", net_income double")
    Model.cashflow = spark.createDataFrame([(*x, 6.0) for x in k], keys + ", net_cash_ops double")
    Model.balance = spark.createDataFrame([(*x, 7.0) for x in k], keys + ", total_equity double")
    return Model


def test_a_ticker_in_two_markets_fails(spark):
    import pytest
    from valuora.operators import fundamentals as FU
    from valuora.operators.multimarket import tag_market
    m = _market_fixture(spark, False)
    tagged = [tag_market(s, m.ticker_market, m.markets)
              for s in (m.income, m.cashflow, m.balance)]
    assert FU.combine_statements(*tagged).count() == 1
    m = _market_fixture(spark, True)
    with pytest.raises(Exception, match="ticker_market: duplicate keys"):
        tag_market(m.income, m.ticker_market, m.markets).collect()


def test_repeated_statement_keys_fail(spark):
    import pytest
    from valuora.operators import company as C
    from valuora.operators import fundamentals as FU
    m = _market_fixture(spark, False)
    with pytest.raises(Exception, match="cashflow: duplicate keys"):
        FU.combine_statements(m.income, m.cashflow.union(m.cashflow), m.balance).collect()
    company = spark.createDataFrame([("A", "x"), ("A", "y")], "ticker string, company_name string")
    with pytest.raises(Exception, match="company_info: duplicate keys"):
        C.enrich(m.income, company).collect()


def test_latest_price_ties_take_the_lowest(spark):
    from valuora.operators.prices import lowest_latest_price
    px = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 9.0), ("A", 2, 8.0), ("B", 1, 3.0)], "ticker string, d int, low double") \
        .selectExpr("ticker", "date_add(date'2020-01-01', d) AS date", "low")
    assert sorted((r.ticker, r.last_low_price) for r in lowest_latest_price(px).collect()) == [("A", 8.0), ("B", 3.0)]
