"""File-based model and the command line, end to end on small files."""
import os

from valuora.plans.model import FileModel, TestdataModel
from valuora.plans.oracle import PERIOD
from valuora.plans.jobs import single_market
from valuora import sinks


def test_file_model_matches_adapters(spark, tmp):
    sf = "/root/testdata/sf0.001"
    tm = TestdataModel(spark, sf)
    paths = {}
    # write the model tables in the reference's layout: vendor names, CSV prices
    sinks.export_csv(sinks.display(tm.price), f"{tmp}/prices")
    paths["price"] = {"path": f"file://{tmp}/prices", "format": "csv"}
    for name in ("income", "cashflow", "balance", "company_info", "peers"):
        sinks.write_table(sinks.display(getattr(tm, name)), f"{tmp}/{name}")
        paths[name] = f"{tmp}/{name}"
    # one statement as CSV text: the declared model types come back on read
    sinks.export_csv(sinks.display(tm.income), f"{tmp}/income_csv")
    paths["income"] = {"path": f"{tmp}/income_csv", "format": "csv"}
    fm = FileModel(spark, paths)
    assert "net_income" in fm.income.columns and "shares_basic" in fm.balance.columns
    types = dict(fm.income.dtypes)
    assert types["fiscal_year"] == "int" and types["net_income"] == "double"
    assert types["simfin_id"] == "bigint" and types["report_date"] == "date"
    a = single_market(fm, PERIOD).screener.collect()
    b = single_market(tm, PERIOD).screener.collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_cli_process(spark, tmp):
    from valuora.__main__ import main
    out = f"{tmp}/cli"
    main(["process", "--sf", "/root/testdata/sf0.001", "--out", out,
          "--start", str(PERIOD[0]), "--end", str(PERIOD[1])])
    assert sorted(os.listdir(out)) == ["company_info", "fundamental", "growth", "screener"]
    assert spark.range(1).count() == 1      # the shared session is still alive


def test_cli_multi_and_daily(spark, tmp):
    from valuora.__main__ import main
    out = f"{tmp}/mm"
    main(["multi", "--sf", "/root/testdata/sf0.001", "--out", out, "--exclude", "MIDDLE EAST",
          "--date", "2023-03-11", "--csv"])
    assert os.path.isdir(f"{out}/2023-03-11_growth_csv")
    g = spark.read.parquet(f"{out}/growth")
    assert [str(r.snapshot_date) for r in g.select("snapshot_date").distinct().collect()] == ["2023-03-11"]
    assert "mos_reached" in g.columns and g.count() > 0
    # daily refresh against the stored single-market growth and a drop of price files
    main(["process", "--sf", "/root/testdata/sf0.001", "--out", f"{tmp}/proc",
          "--start", str(PERIOD[0]), "--end", str(PERIOD[1])])
    valued = spark.read.parquet(f"{tmp}/proc/growth").where("mos is not null")
    t = valued.orderBy("ticker").first()
    os.makedirs(f"{tmp}/drop")
    with open(f"{tmp}/drop/today.csv", "w") as f:
        f.write("Date,Ticker,Open,High,Low,Close,Adj Close,Volume\n")
        f.write(f"2030-01-02,{t.ticker},1,1,{t.mos / 2},1,1,10\n")
        f.write("2030-01-02,not-a-valued-ticker,1,1,0.01,1,1,10\n")
    main(["daily", "--growth", f"{tmp}/proc/growth", "--drop", f"{tmp}/drop", "--out", f"{tmp}/daily"])
    s = spark.read.parquet(f"{tmp}/daily/screener").collect()
    assert [(r.ticker, r.last_low_price) for r in s] == [(t.ticker, t.mos / 2)]


def test_file_model_without_peers(spark, tmp):
    tm = TestdataModel(spark, "/root/testdata/sf0.001")
    paths = {}
    for name in ("price", "income", "cashflow", "balance", "company_info"):
        sinks.write_table(getattr(tm, name), f"{tmp}/{name}")
        paths[name] = f"{tmp}/{name}"
    r = single_market(FileModel(spark, paths), PERIOD)
    assert "peer_string" not in r.company_info.columns
    assert r.screener.count() == single_market(tm, PERIOD).screener.count()


def test_file_model_multi_market(spark, tmp):
    from valuora.operators.multimarket import multi_market
    tm = TestdataModel(spark, "/root/testdata/sf0.001")
    paths = {}
    for name in ("price", "income", "cashflow", "balance", "companies", "industries", "markets"):
        sinks.write_table(sinks.display(getattr(tm, name)), f"{tmp}/{name}")
        paths[name] = f"{tmp}/{name}"
    fm = FileModel(spark, paths)
    assert "market_id" in fm.markets.columns and "industry_id" in fm.companies.columns
    key = lambda r: tuple(str(v) for v in r)
    a = multi_market(fm, ("MIDDLE EAST",))["growth"]
    b = multi_market(tm, ("MIDDLE EAST",))["growth"]
    assert sorted(a.collect(), key=key) == sorted(b.select(*a.columns).collect(), key=key)


def test_statement_sources_by_market_and_variant(spark, tmp):
    from pyspark.sql import functions as F
    tm = TestdataModel(spark, "/root/testdata/sf0.001")
    src = None
    for name in ("income", "cashflow", "balance"):
        df = sinks.display(getattr(tm, name)).join(
            tm.ticker_market.withColumnRenamed("ticker", "Ticker"), "Ticker").withColumns(
            {"statement": F.lit(name), "variant": F.lit("annual")})
        old = df.withColumns({"variant": F.lit("quarterly"), "Fiscal Year": F.lit(1900)})
        both = df.unionByName(old)
        src = both if src is None else src.unionByName(both, allowMissingColumns=True)
    src.write.partitionBy("statement", "variant", "market").parquet(f"{tmp}/statements")
    fm = FileModel(spark, {"income": {"path": f"{tmp}/statements", "format": "statements"},
                           "balance": {"path": f"{tmp}/statements", "format": "statements", "market": "ASIA"}})
    assert fm.income.count() == tm.income.count() and "net_income" in fm.income.columns
    asia = tm.ticker_market.where("market = 'ASIA'")
    assert fm.balance.count() == tm.balance.join(asia, "ticker", "left_semi").count()
    import pytest
    with pytest.raises(ValueError):
        FileModel(spark, {"price": {"path": "x", "format": "xls"}})


def test_cli_ingest_and_process_on_the_price_table(spark, tmp):
    import json
    from valuora.__main__ import main
    tm = TestdataModel(spark, "/root/testdata/sf0.001")
    # vendor files: one CSV per symbol, named after it, without a ticker column
    some = [r.ticker for r in tm.price.select("ticker").distinct().orderBy("ticker").limit(3).collect()]
    os.makedirs(f"{tmp}/vendor")
    for t in some:
        rows = tm.price.where(tm.price.ticker == t).collect()
        with open(f"{tmp}/vendor/{t}.csv", "w") as f:
            f.write("Date,Open,High,Low,Close,Adj Close,Volume\n")
            for r in rows:
                f.write(f"{r.date},{r.open},{r.high},{r.low},{r.close},{r.adj_close},{r.volume}\n")
    with open(f"{tmp}/paths.json", "w") as f:
        json.dump({"price": {"path": f"file://{tmp}/vendor", "format": "per_symbol_csv"}}, f)
    main(["ingest", "--files", f"{tmp}/paths.json", "--out", f"{tmp}/in"])
    back = FileModel(spark, {"price": {"path": f"{tmp}/in/price", "format": "price_table"}}).price
    want = tm.price.where(tm.price.ticker.isin(some))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.select(*back.columns).collect()))
    assert spark.read.parquet(f"{tmp}/in/price_audit").count() == 3


def test_peers_file(spark, tmp):
    with open(f"{tmp}/peers.csv", "w") as f:
        f.write('ticker,peer_string\nA,"B,C"\nB,\n')
    peers = FileModel(spark, {"peers": f"{tmp}/peers.csv"}).peers
    assert sorted(map(tuple, peers.collect())) == [("A", "B,C"), ("B", None)]
