import datetime as dt
import os

from pyspark.sql import functions as F

from valuora import sinks
from valuora.sources import files as SRC


def test_price_csv_round_trip_per_symbol(spark, tmp):
    px = spark.createDataFrame(
        [(dt.date(2021, 5, 10), "ATHN", 10.0, 10.0, 9.73, 9.9, 9.9, 22705.0),
         (dt.date(2021, 5, 11), "ATHN", 9.66, 9.95, 9.66, 9.88, 9.88, 3600.0),
         (dt.date(2021, 5, 11), "ZZ", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
        "date date, ticker string, open double, high double, low double, close double, "
        "adj_close double, volume double")
    out = f"{tmp}/prices"
    sinks.export_csv(sinks.display(px), out)
    back = SRC.read_prices_csv(spark, out)
    assert back.columns == ["date", "ticker", "open", "high", "low", "close", "adj_close", "volume"]
    assert sorted(back.collect()) == sorted(px.collect())
    sinks.write_per_symbol_csv(px, f"{tmp}/per_symbol")
    assert [d for d in sorted(os.listdir(f"{tmp}/per_symbol")) if d.startswith("ticker=")] == \
        ["ticker=ATHN", "ticker=ZZ"]


def test_ingest_tags_symbol_from_file_name(spark, tmp):
    os.makedirs(f"{tmp}/drop")
    with open(f"{tmp}/drop/ATHN.csv", "w") as f:
        f.write("Date,Open,High,Low,Close,Adj Close,Volume\n2021-05-10,10,10,9.7,9.9,9.9,22705\n")
    with open(f"{tmp}/drop/EMPTY.csv", "w") as f:
        f.write("Date,Open,High,Low,Close,Adj Close,Volume\n")
    df = SRC.ingest_price_files(spark, f"{tmp}/drop")
    r = df.collect()
    assert [(x.ticker, x.low) for x in r] == [("ATHN", 9.7)]
    audit = SRC.ingest_audit(df)
    assert SRC.valid_symbol_count(audit).first()[0] == 1


def test_symbol_directory_and_company_info(spark, tmp):
    with open(f"{tmp}/dir.txt", "w") as f:
        f.write("Nasdaq Traded|Symbol|Security Name|Listing Exchange|Market Category|ETF|"
                "Round Lot Size|Test Issue|Financial Status|CQS Symbol|NASDAQ Symbol|NextShares\n"
                "Y|AAA|A Inc|Q|Q|N|100|N||AAA|AAA|N\n"
                "Y|BBB|B Inc|Q|Q|Y|100|N|N|BBB|BBB|N\n"
                "Y|CCC|C Inc|Q|Q|N|100|N|D|CCC|CCC|N\n"
                "File Creation Time: 0101202100:00|||||||||||\n")
    from valuora.operators.company import symbol_universe
    u = [r.ticker for r in symbol_universe(SRC.read_symbol_directory(spark, f"{tmp}/dir.txt")).collect()]
    assert u == ["AAA"]
    with open(f"{tmp}/companies.csv", "w") as f:
        f.write('ticker,company name,short name,industry,description,website,logo,ceo,exchange,'
                'market cap,sector,tag 1,tag 2,tag 3\n'
                'AAA,A Inc,A,Tech,"multi\nline, with comma",w,l,c,NASDAQ,1.5,Tech,t1,t2,t3\n')
    ci = SRC.read_company_info(spark, f"{tmp}/companies.csv").collect()
    assert ci[0].market_cap == 1.5 and "\n" in ci[0].description


def test_results_snapshot_and_readback(spark, tmp):
    df = spark.createDataFrame([("A", 1.0)], "ticker string, mos double")
    sinks.write_results({"growth": df, "screener": df}, f"{tmp}/res")
    back = SRC.read_result_tables(spark, f"{tmp}/res", names=("growth", "screener"))
    assert back["growth"].collect() == df.collect()
    sinks.write_snapshot(df, f"{tmp}/snap", "growth", "2023-03-10")
    sinks.write_snapshot(df.withColumn("mos", F.lit(2.0)), f"{tmp}/snap", "growth", "2023-03-11")
    sinks.write_snapshot(df.withColumn("mos", F.lit(3.0)), f"{tmp}/snap", "growth", "2023-03-11")
    latest = SRC.read_snapshot(spark, f"{tmp}/snap", "growth").collect()
    assert [(r.mos, str(r.snapshot_date)) for r in latest] == [(3.0, "2023-03-11")]
    first = SRC.read_snapshot(spark, f"{tmp}/snap", "growth", "2023-03-10").collect()
    assert [r.mos for r in first] == [1.0]


def test_profile_sink_and_inventory(spark, tmp):
    from valuora.operators.profile import column_profile
    df = spark.createDataFrame([(1.0,), (2.0,)], "mos double")
    sinks.write_profile(column_profile(df), f"{tmp}/profile")
    assert spark.read.json(f"{tmp}/profile").count() == 1
    inv = SRC.file_inventory(spark, "/root/testdata/sf0.001")
    names = {r.file_name for r in inv.collect()}
    assert "lineitem.parquet" in names


def test_union_markets_aligns_by_name(spark):
    from valuora.operators.multimarket import union_markets
    a = spark.createDataFrame([("A", 1)], "ticker string, industry_id int")
    b = spark.createDataFrame([("B",)], "ticker string")
    out = {r.ticker: (r.industry_id, r.market) for r in union_markets({"us": a, "de": b}).collect()}
    assert out == {"A": (1, "us"), "B": (None, "de")}
