"""Per-symbol files are opened by many tasks, however few bytes their rows are."""
import datetime as dt
import os
import re

from valuora import sinks
from valuora.sources import adapters as A


def writers(folder):
    """Task numbers in the names of the price files below a folder."""
    return {re.match(r"part-(\d+)", f)[1] for d, _, fs in os.walk(folder) for f in fs
            if f.startswith("part-") and "symbol=S" not in d}


def test_symbol_folders_are_written_by_many_tasks(spark, tmp):
    px = spark.createDataFrame([(dt.date(2024, 1, 1 + k % 3), f"T{k % 40}", float(k)) for k in range(200)],
                               "date date, ticker string, low double")
    sinks.write_per_symbol_csv(px, f"{tmp}/files")
    assert len(writers(f"{tmp}/files")) > 1
    back = spark.read.option("header", True).schema("date date, low double, ticker string").csv(f"{tmp}/files")
    assert sorted(map(tuple, back.select("date", "ticker", "low").collect())) == sorted(map(tuple, px.collect()))


def test_a_delivery_is_written_by_many_tasks(spark, tmp):
    day = dt.datetime(2020, 12, 1)
    spark.createDataFrame([(k, k % 30) for k in range(60)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame([(k, day, float(k), 1.0) for k in range(60)], "l_orderkey long, l_shipdate timestamp, "
                          "l_extendedprice double, l_quantity double").write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame([(k, float(k - 10)) for k in range(20)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp}/supplier.parquet")

    def lows():
        found = spark.read.option("header", True).schema("Date date, Open double, High double, Low double, symbol string").csv(f"{tmp}/vendor")
        return sorted((r.symbol, r.Low) for r in found.where("Low is not null").collect())
    A.vendor_files(spark, tmp, f"{tmp}/vendor")
    assert len(writers(f"{tmp}/vendor")) > 1
    assert len([d for d in os.listdir(f"{tmp}/vendor") if d.startswith("symbol=")]) == 50
    assert lows() == sorted((str(k % 30), float(k)) for k in range(60))
    before = set(os.listdir(f"{tmp}/vendor/symbol=8"))
    A.vendor_files(spark, tmp, f"{tmp}/vendor", raised="7")
    assert lows() == sorted((str(k % 30), float(k + (k % 10 == 7))) for k in range(60))
    assert before == set(os.listdir(f"{tmp}/vendor/symbol=8"))
    A.vendor_files(spark, tmp, f"{tmp}/vendor")   # a new delivery replaces all that was there
    assert lows() == sorted((str(k % 30), float(k)) for k in range(60))
