"""The date-partitioned price layout prunes what the queries do not need."""
import datetime as dt

from valuora import sinks
from valuora.operators import prices as P
from valuora.sources.files import read_price_table


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def test_partition_and_dynamic_pruning(spark, tmp):
    rows = []
    for t in ("A", "B", "C"):
        for m in (10, 11, 12):
            for d in (1, 15):
                rows.append((dt.date(2020, m, d), t, 1.0, 1.0, float(m + d), 1.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "date date, ticker string, open double, high double, low double, "
                                     "close double, adj_close double, volume double")
    sinks.write_price_table(df, f"{tmp}/price")
    price = read_price_table(spark, f"{tmp}/price")
    assert price.columns[:2] == ["date", "ticker"]
    annual = P.annual_price(price, 2020, 2020)
    got = {(r.year, r.ticker): r.mean_low_price for r in annual.collect()}
    assert got == {(2020, t): 20.0 for t in ("A", "B", "C")}
    plan = annual._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "month(date" in plan
    latest = P.latest_price(price)
    assert sorted((r.ticker, r.last_low_price) for r in latest.collect()) == \
        [("A", 27.0), ("B", 27.0), ("C", 27.0)]
    # the screener's join back: the build side (latest dates x growth) carries the
    # growth table's selective filter, so the price scan gets a dynamic pruning filter
    from pyspark.sql import functions as F
    from valuora.operators.screen import screener
    growth = (spark.createDataFrame([("A", 1.0, 1.0, 30.0, 5), ("B", 1.0, 1.0, 10.0, 5),
                                     ("C", 1.0, 1.0, 50.0, 3)],
                                    "ticker string, price_future double, sticker_price double, "
                                    "mos double, yrs_in_5yr int")
              .where(F.col("yrs_in_5yr") == 5))
    s = screener(price, growth, materialize=False)
    assert [(r.ticker, r.last_low_price) for r in s.collect()] == [("A", 27.0)]
    assert "dynamicpruning" in s._jdf.queryExecution().executedPlan().toString()


def test_daily_loads_replace_only_their_day(spark, tmp):
    schema = ("date date, ticker string, open double, high double, low double, close double, "
              "adj_close double, volume double")
    day = lambda d, low: spark.createDataFrame(
        [(d, "A", 1.0, 1.0, low, 1.0, 1.0, 1.0)], schema)
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")   # a bare session
    try:
        sinks.write_price_table(day(dt.date(2022, 2, 24), 1.0), f"{tmp}/p")
        sinks.write_price_table(day(dt.date(2022, 2, 25), 2.0), f"{tmp}/p")
        sinks.write_price_table(day(dt.date(2022, 2, 25), 3.0), f"{tmp}/p")   # a re-run
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    got = sorted((str(r.date), r.low) for r in read_price_table(spark, f"{tmp}/p").collect())
    assert got == [("2022-02-24", 1.0), ("2022-02-25", 3.0)]
