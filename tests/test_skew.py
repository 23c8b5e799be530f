"""Hot-key safety: one ticker holds a third of all price rows."""
import datetime as dt
import re

from pyspark.sql import functions as F

from valuora.operators import prices as P
from valuora.operators.screen import screener


def hot_prices(spark, n=30000):
    base = dt.date(2000, 1, 1)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .otherwise((F.col("id") % 997).cast("string")).alias("ticker"),
        F.date_add(F.lit(base), (F.col("id") / 3 % 4000).cast("int")).alias("date"),
        (F.col("id") % 101 + 1).cast("double").alias("low"))
    return df


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_per_ticker_aggregates_combine_before_the_shuffle(spark):
    px = hot_prices(spark)
    for df in (P.latest_dates(px), P.annual_price(px, 2000, 2010), P.price_stats(px)):
        p = plan(df)
        # map-side partial aggregation: one row per ticker per task reaches the shuffle
        assert re.search(r"HashAggregate\(keys=\[[^\]]*ticker[^\]]*\], functions=\[partial_", p), p
        assert "Window" not in p


def test_join_back_keys_spread_a_hot_ticker(spark):
    px = hot_prices(spark)
    g = px.select("ticker").distinct().withColumn("price_future", F.lit(1.0)) \
        .withColumn("sticker_price", F.lit(1.0)).withColumn("mos", F.lit(1000.0))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        s = screener(px, g)
        rows = s.collect()
        text = s._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # without a broadcast the join back is partitioned on (ticker, date), not on ticker alone
    assert "SortMergeJoin" in text
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert any("date" in k and "ticker" in k for k in keys), keys
    hot = [r for r in rows if r.ticker == "HOT"]
    assert len(hot) >= 1 and all(r.last_date == hot[0].last_date for r in hot)
